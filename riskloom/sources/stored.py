"""Intermediate tables written to the cluster's shared checkpoint folder.

A written table cuts lineage, survives the loss of executors, and tells both
Catalyst (file size) and the caller (row count) how large a join side really is.
"""

from __future__ import annotations

import hashlib
import json
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Rows up to which a join side of a few narrow columns is broadcast (tens of MB).
BROADCAST_ROWS = 1_000_000

# What reading a damaged or missing file may raise, at planning or at execution.
READ_ERRORS = (PySparkException, Py4JJavaError)


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a scratch one only in local mode."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    base = tempfile.mkdtemp(prefix="riskloom-")
    spark.sparkContext.setCheckpointDir(base)
    return base


def new_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    if (mine := _in_scope.get()) is not None:
        mine.append(path)
    return path


_in_scope: ContextVar[list[str] | None] = ContextVar("tables of the innermost scope", default=None)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables written inside are deleted at the end: for a run whose results are written elsewhere.

    Nothing that still reads them, like a DataFrame made inside, may be used afterwards.
    """
    mine: list[str] = []
    token = _in_scope.set(mine)
    try:
        yield
    finally:
        _in_scope.reset(token)
        for path in mine:
            delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


class Stored:
    """A written table together with the figures observed while writing it."""

    def __init__(self, df: DataFrame, figures: dict[str, object]):
        self.df = df
        self.figures = figures
        self.rows: int = figures["rows"]

    def join_side(self, row_limit: int = BROADCAST_ROWS) -> DataFrame:
        """The table, hinted for broadcast only if its counted rows allow it.

        Beyond the limit no hint is given and Spark shuffles both sides,
        splitting skewed partitions adaptively.
        """
        return F.broadcast(self.df) if self.rows <= row_limit else self.df


def store(df: DataFrame, label: str, **figures: Column) -> Stored:
    """Write ``df`` once, counting rows (and any extra aggregates) on the way."""
    spark = df.sparkSession
    path = new_path(spark, label)
    seen = Observation(label)
    aggregates = [F.count(F.lit(1)).alias("rows")] + [c.alias(n) for n, c in figures.items()]
    df.observe(seen, *aggregates).write.parquet(path)
    return Stored(spark.read.schema(df.schema).parquet(path), seen.get)


def save_bucketed(df: DataFrame, path: str, buckets: int) -> DataFrame:
    """``df`` written in buckets of its ``variant_id``, each sorted, and read back with them."""
    name = f"bucketed_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, F.col("variant_id"))
    dealt.write.bucketBy(buckets, "variant_id").sortBy("variant_id").option("path", path).mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def fingerprint(**parameters) -> str:
    """Short stable digest of the parameters that determine an artefact."""
    text = json.dumps(parameters, sort_keys=True, default=str)
    return hashlib.sha256(text.encode()).hexdigest()[:16]


def content_digest(df: DataFrame) -> str:
    """Digest of a table's rows as a bag: the same in any order and on any cluster, another if any row differs.

    Row counts and two sums of 64-bit row hashes, taken in one pass; a NULL is told apart from every value.
    """
    columns = sorted(df.columns)
    parts = [part for c in columns for part in (F.col(c).isNull(), F.col(c).cast("string"))]
    hashes = df.select(*[F.xxhash64(F.lit(seed), *parts).cast("decimal(20,0)").alias(f"_{seed}") for seed in (1, 2)])
    found = hashes.agg(F.count(F.lit(1)), F.sum("_1"), F.sum("_2")).first()
    return fingerprint(columns=columns, figures=[str(v) for v in found])


def checkpoint_or_compute(
    spark: SparkSession, base_path: str, parameters: dict, build: Callable[[], DataFrame]
) -> DataFrame:
    """Reuse a completely written, non-empty artefact of the same parameters, else rebuild it.

    The parameters are part of the path, so a changed configuration never
    reads another configuration's data. The row count is written last: without
    it, or with data that cannot be read or has another count, the artefact is
    built again.
    """
    path = f"{base_path.rstrip('/')}/{fingerprint(**parameters)}"
    found = _complete(spark, path)
    if found is not None:
        return found
    fresh = build()
    drop_record(spark, path)
    seen = Observation("artefact")
    rows = F.count(F.lit(1)).alias("rows")
    fresh.observe(seen, rows).write.mode("overwrite").parquet(f"{path}/data")
    write_record(spark, path, {"rows": seen.get["rows"]})
    return spark.read.schema(fresh.schema).parquet(f"{path}/data")


def write_record(spark: SparkSession, path: str, counts: dict[str, int]) -> None:
    """The counts of what was written below ``path``, as the last thing written there."""
    columns = [F.lit(v).cast("long").alias(k) for k, v in counts.items()]
    spark.range(1, numPartitions=1).select(*columns).write.mode("overwrite").parquet(f"{path}/complete")


def drop_record(spark: SparkSession, path: str) -> None:
    """Take an earlier record away before its data are overwritten: a run that stops halfway leaves none."""
    delete(spark, f"{path}/complete")


def _complete(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        counted = read_if_present(spark, f"{path}/complete")
        rows = counted.agg(F.max("rows")).first()[0] if counted is not None else None
        if not rows:
            return None
        found = spark.read.parquet(f"{path}/data")
        return found if found.count() == rows else None
    except READ_ERRORS:
        return None


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``; None if absent or without readable footers."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
