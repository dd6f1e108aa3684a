"""Readers for the study's tables and delimited files.

Delimited files are read as text, columns are picked by heading, and only then
cast: a reordered or widened file still lands in the right types.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.genotypes import Genotypes, SparseGenotypes
from riskloom.operators.weights import HEADINGS, resolve_headings
from riskloom.schema import (
    CALLS,
    REFERENCE_BLOCKS,
    SAMPLES,
    VARIANTS,
    WEIGHTS,
    SchemaError,
    require_rows,
    require_schema,
)

# Fixed value: text for a missing value in delimited files.
NA = "NA"


def read_genotypes(spark: SparkSession, path: str) -> Genotypes:
    """Dense genotypes; no samples or no variants is an error."""
    samples = require_rows(require_schema(spark.read.parquet(f"{path}/samples"), SAMPLES, "samples"), "samples")
    variants = require_rows(
        require_schema(spark.read.parquet(f"{path}/variants"), VARIANTS, "variants"), "variants"
    )
    calls = require_schema(read_contig_table(spark, f"{path}/calls"), CALLS, "calls")
    return Genotypes(samples, variants, calls)


def read_sparse_genotypes(spark: SparkSession, path: str) -> SparseGenotypes:
    """Two-component genotypes: variant calls plus reference blocks."""
    dense = read_genotypes(spark, path)
    blocks = require_schema(spark.read.parquet(f"{path}/reference_blocks"), REFERENCE_BLOCKS, "reference blocks")
    return SparseGenotypes(dense.samples, dense.variants, dense.calls, blocks)


def read_contig_table(spark: SparkSession, path: str) -> DataFrame:
    """A table partitioned by contig, contigs as text."""
    return _with_text(spark, path, "contig")


def read_weights(spark: SparkSession, path: str) -> DataFrame:
    """A written weight table; wrong types or no rows are an error."""
    return require_rows(require_schema(_with_text(spark, path, "prs_id"), WEIGHTS, "weights"), "weights")


def read_text_columns(
    spark: SparkSession,
    path: str,
    types: dict[str, str],
    optional: tuple[str, ...] = (),
    sep: str = ",",
) -> DataFrame:
    """Named columns of a delimited file with headings, cast to the given types."""
    raw = spark.read.csv(path, header=True, sep=sep, nullValue=NA)
    missing = [c for c in types if c not in raw.columns and c not in optional]
    if missing:
        raise SchemaError(f"{path} lacks {missing}; it has {raw.columns}")
    return raw.select(*[_read_as(c, t).alias(c) for c, t in types.items() if c in raw.columns])


def _read_as(name: str, kind: str) -> Column:
    """A column of text in another type; whole numbers may be written ``1.0``; unreadable values are NULL."""
    if kind == "long":
        return F.coalesce(F.col(name).try_cast("long"), F.col(name).try_cast("double").try_cast("long"))
    return F.col(name).try_cast(kind)


def _with_text(spark: SparkSession, path: str, *names: str) -> DataFrame:
    """A Parquet table whose named columns are text, even where folder names look like numbers."""
    schema = spark.read.parquet(path).schema
    if not any(f.name in names for f in schema):
        return spark.read.parquet(path)
    fields = [T.StructField(f.name, T.StringType() if f.name in names else f.dataType, f.nullable) for f in schema]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def read_flagged_samples(spark: SparkSession, path: str) -> DataFrame | None:
    """Tab-separated exclusion list keyed by ``sample_id``; None if there is no file.

    A file that exists but cannot be read is an error, not an empty list.
    """
    try:
        return read_text_columns(spark, path, {"sample_id": "string"}, sep="\t")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """``person_id`` list as text; an empty list is an error."""
    return require_rows(read_text_columns(spark, path, {"person_id": "string"}), f"id list {path}")


def read_cohort(spark: SparkSession, path: str) -> DataFrame:
    """An id list with the id column named ``s``."""
    return read_id_list(spark, path).withColumnRenamed("person_id", "s")


def read_cases(spark: SparkSession, path: str) -> DataFrame:
    """Rows with status 1 of a case list that must have both columns."""
    cases = read_text_columns(spark, path, {"s": "string", "phenotype_status": "long"})
    return cases.where("phenotype_status = 1")


def read_case_labels(spark: SparkSession, path: str) -> DataFrame:
    """A case list for evaluation: without a status column everybody listed is a case.

    A file without any column at all is an empty list.
    """
    if not spark.read.csv(path, header=True).columns:
        return spark.createDataFrame([], "s string, phenotype_status long")
    cases = read_text_columns(
        spark, path, {"s": "string", "phenotype_status": "long"}, optional=("phenotype_status",)
    )
    if "phenotype_status" not in cases.columns:
        cases = cases.withColumn("phenotype_status", F.lit(1).cast("long"))
    return cases


def read_scores(spark: SparkSession, path: str, prs_id: str | None = None) -> DataFrame:
    """An exported score list (ids under ``s`` or ``person_id``) in the engine's columns."""
    types = {
        "prs_id": "string",
        "s": "string",
        "person_id": "string",
        "prs_total_score": "double",
        "prs_variant_count": "long",
        "prs_normalized_score": "double",
    }
    found = read_text_columns(spark, path, types, optional=("prs_id", "s", "person_id"))
    if "s" not in found.columns:
        if "person_id" not in found.columns:
            raise SchemaError(f"{path} has neither s nor person_id")
        found = found.withColumnRenamed("person_id", "s")
    if "prs_id" not in found.columns:
        found = found.withColumn("prs_id", F.lit(prs_id))
    return found.select(
        "prs_id",
        "s",
        F.col("prs_total_score").alias("total_score"),
        F.col("prs_variant_count").alias("variant_count"),
        F.col("prs_normalized_score").alias("normalized_score"),
    )


def list_files(spark: SparkSession, path: str) -> list[str]:
    """The data files at a path: the file itself, or a folder's files that are not hidden; none if there is nothing."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found = [f.getPath() for f in fs.listStatus(root) if f.isFile()]
    return sorted(_same_form(p.toUri().toString()) for p in found if not p.getName().startswith(("_", ".")))


def _same_form(uri: str) -> str:
    """Local paths come with one slash or three."""
    return re.sub("^file:/+", "file:/", uri)


def read_scoring_files(spark: SparkSession, files: dict[str, list[str]]) -> tuple[DataFrame | None, list[tuple[str, str]]]:
    """(raw weights of all models in text columns, models whose files lack a heading with the reason).

    The files are tab-separated text with ``#`` comments, gzip or not, each with headings of its own. One scan reads them
    all: a table with a row for each file says at which place of a line the fields stand.
    """
    lines = spark.read.text(sorted({f for parts in files.values() for f in parts})).select(
        "value",
        F.regexp_replace("_metadata.file_path", "^file:/+", "file:/").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"),
    ).where(~F.col("value").startswith("#") & (F.trim("value") != ""))
    # A row for each file; its headings stand in its first block.
    headings = {r["file"]: r["value"] for r in lines.where("start = 0").groupBy("file").agg(F.min_by("value", "line").alias("value")).collect()}
    places, without = [], []
    for model, parts in files.items():
        try:
            own = [(f, headings[f], _field_places(headings[f])) for f in parts if f in headings]
            if not own:
                raise SchemaError("empty scoring file")
            places += [(model, f, text, *[at[c] for c in _FIELDS]) for f, text, at in own]
        except SchemaError as e:
            without.append((model, str(e)))
    if not places:
        return None, without
    ddl = "prs_id string, file string, heading string, " + ", ".join(f"`at_{c}` int" for c in _FIELDS)
    # No more rows than files.
    met = lines.join(F.broadcast(spark.createDataFrame(places, ddl)), "file").where(F.col("value") != F.col("heading"))
    values = F.split("value", "\t")
    fields = [F.regexp_replace(F.get(values, F.col(f"at_{c}")), '^"(.*)"$', "$1").alias(HEADINGS[c][0]) for c in _FIELDS]
    return met.select("prs_id", *fields), without


_FIELDS = list(HEADINGS)


def _field_places(heading: str) -> dict[str, int | None]:
    """Field -> place in a line of the file; None for an optional field without a heading."""
    columns = [c.strip().strip('"') for c in heading.lstrip("\ufeff").split("\t")]
    found = resolve_headings(columns)
    return {c: columns.index(found[c]) if c in found else None for c in _FIELDS}


def read_intervals(spark: SparkSession, path: str) -> DataFrame:
    """Headerless tab-separated locus intervals; unreadable bounds become NULL (invalid)."""
    raw = spark.read.csv(path, sep="\t", schema="contig string, start_pos string, end_pos string")
    return raw.select(
        "contig",
        F.col("start_pos").try_cast("int").alias("start_pos"),
        F.col("end_pos").try_cast("int").alias("end_pos"),
    )


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Model list with ``id``, ``url`` and ``phenotype``."""
    return read_text_columns(spark, path, {"id": "string", "url": "string", "phenotype": "string"})


def read_scan_cohort(spark: SparkSession, path: str, features: list[str]) -> DataFrame:
    """Association cohort: ``person_id`` and numeric columns."""
    return read_text_columns(spark, path, {"person_id": "long", **{f: "double" for f in features}})


def read_phecode_counts(spark: SparkSession, path: str) -> DataFrame:
    """Phecode counts per person, with ``count`` renamed to ``n``."""
    counts = read_text_columns(spark, path, {"person_id": "long", "phecode": "string", "count": "long"})
    return counts.withColumnRenamed("count", "n")
