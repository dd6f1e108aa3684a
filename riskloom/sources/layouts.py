"""Stored genotype layouts beside the plain one: tiles, and calls bucketed by variant."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.genotypes import Genotypes
from riskloom.operators.tiles import TiledGenotypes
from riskloom.schema import EmptyInputError
from riskloom.sources.readers import read_contig_table
from riskloom.sources.stored import drop_record, read_if_present, save_bucketed, write_record

# Calls in a bucket, about.
CALLS_PER_BUCKET = 4_000_000


def write_tiles(tiled: TiledGenotypes, path: str) -> TiledGenotypes:
    """Write tiles partitioned by contig, with the indexes they are aligned to, and read them back.

    Each file holds the tiles of few blocks of samples, in order of block and run. The sizes are written last.
    """
    spark = tiled.tiles.sparkSession
    drop_record(spark, path)
    tiled.members.write.mode("overwrite").parquet(f"{path}/members")
    tiled.variants.write.mode("overwrite").parquet(f"{path}/variants")
    tiled.tiles.write.mode("overwrite").partitionBy("contig").option("compression", "zstd").parquet(f"{path}/tiles")
    write_record(spark, path, {"block_samples": tiled.block_samples, "run_variants": tiled.run_variants})
    return read_tiles(spark, path)


def read_tiles(spark: SparkSession, path: str) -> TiledGenotypes:
    """Written tiles; a layout that was not written to its end is an error."""
    sizes = read_if_present(spark, f"{path}/complete")
    if sizes is None:
        raise EmptyInputError(f"no complete tiles at {path}")
    sizes = sizes.first()
    tiles = read_contig_table(spark, f"{path}/tiles")
    if "cells" not in tiles.columns:  # written when all tiles were matrices
        tiles = tiles.withColumn("cells", F.lit(None).cast("binary"))
    members, variants = spark.read.parquet(f"{path}/members"), spark.read.parquet(f"{path}/variants")
    return TiledGenotypes(members, variants, tiles, sizes["block_samples"], sizes["run_variants"])


def write_bucketed(genotypes: Genotypes, path: str, buckets: int | None = None) -> Genotypes:
    """Write calls bucketed by variant; loci bucketed alike then meet them without a shuffle of either.

    Without a number of buckets it follows the number of calls. Every bucket is one file, written by one task.
    """
    spark = genotypes.calls.sparkSession
    buckets = buckets or -(-genotypes.calls.count() // CALLS_PER_BUCKET) or 1
    drop_record(spark, path)
    genotypes.samples.write.mode("overwrite").parquet(f"{path}/samples")
    genotypes.variants.write.mode("overwrite").parquet(f"{path}/variants")
    save_bucketed(genotypes.calls.drop("contig", "position"), f"{path}/calls", buckets)
    write_record(spark, path, {"buckets": buckets})
    return read_bucketed(spark, path)


def read_bucketed(spark: SparkSession, path: str) -> Genotypes:
    """Written bucketed genotypes; a layout that was not written to its end is an error."""
    record = read_if_present(spark, f"{path}/complete")
    if record is None:
        raise EmptyInputError(f"no complete bucketed genotypes at {path}")
    buckets = record.first()["buckets"]
    calls = _as_bucketed(spark, f"{path}/calls", buckets)
    return Genotypes(spark.read.parquet(f"{path}/samples"), spark.read.parquet(f"{path}/variants"), calls, buckets)


def _as_bucketed(spark: SparkSession, path: str, buckets: int) -> DataFrame:
    """A written bucketed folder as a table of this session."""
    name = f"bucketed_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    spark.sql(
        f"create table {name} ({columns}) using parquet clustered by (variant_id) sorted by (variant_id) "
        f"into {buckets} buckets location '{path}'"
    )
    return spark.table(name)
