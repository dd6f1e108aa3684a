"""Writers. Delimited output is a folder of part files, written in parallel."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.genotypes import Genotypes, SparseGenotypes, dataset_counts, variant_places
from riskloom.operators.phenotype import status_column
from riskloom.schema import EmptyInputError, require_rows, require_schema
from riskloom.sources.readers import NA, read_genotypes
from riskloom.sources.stored import store

# Calls that a task writes, about; bases of reference blocks and samples whose blocks share a task.
ROWS_PER_TASK = 4_000_000
BLOCK_BASES = 1 << 20
SAMPLES_PER_BLOCK_TASK = 10_000


def write_genotypes(genotypes: Genotypes | SparseGenotypes, path: str) -> dict[str, int]:
    """Write genotypes with calls partitioned by contig and ordered by position, so that files cover narrow ranges.

    Returns the counts a reader must find. The runs of variants that share a task come from the variants table, so the
    calls are read, shuffled and written once, and counted on the way. Where there are so many samples that one
    variant has more than ``ROWS_PER_TASK`` calls, the samples are dealt out too. A call of an unknown variant has no contig.
    """
    samples, variants = store(genotypes.samples, "samples"), store(genotypes.variants, "variants")
    samples.df.write.mode("overwrite").parquet(f"{path}/samples")
    variants.df.repartitionByRange("contig", "position").sortWithinPartitions("contig", "position").write.mode(
        "overwrite"
    ).parquet(f"{path}/variants")
    shares = -(-samples.rows // ROWS_PER_TASK) or 1
    share = F.pmod(F.xxhash64("s"), F.lit(shares))

    runs = variant_places(variants.df, max(1, ROWS_PER_TASK // max(1, samples.rows)))
    calls = genotypes.calls.drop("contig", "position").join(runs.join_side(), "variant_id", "left")
    order = ["contig", "position", "variant_id", "s"]
    dealt = calls.repartition("contig", "run", share).drop("run", "place").sortWithinPartitions(*order)
    seen = Observation("calls")
    dealt.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").partitionBy("contig").parquet(f"{path}/calls")
    counts = {"n_samples": samples.rows, "n_variants": variants.rows, "n_calls": seen.get["rows"]}
    if isinstance(genotypes, SparseGenotypes):
        blocks, seen = genotypes.reference_blocks, Observation("blocks")
        shares = -(-samples.rows // SAMPLES_PER_BLOCK_TASK) or 1
        dealt = blocks.repartition(
            "contig", F.floor(F.col("start_pos") / BLOCK_BASES), F.pmod(F.xxhash64("s"), F.lit(shares))
        ).sortWithinPartitions("contig", "start_pos", "s")
        dealt.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{path}/reference_blocks")
        counts["n_blocks"] = seen.get["rows"]
    return counts


def verify_counts(spark: SparkSession, path: str, expected: dict[str, int]) -> DataFrame:
    """Counters of written genotypes next to the expected ones, and whether all agree.

    Unreadable or empty genotypes raise; a differing count is reported.
    """
    found = dataset_counts(read_genotypes(spark, path))
    if "n_blocks" in expected:
        blocks = spark.read.parquet(f"{path}/reference_blocks").agg(F.count(F.lit(1)))
        found = found.withColumn("n_blocks", blocks.scalar())
    agree = F.lit(True)
    for name, value in expected.items():
        agree = agree & (F.col(name) == F.lit(value))
    return found.withColumn("verified", agree)


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True) -> None:
    df.write.mode("overwrite").csv(path, sep=sep, header=header, nullValue=NA)


def write_sample_ids(samples: DataFrame, path: str) -> None:
    """Ids of the samples as ``person_id``; nobody is an error."""
    ids = samples.select(F.col("s").alias("person_id"))
    write_csv(require_rows(ids, "sample list"), path)


def write_cases(cases: DataFrame, path: str) -> None:
    """Case list; without cases the file still has its heading."""
    write_csv(cases.select("s", "phenotype_status"), path)


def write_intervals(intervals: DataFrame, path: str) -> None:
    """Headerless tab-separated intervals."""
    write_csv(intervals.select("contig", "start_pos", "end_pos"), path, sep="\t", header=False)


def write_weights(weights: DataFrame, path: str) -> None:
    """Weight table ordered by locus, one folder per model."""
    order = ["prs_id", "contig", "position"]
    weights.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").partitionBy(
        "prs_id"
    ).parquet(path)


def score_columns(scores: DataFrame) -> DataFrame:
    """Scores under their exported names."""
    return scores.select(
        *(["prs_id"] if "prs_id" in scores.columns else []),
        F.col("s").alias("person_id"),
        F.col("total_score").alias("prs_total_score"),
        F.col("variant_count").alias("prs_variant_count"),
        F.col("normalized_score").alias("prs_normalized_score"),
    )


def write_scores(scores: DataFrame, table_path: str, csv_path: str) -> None:
    """Scores as a table and as CSV; no scores at all is an error."""
    require_schema(scores, {"s": None, "total_score": None, "variant_count": None, "normalized_score": None}, "scores")
    scores.write.mode("overwrite").parquet(table_path)
    written = scores.sparkSession.read.schema(scores.schema).parquet(table_path)
    if written.isEmpty():
        raise EmptyInputError("no scores to export")
    write_csv(score_columns(written), csv_path)


def write_standardised(people: DataFrame, target_name: str, path: str) -> None:
    """Standardised scores of every model as CSV, with the phenotype's status column."""
    write_csv(standardised_columns(people, target_name), path)


def standardised_columns(people: DataFrame, target_name: str) -> DataFrame:
    return people.select(
        "prs_id",
        F.col("s").alias("person_id"),
        F.col("score").alias("prs_total_score"),
        F.col("variant_count").alias("prs_variant_count"),
        F.col("normalized_score").alias("prs_normalized_score"),
        F.col("status").alias(status_column(target_name)),
        "prs_zscore",
        "prs_percentile",
        "risk_category",
        "prs_decile",
    )
