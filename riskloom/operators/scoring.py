"""Scores of many models in one pass over the genotypes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.genotype import dosage, effect_alternate_index, effect_is_reference
from riskloom.operators.genotypes import BlockedGenotypes, Genotypes
from riskloom.operators.pruning import calls_in_ranges, is_located, locus_ranges
from riskloom.schema import WEIGHTS, require_schema
from riskloom.sources.stored import BROADCAST_ROWS, Stored, new_path, save_bucketed, store

# Loci up to which the genotype calls stay where they are: some 50 bytes each, so
# about 200 MB per executor. Two genome-wide models have fewer.
LOCI_ROWS = 4_000_000


def scoring_loci(weights: DataFrame | Stored, variants: DataFrame) -> Stored:
    """Weights matched to variants on the locus; alleles need not agree.

    The weights are counted, and broadcast only if they are few enough; beyond that both sides shuffle on the locus.

    Whether the effect allele is the reference or which alternate it is gets
    decided here, once per variant and model, so each call compares integers.
    """
    known = weights if isinstance(weights, Stored) else store(weights, "weights")
    require_schema(known.df, {"prs_id": None, **WEIGHTS}, "weights")
    matched = variants.join(known.join_side(), ["contig", "position"]).select(
        "prs_id",
        "variant_id",
        "contig",
        "position",
        "weight",
        effect_is_reference(F.col("alleles"), F.col("effect_allele")).alias("effect_is_ref"),
        effect_alternate_index(F.col("alleles"), F.col("effect_allele")).alias("alternate_index"),
    )
    return store(matched, "scoring_loci")


def contributions(calls: DataFrame, loci: Stored, row_limit: int = LOCI_ROWS, buckets: int | None = None) -> DataFrame:
    """Dosage and dosage x weight of every call at a model's locus.

    Calls that carry their locus are read only where loci lie. Beyond
    ``row_limit`` loci, calls stored in ``buckets`` meet loci written in the same
    buckets, so that the calls stay where they are; other calls and the loci are
    shuffled by variant, where a variant with very many calls is split by
    adaptive execution.
    """
    if is_located(calls):
        calls = calls_in_ranges(calls, locus_ranges(loci.df)).drop("contig", "position")
    copies = dosage(F.col("a1"), F.col("a2"), F.col("effect_is_ref"), F.col("alternate_index"))
    side = loci.join_side(row_limit)
    if loci.rows > row_limit and buckets:
        wanted = loci.df.select("variant_id", "prs_id", "weight", "effect_is_ref", "alternate_index")
        side = save_bucketed(wanted, new_path(calls.sparkSession, "bucketed_loci"), buckets).hint("merge")
    return (
        calls.join(side, "variant_id")
        .withColumn("dosage", copies)
        .select(
            "prs_id", "s", "variant_id", "dosage", (F.col("dosage") * F.col("weight")).alias("contribution")
        )
    )


def score_models(
    genotypes: Genotypes, loci: Stored, members: DataFrame | None = None, row_limit: int = LOCI_ROWS
) -> DataFrame:
    """One row per sample and model that has at least one matched locus.

    Missing calls are left out of sum and count; a sample without any usable
    call scores 0.0 over 0 variants. ``members`` are the samples to report,
    by default all samples of ``genotypes``.

    The report list joins by union: each member adds an empty row per model to
    the rows being summed, and sums without such a row are dropped afterwards.
    That costs one shuffle for everything, whatever the size of the cohort. A
    counted list that is small enough also filters the calls where they lie, so
    that nobody else is summed.
    """
    calls = genotypes.calls
    if members is None:
        members = genotypes.samples
    else:
        listed = store(members.select("s").distinct(), "members")
        members = listed.df
        if listed.rows <= BROADCAST_ROWS:
            calls = calls.join(F.broadcast(listed.df), "s", "left_semi")
    called = contributions(calls, loci, row_limit, genotypes.buckets).select(
        "prs_id", "s", "contribution", F.lit(0).alias("is_member")
    )
    return _sum_up(called.unionByName(_empty_rows(members.select("s"), loci)), ["prs_id", "s"])


def score_blocked(genotypes: BlockedGenotypes, loci: Stored, row_limit: int = LOCI_ROWS) -> DataFrame:
    """As ``score_models`` on the variant-major layout.

    Whole rows are dropped by locus before their calls are unpacked, and
    partial sums are keyed by (model, block, slot) until the very end.
    """
    opened = genotypes.calls.join(loci.join_side(row_limit), "variant_id").select(
        "prs_id", "block", "weight", "effect_is_ref", "alternate_index", F.inline("calls")
    )
    copies = dosage(F.col("a1"), F.col("a2"), F.col("effect_is_ref"), F.col("alternate_index"))
    called = opened.select(
        "prs_id", "block", "slot", (copies * F.col("weight")).alias("contribution"), F.lit(0).alias("is_member")
    )
    everyone = _empty_rows(genotypes.members.select("block", "slot"), loci)
    totals = _sum_up(called.unionByName(everyone), ["prs_id", "block", "slot"])
    return totals.join(genotypes.members, ["block", "slot"]).select(
        "prs_id", "s", "total_score", "variant_count", "normalized_score"
    )


def scoring_status(manifest: DataFrame, weights: DataFrame, loci: Stored) -> DataFrame:
    """Per model of the manifest: clean weights, matched loci, and whether it can be scored."""
    usable = weights.groupBy("prs_id").agg(F.count(F.lit(1)).alias("n_weights"))
    matched = loci.df.groupBy("prs_id").agg(F.count(F.lit(1)).alias("n_loci"))
    counts = (
        manifest.select(F.col("id").cast("string").alias("prs_id"))
        .join(usable, "prs_id", "left")
        .join(matched, "prs_id", "left")
        .na.fill(0, ["n_weights", "n_loci"])
    )
    status = (
        F.when(F.col("n_weights") == 0, "no valid weights")
        .when(F.col("n_loci") == 0, "no overlap")
        .otherwise("scored")
    )
    return counts.withColumn("status", status)


def _empty_rows(members: DataFrame, loci: Stored) -> DataFrame:
    """A row without contribution per member and scorable model, i.e. per row of the result."""
    models = loci.df.agg(F.collect_set("prs_id")).scalar()
    return members.select(
        F.explode(models).alias("prs_id"),
        "*",
        F.lit(None).cast("double").alias("contribution"),
        F.lit(1).alias("is_member"),
    )


def _sum_up(rows: DataFrame, keys: list[str]) -> DataFrame:
    summed = rows.groupBy(*keys).agg(
        F.sum("contribution").alias("_sum"),
        F.count("contribution").alias("variant_count"),
        F.max("is_member").alias("_member"),
    )
    return summed.where(F.col("_member") == 1).select(
        *keys,
        F.coalesce("_sum", F.lit(0.0)).alias("total_score"),
        "variant_count",
        F.try_divide("_sum", "variant_count").alias("normalized_score"),
    )
