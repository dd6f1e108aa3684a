"""Genotype tables and their layouts."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.running import running
from riskloom.sources.stored import Stored, store


@dataclass(frozen=True)
class Genotypes:
    """Dense genotypes: ``variants``, ``samples`` and one ``calls`` row per pair.

    Calls may carry their ``contig`` and ``position``, and may be stored in ``buckets`` of their variant.
    """

    samples: DataFrame
    variants: DataFrame
    calls: DataFrame
    buckets: int | None = None

    def with_samples(self, kept: Stored) -> Genotypes:
        """Restrict calls by a measured sample list: broadcast if small, else shuffled."""
        return replace(self, samples=kept.df, calls=self.calls.join(kept.join_side(), "s", "left_semi"))


@dataclass(frozen=True)
class SparseGenotypes:
    """Two-component genotypes: variant calls plus reference blocks, sharing samples."""

    samples: DataFrame
    variants: DataFrame
    calls: DataFrame
    reference_blocks: DataFrame

    def with_samples(self, kept: Stored) -> SparseGenotypes:
        side = kept.join_side()
        return replace(
            self,
            samples=kept.df,
            calls=self.calls.join(side, "s", "left_semi"),
            reference_blocks=self.reference_blocks.join(side, "s", "left_semi"),
        )


def dataset_counts(genotypes: Genotypes) -> DataFrame:
    """One row of data-quality counters, one pass per table."""
    calls = genotypes.calls.agg(
        F.count(F.lit(1)).alias("n_calls"),
        F.count("a1").alias("n_called"),
        F.coalesce(F.sum("a1"), F.lit(0)).cast("long").alias("sum_a1"),
        F.coalesce(F.sum("a2"), F.lit(0)).cast("long").alias("sum_a2"),
    )
    variants = genotypes.variants.agg(F.count(F.lit(1)).alias("n_variants"))
    samples = genotypes.samples.agg(F.count(F.lit(1)).alias("n_samples"))
    return calls.select(
        samples.scalar().alias("n_samples"), variants.scalar().alias("n_variants"), "*"
    )


@dataclass(frozen=True)
class BlockedGenotypes:
    """Variant-major layout: one row per variant and block of samples.

    ``calls`` holds an array of (slot, a1, a2), never longer than a block, and
    ``members`` says which sample sits in which slot. Loci are dropped before
    anything is exploded, and sums run on two integers instead of a text id.
    """

    members: DataFrame
    calls: DataFrame


def sample_slots(samples: DataFrame, block_size: int) -> Stored:
    """(s, block, slot): samples numbered in order of their id, ``block_size`` to a block."""
    numbered = running(
        samples.select("s", F.lit(0).alias("_all"), F.lit(1).cast("long").alias("_one")),
        ["_all"], ["s"], {"_upto": ("sum", "_one")}, "sample_index",
    )
    index = F.col("_upto") - 1
    slots = numbered.select("s", F.floor(index / block_size).cast("int").alias("block"), (index % block_size).cast("int").alias("slot"))
    return store(slots, "sample_blocks")


def variant_places(variants: DataFrame, run_size: int, by_contig: bool = False) -> Stored:
    """(variant_id, contig, position, run, place): ``run_size`` variants that follow one another make a run.

    Runs are numbered along the genome, or within each contig.
    """
    listed = variants.select("variant_id", "contig", "position", F.lit(0).alias("_all"), F.lit(1).cast("long").alias("_one"))
    by, order = (["contig"], ["position", "variant_id"]) if by_contig else (["_all"], ["contig", "position", "variant_id"])
    placed = running(listed, by, order, {"_upto": ("sum", "_one")}, "variant_index")
    index = F.col("_upto") - 1
    run, place = F.floor(index / run_size), (index % run_size).cast("int")
    return store(placed.select("variant_id", "contig", "position", run.alias("run"), place.alias("place")), "variant_runs")


def to_blocks(genotypes: Genotypes, block_size: int = 4096) -> BlockedGenotypes:
    """Regroup long calls into blocks of at most ``block_size`` samples."""
    members = sample_slots(genotypes.samples, block_size)
    calls = (
        genotypes.calls.join(members.join_side(), "s")
        .groupBy("variant_id", "block")
        .agg(F.collect_list(F.struct("slot", "a1", "a2")).alias("calls"))
    )
    return BlockedGenotypes(members.df, calls)
