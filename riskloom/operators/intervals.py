"""Locus intervals, closed at both ends."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.running import running
from riskloom.sources.stored import store

# Different intervals up to which an index of them goes to every task: 16 bytes each.
INDEX_ROWS = 1_000_000


def extract_intervals(weights: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Distinct one-base intervals at the loci of a weight table."""
    keys = list(by or [])
    return weights.select(
        *keys, "contig", F.col("position").alias("start_pos"), F.col("position").alias("end_pos")
    ).distinct()


def valid_intervals(intervals: DataFrame) -> DataFrame:
    """Intervals with a contig and 1 <= start <= end; the others are skipped."""
    return intervals.where(
        F.col("contig").isNotNull() & (F.col("start_pos") >= 1) & (F.col("start_pos") <= F.col("end_pos"))
    )


def point_semi_join(variants: DataFrame, loci: DataFrame) -> DataFrame:
    """Variants at exactly the given loci (an interval list of single bases)."""
    return variants.join(loci.select("contig", "position").distinct(), ["contig", "position"], "left_semi")


class IntervalIndex:
    """Merged intervals of each contig as sorted arrays of starts and ends."""

    def __init__(self, contigs: list[str], starts: np.ndarray, ends: np.ndarray):
        self.parts: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        names = np.array(contigs, object)
        for contig in set(contigs):
            own = names == contig
            first, last = starts[own], ends[own]
            order = np.argsort(first, kind="stable")
            first, reach = first[order], np.maximum.accumulate(last[order])
            fresh = np.concatenate(([True], first[1:] > reach[:-1]))
            self.parts[contig] = (first[fresh], reach[np.concatenate((np.flatnonzero(fresh)[1:] - 1, [len(first) - 1]))])

    def covers(self, contigs: pa.Array, positions: pa.Array) -> np.ndarray:
        """Whether each position lies in an interval: a bisection among its contig's starts."""
        coded = contigs.dictionary_encode()
        code = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        position = positions.fill_null(-1).to_numpy(zero_copy_only=False)
        inside = np.zeros(len(code), bool)
        for i, contig in enumerate(coded.dictionary.to_pylist()):
            if contig in self.parts:
                starts, ends = self.parts[contig]
                rows = np.flatnonzero(code == i)
                at = np.searchsorted(starts, position[rows], side="right") - 1
                inside[rows] = (at >= 0) & (position[rows] <= ends[np.maximum(at, 0)])
        return inside


def interval_semi_join(variants: DataFrame, intervals: DataFrame, row_limit: int = INDEX_ROWS) -> DataFrame:
    """Variants inside any interval, without comparing variants to intervals in pairs.

    Up to ``row_limit`` different intervals, counted when they are written, go to
    every task as a sorted index that the scan of the variants looks up, so
    the variants stay where they are. More are walked along the genome.
    """
    listed = store(valid_intervals(intervals).select("contig", "start_pos", "end_pos").distinct(), "intervals")
    if listed.rows > row_limit:
        return walked_semi_join(variants, listed.df)
    found = listed.df.toArrow()
    index = IntervalIndex(
        found.column("contig").to_pylist(), *[found.column(c).to_numpy().astype(np.int64) for c in ("start_pos", "end_pos")]
    )
    shared = variants.sparkSession.sparkContext.broadcast(index)

    @F.arrow_udf("boolean")
    def covered(contig: pa.Array, position: pa.Array) -> pa.Array:
        return pa.array(shared.value.covers(contig, position))

    return variants.where(covered("contig", "position"))


def walked_semi_join(variants: DataFrame, intervals: DataFrame) -> DataFrame:
    """As ``interval_semi_join``, for any number of intervals.

    Walking a contig from left to right, a position is covered exactly when the
    furthest end among the intervals begun so far has not been passed. That is
    a running maximum, so neither long, nested nor piled-up intervals multiply
    rows. Starts and positions are made distinct first.
    """
    begun = (
        valid_intervals(intervals)
        .groupBy("contig", F.col("start_pos").alias("position"))
        .agg(F.max("end_pos").alias("_end"))
        .withColumn("_kind", F.lit(0))
    )
    asked = (
        variants.select("contig", "position")
        .distinct()
        .select("contig", "position", F.lit(None).cast("int").alias("_end"), F.lit(1).alias("_kind"))
    )
    # At one position an interval start (0) comes before the question (1).
    walked = running(
        begun.unionByName(asked), ["contig"], ["position", "_kind"], {"_reach": ("max", "_end")}, "interval_walk"
    )
    covered = walked.where((F.col("_kind") == 1) & (F.col("_reach") >= F.col("position")))
    return variants.join(covered.select("contig", "position"), ["contig", "position"], "left_semi")
