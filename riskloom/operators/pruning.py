"""Reading only that part of written calls in which scored loci lie.

Written calls are partitioned by contig and ordered by position. A table of loci, whatever its size, is summarised by
one row for each megabase that holds any; from these come a few position ranges a contig. Contigs without loci are
never listed, and of the others only row groups are read whose positions meet a range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOCUS = ("contig", "position")

# Bases summarised by one row: a contig of 2^31 bases has 2,048 such rows at most.
BIN = 1 << 20
# Ranges a contig's scan is given; more are joined across their narrowest gaps.
RANGES = 64

Ranges = dict[str, list[tuple[int, int]]]


def locus_ranges(loci: DataFrame, most: int = RANGES, bin_size: int = BIN) -> Ranges:
    """Per contig at most ``most`` closed position ranges, in order, that hold all loci."""
    bins = (
        loci.where(F.col("contig").isNotNull() & F.col("position").isNotNull())
        .groupBy("contig", F.floor(F.col("position") / bin_size).alias("bin"))
        .agg(F.min("position").alias("first"), F.max("position").alias("last"))
    )
    found: Ranges = {}
    for row in sorted(bins.collect()):  # bounded by the length of the genome
        found.setdefault(row["contig"], []).append((row["first"], row["last"]))
    return {contig: joined_ranges(ranges, most) for contig, ranges in found.items()}


def joined_ranges(ranges: list[tuple[int, int]], most: int) -> list[tuple[int, int]]:
    """The ranges, in order, joined across all gaps but the ``most - 1`` widest ones of more than one base."""
    gaps = sorted(((b[0] - a[1], i) for i, (a, b) in enumerate(zip(ranges, ranges[1:])) if b[0] - a[1] > 1), reverse=True)
    cuts = sorted(i for _, i in gaps[: most - 1])
    starts, ends = [0, *(i + 1 for i in cuts)], [*cuts, len(ranges) - 1]
    return [(ranges[a][0], ranges[b][1]) for a, b in zip(starts, ends)]


def is_located(calls: DataFrame) -> bool:
    return all(c in calls.columns for c in LOCUS)


def calls_in_ranges(calls: DataFrame, ranges: Ranges) -> DataFrame:
    """Calls at positions of the ranges: one scan a contig, each with filters its files can use."""
    if not ranges:
        return calls.where(F.lit(False))
    parts = []
    for contig in sorted(ranges):
        inside = F.lit(False)
        for first, last in ranges[contig]:
            inside = inside | F.col("position").between(first, last)
        parts.append(calls.where((F.col("contig") == contig) & inside))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
