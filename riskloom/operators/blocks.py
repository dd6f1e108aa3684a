"""Reference blocks of the sparse layout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BLOCK_LENGTH = 10_000


def split_reference_blocks(blocks: DataFrame, max_length: int = MAX_BLOCK_LENGTH) -> DataFrame:
    """Cut long blocks into consecutive ones of at most ``max_length`` bases.

    Positions are closed at both ends and the same bases stay covered.
    """
    others = [c for c in blocks.columns if c not in ("start_pos", "end_pos")]
    pieces = blocks.where(F.col("start_pos") <= F.col("end_pos")).select(
        *others,
        "end_pos",
        F.explode(F.sequence("start_pos", "end_pos", F.lit(max_length))).alias("_from"),
    )
    end = F.least(F.col("_from") + (max_length - 1), F.col("end_pos"))
    return pieces.select(*others, F.col("_from").alias("start_pos"), end.alias("end_pos")).select(*blocks.columns)
