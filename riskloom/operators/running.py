"""Running totals over groups too large for one task.

``Window.partitionBy(model)`` would sort a whole model in a single task. Here
the rows are range-partitioned on (group, order), each slice is scanned on its
own, and the slices' totals - one row per slice and group - carry across.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskloom.sources.stored import store

_COMBINE = {
    "sum": (F.sum, lambda carried, local: F.coalesce(carried, F.lit(0)) + local),
    "max": (F.max, lambda carried, local: F.greatest(carried, local)),
}


def running(
    df: DataFrame, by: list[str], order: list[str], totals: dict[str, tuple[str, str]], label: str = "slices"
) -> DataFrame:
    """Add inclusive running aggregates, ``{new column: ("sum" | "max", column)}``.

    The whole group's aggregate comes along as ``<new column>_of_all``.

    Rows must be unique on (by, order): pre-aggregate first, so that a hot
    value is one row and any slice can be cut down to size.
    """
    # Writing fixes each row's slice: both readers below see the same cut.
    cut = store(
        df.repartitionByRange(*by, *order).withColumn("_slice", F.spark_partition_id()), label
    ).df
    within = Window.partitionBy(*by, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # One row per (group, slice): at most the number of partitions per group.
    earlier = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    everywhere = Window.partitionBy(*by)

    local = cut
    slice_totals = []
    carried = []
    for name, (kind, column) in totals.items():
        agg, _ = _COMBINE[kind]
        local = local.withColumn(f"_local_{name}", agg(column).over(within))
        slice_totals.append(agg(column).alias(f"_total_{name}"))
        carried.append(agg(f"_total_{name}").over(earlier).alias(f"_carry_{name}"))
        carried.append(agg(f"_total_{name}").over(everywhere).alias(f"{name}_of_all"))
    carry = cut.groupBy(*by, "_slice").agg(*slice_totals).select(*by, "_slice", *carried)

    # Keys equal the window's partitioning, so the large side is not shuffled again.
    joined = local.join(carry, [*by, "_slice"])
    results = [
        _COMBINE[kind][1](F.col(f"_carry_{name}"), F.col(f"_local_{name}")).alias(name)
        for name, (kind, _) in totals.items()
    ]
    return joined.select(*df.columns, *results, *[f"{name}_of_all" for name in totals])
