"""Running totals across slices, against brute force."""

import random

from pyspark.sql import functions as F

from riskloom.operators.running import running


def test_running_sum_and_max_cross_slices(spark):
    rng = random.Random(1)
    # One group holds nearly everything, so it must span slices.
    rows = [("big", i, rng.randint(-5, 5), rng.randint(0, 10**6)) for i in range(4000)]
    rows += [(g, i, i, i * 3) for g in ("a", "z") for i in range(7)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, k int, x long, m long").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = running(df, ["g"], ["k"], {"total": ("sum", "x"), "top": ("max", "m")}).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    expected = {}
    for g in ("big", "a", "z"):
        total, top = 0, 0
        for _, k, x, m in sorted(r for r in rows if r[0] == g):
            total, top = total + x, max(top, m)
            expected[g, k] = (total, top)
    assert {(r["g"], r["k"]): (r["total"], r["top"]) for r in out} == expected
    grand = {g: expected[g, max(k for h, k in expected if h == g)] for g in ("big", "a", "z")}
    assert {(r["g"], r["total_of_all"], r["top_of_all"]) for r in out} == {(g, *v) for g, v in grand.items()}


def test_max_ignores_nulls(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, 5), ("a", 3, None)], "g string, k int, m int")
    out = running(df, ["g"], ["k"], {"top": ("max", "m")}).orderBy("k").select(F.col("top")).collect()
    assert [r[0] for r in out] == [None, 5, 5]
