"""How well each model separates cases from controls, from the score profile alone."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.hypergeometric import run_sum, tail_runs
from riskloom.functions.numeric import percent
from riskloom.operators.distribution import ScoredCohort, quantile_bin, z_score
from riskloom.operators.logistic import odds_ratio_per_sd

# Fewer people than this have no meaningful 5 % tails.
MIN_FOR_TAILS = 40
# Tables with the same margins are summed in runs of this length; runs that a table sends at a time.
SUPPORT_RUN = 100_000
RUNS_AT_ONCE = 10_000


def _two_classes() -> Column:
    return (F.col("n_cases") > 0) & (F.col("n_cases") < F.col("n"))


def decile_prevalence(cohort: ScoredCohort) -> DataFrame:
    """Size, cases and prevalence (%) of every decile, empty ones included.

    Models without proper deciles, or with all people in one, have no rows.
    """
    found = (
        cohort.profile_with_models()
        .where("has_quantiles")
        .groupBy("prs_id", quantile_bin(F.col("score"), 10).alias("bin"))
        .agg(F.sum("n_tied").alias("n"), F.sum("cases_tied").alias("cases"))
    )
    # At most ten entries per model, so the empty deciles need no join.
    by_bin = found.groupBy("prs_id").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", F.struct("n", "cases")))).alias("held")
    )
    listed = by_bin.where(F.size("held") > 1).select(
        "prs_id", "held", F.explode(F.sequence(F.lit(1), F.lit(10))).alias("bin")
    )
    entry = F.try_element_at("held", F.col("bin"))
    n, cases = F.coalesce(entry["n"], F.lit(0)), F.coalesce(entry["cases"], F.lit(0))
    return listed.select(
        "prs_id",
        F.concat(F.lit("D"), F.col("bin").cast("string")).alias("prs_decile"),
        n.alias("n_people"),
        cases.alias("n_cases"),
        percent(cases, n).alias("prevalence_percent"),
    )


def roc_curve(cohort: ScoredCohort) -> DataFrame:
    """False and true positive rate at every distinct score, plus the origin.

    ``threshold`` is the z at and above which people count as positive, NULL at
    the origin. A model with one class has no curve.
    """
    usable = cohort.profile_with_models().where(_two_classes())
    # People at or above a score: all of them less those strictly below.
    cases_above = F.col("n_cases") - (F.col("cases_upto") - F.col("cases_tied"))
    above = F.col("n") - (F.col("n_upto") - F.col("n_tied"))
    # A degenerate model has z = 0 for everybody, hence a single threshold.
    points = usable.where(~F.col("degenerate") | (F.col("score") == F.col("min"))).select(
        "prs_id",
        z_score(F.col("score")).alias("threshold"),
        ((above - cases_above) / (F.col("n") - F.col("n_cases"))).alias("fpr"),
        (cases_above / F.col("n_cases")).alias("tpr"),
    )
    origin = cohort.models.df.where(_two_classes()).select(
        "prs_id",
        F.lit(None).cast("double").alias("threshold"),
        F.lit(0.0).alias("fpr"),
        F.lit(0.0).alias("tpr"),
    )
    return points.unionByName(origin)


def roc_auc(cohort: ScoredCohort) -> DataFrame:
    """Area under the curve: the share of case-control pairs ranked rightly, ties half.

    NULL for a single class, 0.5 for a degenerate model (all z equal).
    """
    controls_tied = F.col("n_tied") - F.col("cases_tied")
    controls_below = (F.col("n_upto") - F.col("cases_upto")) - controls_tied
    won = F.col("cases_tied") * (controls_below + controls_tied / 2.0)
    pairs = F.col("n_cases").cast("double") * (F.col("n") - F.col("n_cases"))
    return (
        cohort.profile_with_models()
        .select("prs_id", "degenerate", won.alias("_won"), pairs.alias("_pairs"))
        .groupBy("prs_id")
        .agg(
            F.when(F.first("_pairs") == 0, F.lit(None))
            .when(F.first("degenerate"), F.lit(0.5))
            .otherwise(F.try_divide(F.sum("_won"), F.first("_pairs")))
            .alias("auc")
        )
    )


def tail_thresholds(cohort: ScoredCohort) -> DataFrame:
    """5th and 95th percentile of the score and of z, for models whose tails can be compared."""
    q05, q95 = F.col("q")[1], F.col("q")[19]
    comparable = ~F.col("degenerate") & _two_classes() & (F.col("n") >= MIN_FOR_TAILS) & (q95 > q05)
    return cohort.models.df.where(comparable).select(
        "prs_id",
        q05.alias("score_p5"),
        q95.alias("score_p95"),
        z_score(q05).alias("z_p5"),
        z_score(q95).alias("z_p95"),
    )


def tail_comparison(cohort: ScoredCohort) -> DataFrame:
    """Cases among the lowest and the highest 5 %, thresholds included, per model."""
    thresholds = tail_thresholds(cohort)
    low = F.col("score") <= F.col("q")[1]
    high = F.col("score") >= F.col("q")[19]

    def total(column: str, where: Column, name: str) -> Column:
        return F.sum(F.when(where, F.col(column)).otherwise(0)).alias(name)

    groups = (
        cohort.profile_with_models()
        .where(low | high)
        .groupBy("prs_id")
        .agg(
            total("n_tied", low, "bottom_n"),
            total("cases_tied", low, "bottom_cases"),
            total("n_tied", high, "top_n"),
            total("cases_tied", high, "top_cases"),
        )
    )
    return thresholds.join(groups, "prs_id").select(
        "prs_id", "z_p5", "z_p95", "bottom_n", "bottom_cases",
        percent(F.col("bottom_cases"), F.col("bottom_n")).alias("bottom_prevalence"),
        "top_n", "top_cases",
        percent(F.col("top_cases"), F.col("top_n")).alias("top_prevalence"),
    )


def contingency(tails: DataFrame) -> DataFrame:
    """2x2 table of the tails: rows high and low, columns case and control."""
    return tails.select(
        "prs_id",
        F.col("top_cases").alias("high_cases"),
        (F.col("top_n") - F.col("top_cases")).alias("high_controls"),
        F.col("bottom_cases").alias("low_cases"),
        (F.col("bottom_n") - F.col("bottom_cases")).alias("low_controls"),
    )


def fisher_exact(tables: DataFrame, key: str = "prs_id") -> DataFrame:
    """Odds ratio and two-sided exact p of 2x2 tables.

    With a zero cell the odds ratio is taken after adding 0.5 to every cell;
    p always belongs to the integer table. The tables with the same margins
    that are no likelier form two tails; these are cut into runs, which are
    dealt over the tasks and each summed from one closed form. So the support may
    be as wide as it likes.
    """
    a, b = F.col("high_cases").cast("double"), F.col("high_controls").cast("double")
    c, d = F.col("low_cases").cast("double"), F.col("low_controls").cast("double")
    shift = F.when((a == 0) | (b == 0) | (c == 0) | (d == 0), 0.5).otherwise(0.0)
    odds_ratio = ((a + shift) * (d + shift)) / ((b + shift) * (c + shift))
    margins = tables.select(
        F.col(key).cast("string").alias("key"), odds_ratio.alias("odds_ratio"),
        *[F.col(n).cast("long").alias(n) for n in ("high_cases", "high_controls", "low_cases", "low_controls")],
    )
    size = SUPPORT_RUN

    def runs(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for r in frame.to_pylist():
                row, col = r["high_cases"] + r["high_controls"], r["high_cases"] + r["low_cases"]
                total = row + r["low_cases"] + r["low_controls"]
                found = tail_runs(r["high_cases"], row, col, total, size)
                for start in range(0, len(found), RUNS_AT_ONCE):
                    some = found[start : start + RUNS_AT_ONCE]
                    n = len(some)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "key": [r["key"]] * n, "odds_ratio": [r["odds_ratio"]] * n, "first": [f for f, _ in some],
                            "last": [e for _, e in some], "row": [row] * n, "col": [col] * n, "total": [total] * n,
                        }, schema=_RUNS,
                    )

    def sums(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            rows = frame.to_pylist()
            p = [run_sum(r["first"], r["last"], r["row"], r["col"], r["total"]) for r in rows]
            yield pa.RecordBatch.from_pydict({"key": frame.column("key"), "odds_ratio": frame.column("odds_ratio"), "p": pa.array(p, pa.float64())})

    ddl = "key string, odds_ratio double, first long, last long, row long, col long, total long"
    dealt = margins.mapInArrow(runs, ddl).repartition("key", "first")
    summed = dealt.mapInArrow(sums, "key string, odds_ratio double, p double").groupBy("key")
    return summed.agg(F.first("odds_ratio").alias("odds_ratio"), F.least(F.lit(1.0), F.sum("p")).alias("p_value")).withColumnRenamed("key", key)


_RUNS = pa.schema([("key", pa.string()), ("odds_ratio", pa.float64()), *[(n, pa.int64()) for n in ("first", "last", "row", "col", "total")]])


def tail_odds(cohort: ScoredCohort) -> DataFrame:
    """Fisher test of the highest against the lowest 5 % of each model."""
    return fisher_exact(contingency(tail_comparison(cohort)))


def model_summary(cohort: ScoredCohort) -> DataFrame:
    """One row per model; a figure that cannot be computed is NULL."""
    tails = tail_odds(cohort).withColumnsRenamed({"odds_ratio": "or_top_bottom", "p_value": "p_top_bottom"})
    return (
        cohort.models.df.select("prs_id", F.col("n").alias("n_analysed"))
        .join(roc_auc(cohort), "prs_id", "left")
        .join(odds_ratio_per_sd(cohort).drop("converged"), "prs_id", "left")
        .join(tails, "prs_id", "left")
    )


def summary_text(summary: DataFrame) -> DataFrame:
    """The summary with display precision and 'Not Calculated' for NULL."""

    def shown(name: str, digits: int) -> Column:
        return F.coalesce(F.format_number(name, digits), F.lit("Not Calculated")).alias(name)

    return summary.select("prs_id", "n_analysed", shown("auc", 4), shown("or_per_sd", 3), shown("or_top_bottom", 2))
