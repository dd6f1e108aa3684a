"""Odds ratio per standard deviation: a penalised logistic fit per model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.distribution import ScoredCohort
from riskloom.sources.stored import BROADCAST_ROWS, store

MAX_ROUNDS = 20
# Newton steps per Spark job; the change is looked at between jobs.
STEPS_PER_ROUND = 3
TOLERANCE = 1e-10
# Longest Newton step per coefficient; only reached far from the optimum.
LONGEST_STEP = 2.0


def odds_ratio_per_sd(cohort: ScoredCohort) -> DataFrame:
    """exp(slope) of status on z, classes weighted equally, unit ridge on both coefficients.

    All models are fitted together. A Newton step needs five sums per model,
    taken over the profile (one row per distinct score). The state between
    steps is one row per model. No row for one class or a zero deviation; a
    degenerate model with some deviation has z = 0 throughout, hence 1. Models
    that have settled take no further steps. One that still moves after the last
    step has NULL and is marked as not ``converged``.
    """
    fittable = (F.col("n_cases") > 0) & (F.col("n_cases") < F.col("n")) & (F.col("std") > 0)
    half = F.col("n") / 2.0
    start = cohort.models.df.where(fittable).select(
        "prs_id", "mean", "std", "degenerate",
        (half / F.col("n_cases")).alias("case_weight"),
        (half / (F.col("n") - F.col("n_cases"))).alias("control_weight"),
        F.lit(0.0).alias("intercept"),
        F.lit(0.0).alias("slope"),
    )
    state, done = start, None
    is_settled = F.coalesce(F.col("_change") < TOLERANCE, F.lit(False))
    for _ in range(MAX_ROUNDS):
        for _ in range(STEPS_PER_ROUND):
            state = _newton_step(cohort, state)
        written = store(state, "logistic_state", moving=F.count_if(~is_settled))
        settled = written.df.where(is_settled)
        done = settled if done is None else done.unionByName(settled)
        state = written.df.where(~is_settled)
        if not written.figures["moving"]:
            break
    else:
        done = done.unionByName(state)
    return done.select("prs_id", F.when(is_settled, F.exp("slope")).alias("or_per_sd"), is_settled.alias("converged"))


# One Newton step in three projections; later columns use earlier ones of the same list.
_STATE = ["mean", "std", "degenerate", "case_weight", "control_weight", "intercept", "slope"]
_ROW_TERMS = [
    "if(degenerate, 0D, (score - mean) / std) as z",
    "1D / (1D + exp(-(intercept + slope * z))) as p",
    # Weighted residual and curvature of everybody who shares the score.
    "n_cases * case_weight * (1D - p) - (n - n_cases) * control_weight * p as r",
    "(n_cases * case_weight + (n - n_cases) * control_weight) * p * (1D - p) as h",
]
_SUMS = {
    "g0": "sum(r) - first(intercept)",
    "g1": "sum(r * z) - first(slope)",
    "h00": "sum(h) + 1D",
    "h01": "sum(h * z)",
    "h11": "sum(h * z * z) + 1D",
}
_STEP = [
    "h00 * h11 - h01 * h01 as det",
    f"greatest(least((h11 * g0 - h01 * g1) / det, {LONGEST_STEP}D), -{LONGEST_STEP}D) as d0",
    f"greatest(least((h00 * g1 - h01 * g0) / det, {LONGEST_STEP}D), -{LONGEST_STEP}D) as d1",
]


def _newton_step(cohort: ScoredCohort, state: DataFrame) -> DataFrame:
    known = state.select("prs_id", *_STATE)
    if cohort.models.rows <= BROADCAST_ROWS:  # the state has no more rows than there are models
        known = F.broadcast(known)
    rows = cohort.profile.df.join(known, "prs_id").selectExpr("prs_id", *_STATE, *_ROW_TERMS)
    sums = rows.groupBy("prs_id").agg(
        *[F.first(c).alias(c) for c in _STATE], *[F.expr(text).alias(name) for name, text in _SUMS.items()]
    )
    return sums.selectExpr("*", *_STEP).selectExpr(
        "prs_id", *_STATE[:-2], "intercept + d0 as intercept", "slope + d1 as slope",
        "greatest(abs(d0), abs(d1)) as _change",
    )
