"""Phenome-wide association scan: one logistic regression per phecode.

People are never multiplied by phecodes. A task holds a slice of the people
and the current coefficients of all phecodes (bounded by the phecode
vocabulary), and returns one row of partial sums per phecode; Spark adds them
up. A Newton step for every phecode is then one small linear solve each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.schema import EmptyInputError, require_schema
from riskloom.sources.stored import Stored, store

MIN_CASES = 20
MIN_COUNT = 2
# Phecodes fitted at a time; bounds the state of a task to a few MB.
PHECODES_PER_FIT = 4096
# People handled at a time inside a task.
SLICE = 2048
MAX_STEPS = 35
TOLERANCE = 1e-9

RESULT = (
    "phecode string, n_cases long, n_controls long, beta double, std_err double, odds_ratio double, "
    "ci_low double, ci_high double, p_value double, neg_log10_p double, converged boolean"
)


@dataclass(frozen=True)
class RiskRules:
    """Who may be a case or a control of a phecode.

    ``definitions`` has phecode, sex ("Male", "Female", anything else: both), and optionally exclude_first and
    exclude_last: with ``use_exclusions``, a person with any phecode between these two, compared as numbers, is no
    control. A phecode may have several rows, one for each range; a phecode without a row has no rule. ``sex`` names the
    cohort's column, 1 for men if ``male_as_one``, else 1 for women.
    """

    definitions: DataFrame
    sex: str
    male_as_one: bool = True
    use_exclusions: bool = False

    def is_male(self) -> Column:
        return F.col(self.sex) == F.lit(1 if self.male_as_one else 0)

    def limits(self) -> DataFrame:
        """(phecode, only_male) of the phecodes of one sex: a row each."""
        only = F.when(F.lower("sex") == "male", True).when(F.lower("sex") == "female", False)
        return self.definitions.groupBy("phecode").agg(F.max(only).alias("only_male")).where("only_male is not null")

    def related(self, counts: DataFrame) -> DataFrame:
        """(target, phecode): having ``phecode`` rules a person out as a control of ``target``.

        Ranges meet the phecodes on whole numbers first, so none is compared with all.
        """
        number = F.col("phecode").try_cast("double")
        known = counts.select("phecode").distinct().select("phecode", number.alias("value"), F.floor(number).alias("whole"))
        first, last = F.col("exclude_first").try_cast("double"), F.col("exclude_last").try_cast("double")
        ranges = self.definitions.select(F.col("phecode").alias("target"), first.alias("first"), last.alias("last")).where("first <= last")
        wholes = ranges.withColumn("whole", F.explode(F.sequence(F.floor("first"), F.floor("last"))))
        return known.join(wholes, "whole").where(F.col("value").between(F.col("first"), F.col("last"))).select("target", "phecode").distinct()


def phecode_case_counts(
    cohort: DataFrame, counts: DataFrame, min_count: int = MIN_COUNT, min_cases: int = MIN_CASES, rules: RiskRules | None = None
) -> DataFrame:
    """Cases, controls and left-out people per phecode with enough cases.

    A person with at least ``min_count`` occurrences is a case, with none a
    control, and otherwise neither. ``rules`` leave out the other sex, and
    controls with a related phecode.
    """
    marked = _marks(cohort, counts, min_count, rules)
    found = marked.groupBy("phecode").agg(
        F.count_if("is_case").alias("n_cases"), F.count_if(~F.col("is_case")).alias("n_excluded")
    )
    if rules is None:
        total = cohort.agg(F.count(F.lit(1))).scalar()
    else:
        found = found.join(rules.limits(), "phecode", "left")
        everybody, men = cohort.agg(F.count(F.lit(1))).scalar(), cohort.agg(F.count_if(rules.is_male())).scalar()
        total = F.when(F.col("only_male").isNull(), everybody).when(F.col("only_male"), men).otherwise(everybody - men)
    return (
        found.where(F.col("n_cases") >= min_cases)
        .select(
            "phecode", "n_cases", (total - F.col("n_cases") - F.col("n_excluded")).alias("n_controls"), "n_excluded"
        )
    )


def _marks(cohort: DataFrame, counts: DataFrame, min_count: int, rules: RiskRules | None = None) -> DataFrame:
    """One row per cohort member and phecode they have at all, or are ruled out of as a control.

    Summed before the join, after which no person has more rows than phecodes.
    """
    had = counts.where(F.col("n") > 0).groupBy("person_id", "phecode").agg((F.sum("n") >= min_count).alias("is_case"))
    if rules is None:
        return had.join(cohort.select("person_id"), "person_id", "left_semi")
    if rules.use_exclusions:
        ruled_out = had.select("person_id", "phecode").join(rules.related(counts), "phecode").select(
            "person_id", F.col("target").alias("phecode"), F.lit(False).alias("is_case")
        )
        had = had.unionByName(ruled_out).groupBy("person_id", "phecode").agg(F.max("is_case").alias("is_case"))
    people = cohort.select("person_id", rules.is_male().alias("is_male"))
    return (
        had.join(people, "person_id")
        .join(rules.limits(), "phecode", "left")
        .where(F.col("only_male").isNull() | (F.col("only_male") == F.col("is_male")))
        .select("person_id", "phecode", "is_case")
    )


def association_scan(
    cohort: DataFrame,
    counts: DataFrame,
    exposure: str,
    covariates: list[str],
    sex: str,
    min_count: int = MIN_COUNT,
    min_cases: int = MIN_CASES,
    rules: RiskRules | None = None,
) -> DataFrame:
    """Effect of ``exposure`` on every tested phecode, adjusted for covariates and sex.

    ``cohort``: person_id and numeric columns; members with a missing value are
    left out. ``counts``: person_id, phecode, n. ``rules`` give each phecode its
    own risk set; among people of one sex its coefficient is 0.
    """
    features = [exposure, *covariates, sex]
    require_schema(cohort, {"person_id": None, **{f: None for f in features}}, "association cohort")
    require_schema(counts, {"person_id": None, "phecode": None, "n": None}, "phecode counts")
    spark = cohort.sparkSession
    complete = store(
        cohort.select("person_id", *[F.col(f).cast("double").alias(f) for f in features]).dropna(), "scan_cohort"
    )
    if complete.rows == 0:
        raise EmptyInputError("no cohort member has all covariates")
    # One row per phecode of the vocabulary.
    tested = phecode_case_counts(complete.df, counts, min_count, min_cases, rules).orderBy("phecode").collect()
    limits = {r["phecode"]: r["only_male"] for r in rules.limits().collect()} if rules else {}
    scale = complete.df.agg(
        *[F.avg(f).alias(f"mean_{f}") for f in features], *[F.stddev_samp(f).alias(f"std_{f}") for f in features]
    ).first()
    # A constant column says the same as the intercept.
    varying = [f for f in features if scale[f"std_{f}"]]
    if exposure not in varying:
        raise ValueError(f"{exposure} does not vary in the cohort")

    results = []
    for start in range(0, len(tested), PHECODES_PER_FIT):
        block = tested[start : start + PHECODES_PER_FIT]
        people = _people(complete, counts, varying, scale, [r["phecode"] for r in block], min_count, rules)
        # 1: men only, 0: women only, -1: both.
        sexes = np.array([{True: 1, False: 0}.get(limits.get(r["phecode"]), -1) for r in block], dtype=np.int8)
        beta, covariance, converged = _fit(people, len(block), 1 + len(varying), sexes)
        for i, row in enumerate(block):
            results.append(_result(row, beta[i, 1], covariance[i, 1, 1], scale[f"std_{exposure}"], converged[i]))
    return spark.createDataFrame(results, RESULT)


def _people(
    complete: Stored, counts: DataFrame, features: list[str], scale, phecodes: list[str], min_count: int,
    rules: RiskRules | None,
) -> DataFrame:
    """x = (1, standardised features), with the numbers of the phecodes a person has, or is neither case nor control of."""
    spark = complete.df.sparkSession
    numbered = spark.createDataFrame(list(enumerate(phecodes)), "number int, phecode string")
    # At most PHECODES_PER_FIT rows, and as many entries per person.
    lists = (
        _marks(complete.df, counts, min_count, rules)
        .join(F.broadcast(numbered), "phecode")
        .groupBy("person_id")
        .agg(
            F.collect_list(F.when(F.col("is_case"), F.col("number"))).alias("cases"),
            F.collect_list(F.when(~F.col("is_case"), F.col("number"))).alias("excluded"),
        )
    )
    x = F.array(F.lit(1.0), *[(F.col(f) - scale[f"mean_{f}"]) / scale[f"std_{f}"] for f in features])
    none = F.array().cast("array<int>")
    return store(
        complete.df.join(lists, "person_id", "left").select(
            x.alias("x"), (rules.is_male() if rules else F.lit(True)).alias("is_male"), F.coalesce("cases", none).alias("cases"), F.coalesce("excluded", none).alias("excluded")
        ),
        "scan_people",
    ).df


def _fit(people: DataFrame, n_phecodes: int, width: int, sexes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Newton's method for all phecodes at once: coefficients, covariances, converged."""
    beta = np.zeros((n_phecodes, width))
    covariance = np.full((n_phecodes, width, width), np.nan)
    converged = np.zeros(n_phecodes, dtype=bool)
    upper = np.triu_indices(width)
    for _ in range(MAX_STEPS):
        active = np.flatnonzero(~converged & np.isfinite(beta).all(axis=1))
        if not len(active):
            break
        gradient, packed = _sums(people, active, beta[active], upper, sexes[active])
        hessian = np.zeros((len(active), width, width))
        hessian[:, upper[0], upper[1]] = packed
        hessian[:, upper[1], upper[0]] = packed
        # The pseudo-inverse copes with a covariate that is constant among a phecode's people.
        inverse = np.linalg.pinv(hessian, rcond=1e-12, hermitian=True)
        step = np.einsum("pij,pj->pi", inverse, gradient)
        beta[active] += step
        covariance[active] = inverse
        converged[active] = np.abs(step).max(axis=1) < TOLERANCE
    return beta, covariance, converged


def _sums(people: DataFrame, active: np.ndarray, beta: np.ndarray, upper, sexes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and packed upper Hessian of the log likelihood, per active phecode."""
    width = beta.shape[1]
    n_sums = width + len(upper[0])
    names = [f"s{i}" for i in range(n_sums)]
    slice_rows = SLICE
    one_sex = np.flatnonzero(sexes >= 0)

    def mark(matrix: np.ndarray, lists: pa.ListArray, shift: float, factor: float) -> None:
        """x -> factor * x + shift at every (person, phecode being fitted) listed."""
        numbers = lists.flatten().to_numpy(zero_copy_only=False)
        person = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        place = np.minimum(np.searchsorted(active, numbers), len(active) - 1)
        fitted = active[place] == numbers
        at = (person[fitted], place[fitted])
        matrix[at] = factor * matrix[at] + shift

    # Nested, so that it travels to the workers whole.
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(active), n_sums))
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                part = batch.slice(at, slice_rows)
                x = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                p = 0.5 * (1.0 + np.tanh(0.5 * (x @ beta.T)))
                curvature = p * (1.0 - p)
                residual = -p
                mark(residual, part.column("cases"), 1.0, 1.0)
                mark(residual, part.column("excluded"), 0.0, 0.0)
                mark(curvature, part.column("excluded"), 0.0, 0.0)
                if len(one_sex):
                    male = part.column("is_male").to_numpy(zero_copy_only=False)
                    outside = male[:, None] != (sexes[one_sex] == 1)[None, :]
                    for matrix in (residual, curvature):
                        matrix[:, one_sex] = np.where(outside, 0.0, matrix[:, one_sex])
                total[:, :width] += residual.T @ x
                total[:, width:] += curvature.T @ (x[:, upper[0]] * x[:, upper[1]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(active.astype("int32")), *[pa.array(total[:, i]) for i in range(n_sums)]], ["number", *names]
        )

    schema = "number int, " + ", ".join(f"{n} double" for n in names)
    added = (
        people.mapInArrow(partial, schema).groupBy("number").agg(*[F.sum(n).alias(n) for n in names]).orderBy("number")
    )
    # One row per active phecode.
    table = added.toArrow()
    sums = np.column_stack([table.column(n).to_numpy() for n in names])
    return sums[:, :width], sums[:, width:]


def _result(row, beta: float, variance: float, scale: float, converged: bool) -> tuple:
    """A result row with the effect brought back to the exposure's own unit."""
    base = (row["phecode"], row["n_cases"], row["n_controls"])
    if not (np.isfinite(beta) and variance > 0):
        return (*base, *[None] * 7, False)
    effect, error = float(beta) / scale, math.sqrt(variance) / scale
    z = abs(effect / error)
    p = math.erfc(z / math.sqrt(2.0))
    if p > 0:
        neg_log10_p = -math.log10(p)
    else:  # far tail, where p underflows
        neg_log10_p = (z * z / 2.0 + math.log(z * math.sqrt(math.pi / 2.0))) / math.log(10.0)
    reach = 1.959963984540054 * error
    try:
        ratios = [math.exp(v) for v in (effect, effect - reach, effect + reach)]
    except OverflowError:
        ratios = [None] * 3
    return (*base, effect, error, *ratios, p, neg_log10_p, bool(converged))


def bonferroni_threshold(results: DataFrame, alpha: float = 0.05) -> DataFrame:
    """One row: phecodes tested and the significance threshold on the -log10 scale."""
    threshold = -F.log10(F.lit(alpha) / F.nullif(F.col("n_tested"), F.lit(0)))
    return results.agg(F.count("p_value").alias("n_tested")).withColumn("threshold", threshold)


def bonferroni_hits(results: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Results beyond the threshold; none if nothing was tested."""
    threshold = bonferroni_threshold(results, alpha).select("threshold").scalar()
    return results.where(F.col("neg_log10_p") > threshold)


def scan_summary(results: DataFrame, alpha: float = 0.05) -> DataFrame:
    """One row: tested, threshold, number of results beyond it."""
    threshold = bonferroni_threshold(results, alpha)
    beyond = bonferroni_hits(results, alpha).agg(F.count(F.lit(1))).scalar()
    return threshold.withColumn("n_above", beyond)
