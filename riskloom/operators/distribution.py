"""Where each person's score lies within the model's scores.

Everything rank-like is derived from a *profile*: one row per model and
distinct score with the number of people and cases at and below it. Ties are
one row there, and its running totals are computed slice by slice, so no model
is ever sorted in one task. Ranks and bins use the raw score; z is a monotone
map of it and rounding in z could split or merge ties.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.numeric import finite
from riskloom.operators.running import running
from riskloom.schema import EmptyInputError
from riskloom.sources.stored import Stored, store

# Fewer distinct scores than this are not standardised.
MIN_DISTINCT = 10
# Quantiles are kept at every twentieth: quintiles, deciles, quartiles and 5 % tails.
TWENTIETHS = 20
# A score shared by more people than this is joined in several parts.
ROWS_PER_KEY = 100_000
MAX_HOT_KEYS = 100_000
# Scores that meet a density's grid at a time, and models whose sums a task holds.
DENSITY_ROWS = 2048
DENSITY_MODELS = 10_000


@dataclass(frozen=True)
class ScoredCohort:
    """Scores with labels, written once and measured.

    people:  prs_id, s, score, status, variant_count, normalized_score
    profile: prs_id, score, n, n_cases, n_upto, cases_upto (people and cases at
             that score, and at or below it), n_upto_of_all, cases_upto_of_all
    models:  one row per model: n, n_cases, mean, std, min, max, n_distinct,
             q (21 quantiles), degenerate, has_quantiles
    """

    people: Stored
    profile: Stored
    models: Stored

    def profile_with_models(self) -> DataFrame:
        """Profile rows next to their model's statistics; counts of the row are *_tied."""
        profile = self.profile.df.withColumnsRenamed({"n": "n_tied", "n_cases": "cases_tied"})
        return profile.join(self.models.join_side(), "prs_id")


def join_status(scores: DataFrame, labelled: DataFrame, status: str = "phenotype_status") -> DataFrame:
    """Scores of labelled people; unusable scores and labels become NULL."""
    labels = labelled.select("s", F.col(status).cast("long").alias("status"))
    return scores.join(labels, "s").select(
        "prs_id",
        "s",
        finite(F.col("total_score")).alias("score"),
        "status",
        "variant_count",
        finite(F.col("normalized_score")).alias("normalized_score"),
    )


def _usable() -> Column:
    return F.col("score").isNotNull() & F.col("status").isNotNull()


def dropped_rows(joined: DataFrame) -> DataFrame:
    """Per model, the rows left out for an unusable score or label."""
    return joined.groupBy("prs_id").agg(
        F.count(F.lit(1)).alias("n_joined"), F.count_if(~_usable()).alias("n_dropped")
    )


def scored_cohort(joined: DataFrame) -> ScoredCohort:
    """Write people, profile and model statistics for the operators below."""
    people = store(joined.where(_usable()), "scored_people")
    if people.rows == 0:
        raise EmptyInputError("no labelled person has a usable score")
    counts = people.df.groupBy("prs_id", "score").agg(
        F.count(F.lit(1)).alias("n"), F.sum("status").alias("n_cases")
    )
    profile = store(
        running(
            counts, ["prs_id"], ["score"],
            {"n_upto": ("sum", "n"), "cases_upto": ("sum", "n_cases")}, "profile_slices",
        ),
        "score_profile",
    )
    return ScoredCohort(people, profile, store(_model_statistics(people, profile), "model_statistics"))


def _model_statistics(people: Stored, profile: Stored) -> DataFrame:
    moments = people.df.groupBy("prs_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("status").alias("n_cases"),
        F.avg("score").alias("mean"),
        F.stddev_samp("score").alias("std"),
        F.min("score").alias("min"),
        F.max("score").alias("max"),
    )
    distinct = profile.df.groupBy("prs_id").agg(F.count(F.lit(1)).alias("n_distinct"))
    quantiles = exact_quantiles(profile.df)
    degenerate = (
        F.col("std").isNull() | F.isnan("std") | (F.col("std") == 0) | (F.col("n_distinct") < MIN_DISTINCT)
    )

    def all_differ(parts: int) -> Column:
        step = TWENTIETHS // parts
        edges = F.array(*[F.col("q")[i] for i in range(0, TWENTIETHS + 1, step)])
        return F.size(F.array_distinct(edges)) == parts + 1

    return (
        moments.join(distinct, "prs_id")
        .join(quantiles, "prs_id")
        .withColumn("degenerate", degenerate)
        .withColumn("has_quantiles", ~F.col("degenerate") & all_differ(5) & all_differ(10))
    )


def exact_quantiles(profile: DataFrame) -> DataFrame:
    """Linearly interpolated quantiles at 0, 1/20 .. 1 per model, as the array ``q``.

    Quantile k/20 lies at index k(n-1)/20 of the sorted scores, between two
    neighbours. A profile row holds the indices n_upto - n .. n_upto - 1, so
    each of the 42 wanted indices is read off without sorting or collecting.
    """
    last = F.col("n_upto_of_all") - 1
    first, end = F.col("n_upto") - F.col("n"), F.col("n_upto")
    # Plain arithmetic drops the rows without any wanted index: k(n-1)/20 or its
    # upper neighbour falls into [first, end) only for a k between these two.
    least_k = F.ceil(F.greatest(first - 1, F.lit(0)) * TWENTIETHS / F.greatest(last, F.lit(1)))
    most_k = F.floor((end * TWENTIETHS - 1) / F.greatest(last, F.lit(1)))
    candidate = (last < 1) | (F.least(most_k, F.lit(TWENTIETHS)) >= least_k)

    def wanted(side: int) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.lit(TWENTIETHS)),
            lambda k: F.struct(
                k.alias("k"),
                F.lit(side).alias("side"),
                F.least(F.floor((k * last) / TWENTIETHS).cast("long") + side, last).alias("index"),
                ((k * last) % TWENTIETHS).alias("twentieths"),
            ),
        )

    held = (
        profile.where(candidate)
        .select(
            "prs_id",
            "score",
            F.filter(
                F.concat(wanted(0), wanted(1)), lambda w: (w["index"] >= first) & (w["index"] < end)
            ).alias("hits"),
        )
        .where(F.size("hits") > 0)
        .select("prs_id", "score", F.inline("hits"))
    )
    lower = F.max(F.when(F.col("side") == 0, F.col("score")))
    upper = F.max(F.when(F.col("side") == 1, F.col("score")))
    share = F.max("twentieths") / F.lit(float(TWENTIETHS))
    edges = held.groupBy("prs_id", "k").agg((lower + (upper - lower) * share).alias("value"))
    return edges.groupBy("prs_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("k", "value"))), lambda e: e["value"]).alias("q")
    )


def z_score(score: Column) -> Column:
    """z of a raw-scale value, from the model columns alongside; 0 if degenerate."""
    return F.when(F.col("degenerate"), F.lit(0.0)).otherwise((score - F.col("mean")) / F.col("std"))


def quantile_bin(score: Column, parts: int) -> Column:
    """1..parts; bins are closed on the right, so tied scores share one."""
    step = TWENTIETHS // parts
    bin_number = F.lit(1)
    for edge in range(step, TWENTIETHS, step):
        bin_number = bin_number + (score > F.col("q")[edge]).cast("int")
    return bin_number


def quantile_label(score: Column, parts: int, prefix: str, degenerate_label: str) -> Column:
    """'D1'..; one fixed label for a degenerate model, 'NA' where edges coincide."""
    return (
        F.when(F.col("degenerate"), F.lit(degenerate_label))
        .when(~F.col("has_quantiles"), F.lit("NA"))
        .otherwise(F.concat(F.lit(prefix), quantile_bin(score, parts).cast("string")))
    )


def risk_category(score: Column) -> Column:
    return quantile_label(score, 5, "Q", "Average")


def decile(score: Column) -> Column:
    return quantile_label(score, 10, "D", "D5")


def percentile_rank() -> Column:
    """Average rank of a profile row's tied people, as a percentage of the model's n."""
    rank = F.col("n_upto") - F.col("n_tied") + (F.col("n_tied") + 1) / 2.0
    return F.when(F.col("degenerate"), F.lit(50.0)).otherwise(rank / F.col("n") * 100.0)


def binned_people(cohort: ScoredCohort) -> DataFrame:
    """People with z, quintile and decile; needs nothing but the model statistics."""
    score = F.col("score")
    return cohort.people.df.join(cohort.models.join_side(), "prs_id").select(
        *cohort.people.df.columns,
        z_score(score).alias("prs_zscore"),
        risk_category(score).alias("risk_category"),
        decile(score).alias("prs_decile"),
    )


def standardised_scores(cohort: ScoredCohort, rows_per_key: int = ROWS_PER_KEY) -> DataFrame:
    """People with z, percentile, quintile and decile."""
    return _lookup_by_score(binned_people(cohort), _ranks(cohort), cohort.people.rows, rows_per_key)


def _ranks(cohort: ScoredCohort) -> DataFrame:
    return cohort.profile_with_models().select(
        "prs_id", "score", "n_tied", percentile_rank().alias("prs_percentile")
    )


def _lookup_by_score(people: DataFrame, ranks: DataFrame, n_people: int, rows_per_key: int) -> DataFrame:
    """Give each person the rank of their score, however many share one score.

    Scores shared by more than ``limit`` people are split: their rank row is
    repeated and their people are dealt out by id. At most n_people / limit
    scores can be that common, which bounds the broadcast list of them.
    """
    limit = max(rows_per_key, math.ceil(n_people / MAX_HOT_KEYS))
    if n_people <= limit:
        return people.join(ranks.drop("n_tied"), ["prs_id", "score"])
    parts = F.ceil(F.col("n_tied") / limit).cast("int")
    common = ranks.where(F.col("n_tied") > limit).select("prs_id", "score", parts.alias("_parts"))
    dealt = people.join(F.broadcast(common), ["prs_id", "score"], "left").withColumn(
        "_part", F.coalesce(F.pmod(F.xxhash64("s"), F.col("_parts")).cast("int"), F.lit(0))
    )
    repeated = ranks.withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("n_tied")
    return dealt.join(repeated, ["prs_id", "score", "_part"]).drop("_part", "_parts")


def describe_scores(cohort: ScoredCohort) -> DataFrame:
    """count, mean, std, min, quartiles and max of the raw score and of z, per model."""
    raw = {"min": F.col("min"), "p25": F.col("q")[5], "p50": F.col("q")[10], "p75": F.col("q")[15], "max": F.col("max")}
    models = cohort.models.df
    of_score = models.select(
        "prs_id", F.lit("score").alias("measure"), "n", "mean", "std", *[c.alias(k) for k, c in raw.items()]
    )
    of_z = models.select(
        "prs_id",
        F.lit("zscore").alias("measure"),
        "n",
        F.lit(0.0).alias("mean"),
        F.when(F.col("degenerate"), 0.0).otherwise(1.0).alias("std"),
        *[z_score(c).alias(k) for k, c in raw.items()],
    )
    return of_score.unionByName(of_z)


def histogram(cohort: ScoredCohort, bins: int = 50) -> DataFrame:
    """People per equal-width bin of z; empty bins are listed, the last bin is closed.

    The bin is found on the raw scale, where scores on an edge are exact.
    """
    constant = F.col("degenerate") | (F.col("max") == F.col("min"))
    low = F.when(constant, F.lit(-0.5)).otherwise(z_score(F.col("min")))
    high = F.when(constant, F.lit(0.5)).otherwise(z_score(F.col("max")))
    place = F.floor((F.col("score") - F.col("min")) * float(bins) / (F.col("max") - F.col("min")))
    number = F.when(constant, F.lit(bins // 2)).otherwise(F.least(place, F.lit(bins - 1))).cast("int")

    filled = (
        cohort.profile_with_models()
        .groupBy("prs_id", number.alias("bin"))
        .agg(F.sum("n_tied").alias("n_people"))
    )
    width = (high - low) / float(bins)
    listed = cohort.models.df.select(
        "prs_id", low.alias("_low"), width.alias("_width"), F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    )
    return listed.join(filled, ["prs_id", "bin"], "left").select(
        "prs_id",
        "bin",
        (F.col("_low") + F.col("bin") * F.col("_width")).alias("bin_start"),
        (F.col("_low") + (F.col("bin") + 1) * F.col("_width")).alias("bin_end"),
        F.coalesce("n_people", F.lit(0)).cast("long").alias("n_people"),
    )


def kernel_density(cohort: ScoredCohort, points: int = 200, reach: float = 3.0) -> DataFrame:
    """Gaussian kernel density of z on an even grid, with Scott's bandwidth.

    The grid spans ``reach`` bandwidths beyond the scores. A task adds its
    profile rows up in one array of ``points`` sums a model; these arrays, not the
    profile, meet in the last sum. Degenerate models have no density.
    """
    bandwidth = F.pow(F.col("n").cast("double"), F.lit(-0.2))
    start = z_score(F.col("min")) - reach * bandwidth
    stop = z_score(F.col("max")) + reach * bandwidth
    models = cohort.models.df.where(~F.col("degenerate")).select(
        "prs_id", "mean", "std", "degenerate",
        F.col("n").alias("n_total"),
        bandwidth.alias("bandwidth"),
        start.alias("start"),
        ((stop - start) / float(points - 1)).alias("step"),
    )
    side = F.broadcast(models) if cohort.models.rows <= MAX_HOT_KEYS else models
    met = cohort.profile.df.join(side, "prs_id").select(
        "prs_id", F.col("n").cast("double").alias("n"), z_score(F.col("score")).alias("z"), "n_total", "bandwidth", "start", "step"
    )
    shape = ("n_total", "bandwidth", "start", "step")

    def add(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, tuple[dict, np.ndarray]] = {}
        for frame in frames:
            coded = frame.column("prs_id").dictionary_encode()
            own = coded.indices.to_numpy()
            n, z = frame.column("n").to_numpy(), frame.column("z").to_numpy()
            cuts = np.flatnonzero(np.diff(own, prepend=-1, append=-1)).tolist()
            for a, b in zip(cuts, cuts[1:]):
                name = coded.dictionary[own[a]].as_py()
                if name not in sums:
                    sums[name] = ({c: frame.column(c)[a].as_py() for c in shape}, np.zeros(points))
                model, total = sums[name]
                grid = model["start"] + np.arange(points) * model["step"]
                for at in range(a, b, DENSITY_ROWS):
                    u = (grid[None, :] - z[at : min(b, at + DENSITY_ROWS), None]) / model["bandwidth"]
                    total += n[at : min(b, at + DENSITY_ROWS)] @ np.exp(-0.5 * u * u)
            if len(sums) > DENSITY_MODELS:
                yield _densities(sums, shape)
                sums = {}
        yield _densities(sums, shape)

    partial = met.mapInArrow(add, "prs_id string, n_total long, bandwidth double, start double, step double, sums array<double>")
    norm = F.first("n_total") * F.first("bandwidth") * math.sqrt(2 * math.pi)
    return (
        partial.select("prs_id", *shape, F.posexplode("sums").alias("point", "_sum"))
        .groupBy("prs_id", "point")
        .agg(F.first(F.col("start") + F.col("point") * F.col("step")).alias("z"), (F.sum("_sum") / norm).alias("density"))
    )


def _densities(sums: dict, shape: tuple[str, ...]) -> pa.RecordBatch:
    columns = {"prs_id": pa.array(list(sums), pa.string())}
    for c in shape:
        columns[c] = pa.array([m[c] for m, _ in sums.values()], pa.int64() if c == "n_total" else pa.float64())
    columns["sums"] = pa.array([t.tolist() for _, t in sums.values()], pa.list_(pa.float64()))
    return pa.RecordBatch.from_pydict(columns)
