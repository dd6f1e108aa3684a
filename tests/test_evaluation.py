"""Distribution and evaluation against pandas, numpy and exact fractions."""

import math
import random
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.functions import hypergeometric
from riskloom.operators import distribution, evaluation, logistic
from riskloom.schema import EmptyInputError

SCHEMA = "prs_id string, s string, total_score double, variant_count long, normalized_score double"


def people():
    """Models: continuous, tied, one class, few distinct, constant, small."""
    rng = random.Random(11)
    rows = []
    for i in range(600):
        y = int(rng.random() < 0.3)
        rows.append(("continuous", i, rng.gauss(0.4 * y, 1.3), y))
        # A third of everybody shares one score.
        rows.append(("tied", i, 0.0 if rng.random() < 0.33 else rng.randint(-40, 40) / 16, y))
        rows.append(("one_class", i, rng.gauss(0, 1), 0))
        rows.append(("few", i, float(rng.randint(0, 8)), y))
        rows.append(("constant", i, 2.5, y))
    rows += [("small", i, float(i), i % 2) for i in range(12)]
    return pd.DataFrame(rows, columns=["prs_id", "s", "score", "status"]).astype({"s": str})


@pytest.fixture(scope="module")
def frame():
    return people()


@pytest.fixture(scope="module")
def scored(spark, frame):
    rows = [(m, f"{m}{s}", x, 1, x) for m, s, x in zip(frame.prs_id, frame.s, frame.score)]
    labels = [(f"{m}{s}", int(y)) for m, s, y in zip(frame.prs_id, frame.s, frame.status)]
    joined = distribution.join_status(
        spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "s string, phenotype_status long")
    )
    return distribution.scored_cohort(joined)


def of_model(frame, model):
    return frame[frame.prs_id == model].reset_index(drop=True)


def test_statistics_and_flags(scored, frame):
    got = {r["prs_id"]: r for r in scored.models.df.collect()}
    for model in frame.prs_id.unique():
        x = of_model(frame, model).score
        r = got[model]
        assert r["n"] == len(x) and r["n_distinct"] == x.nunique()
        assert r["mean"] == pytest.approx(x.mean()) and r["std"] == pytest.approx(x.std(), abs=1e-12)
        np.testing.assert_allclose(r["q"], np.quantile(x, np.arange(21) / 20), rtol=1e-12, atol=1e-12)
    assert {m for m, r in got.items() if r["degenerate"]} == {"few", "constant"}
    assert {m for m, r in got.items() if r["has_quantiles"]} == {"continuous", "one_class", "small"}


@pytest.mark.parametrize("rows_per_key", [5, 100_000])
def test_standardised_scores_equal_pandas(scored, frame, rows_per_key):
    out = distribution.standardised_scores(scored, rows_per_key).toPandas()
    assert len(out) == len(frame)
    for model in frame.prs_id.unique():
        mine = of_model(frame, model)
        mine["s"] = model + mine.s
        both = mine.merge(out[out.prs_id == model], on="s")
        assert len(both) == len(mine)
        if model in ("few", "constant"):
            assert (both.prs_zscore == 0).all() and (both.prs_percentile == 50).all()
            assert set(both.risk_category) == {"Average"} and set(both.prs_decile) == {"D5"}
            continue
        z = (both.score_x - both.score_x.mean()) / both.score_x.std()
        np.testing.assert_allclose(both.prs_zscore, z, atol=1e-12)
        np.testing.assert_allclose(both.prs_percentile, both.score_x.rank(pct=True) * 100, atol=1e-9)
        if model == "tied":
            assert set(both.risk_category) == {"NA"} and set(both.prs_decile) == {"NA"}
        else:
            fives = pd.qcut(both.score_x, 5, labels=[f"Q{i}" for i in range(1, 6)])
            tens = pd.qcut(both.score_x, 10, labels=[f"D{i}" for i in range(1, 11)])
            assert list(both.risk_category) == list(fives) and list(both.prs_decile) == list(tens)


def test_decile_prevalence(scored, frame):
    out = evaluation.decile_prevalence(scored).toPandas()
    assert set(out.prs_id) == {"continuous", "one_class", "small"}
    for model, part in out.groupby("prs_id"):
        mine = of_model(frame, model)
        assert len(part) == 10 and part.n_people.sum() == len(mine) and part.n_cases.sum() == mine.status.sum()
        tens = pd.qcut(mine.score, 10, labels=[f"D{i}" for i in range(1, 11)])
        prevalence = mine.groupby(tens, observed=False).status.mean() * 100
        np.testing.assert_allclose(part.set_index("prs_decile").prevalence_percent.reindex(prevalence.index), prevalence)


def pairwise_auc(x, y):
    cases, controls = x[y == 1].to_numpy(), x[y == 0].to_numpy()
    diff = cases[:, None] - controls[None, :]
    return ((diff > 0).sum() + 0.5 * (diff == 0).sum()) / diff.size


def test_auc_and_curve(spark, scored, frame):
    auc = {r["prs_id"]: r["auc"] for r in evaluation.roc_auc(scored).collect()}
    curve = evaluation.roc_curve(scored).toPandas()
    for model in ("continuous", "tied", "small"):
        mine = of_model(frame, model)
        assert auc[model] == pytest.approx(pairwise_auc(mine.score, mine.status), abs=1e-12)
        points = curve[curve.prs_id == model].sort_values(["fpr", "tpr"])
        assert len(points) == mine.score.nunique() + 1
        assert tuple(points.iloc[0][["fpr", "tpr"]]) == (0, 0) and tuple(points.iloc[-1][["fpr", "tpr"]]) == (1, 1)
        assert np.trapezoid(points.tpr, points.fpr) == pytest.approx(auc[model], abs=1e-12)
    assert auc["one_class"] is None and "one_class" not in set(curve.prs_id)
    assert auc["few"] == auc["constant"] == 0.5
    assert len(curve[curve.prs_id == "few"]) == 2


def test_auc_of_the_negated_score(spark, frame):
    mine = of_model(frame, "tied")
    rows = [("x", s, -x, 1, x) for s, x in zip(mine.s, mine.score)]
    labels = list(zip(mine.s, [int(y) for y in mine.status]))
    joined = distribution.join_status(
        spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "s string, phenotype_status long")
    )
    got = evaluation.roc_auc(distribution.scored_cohort(joined)).first()["auc"]
    assert got == pytest.approx(1 - pairwise_auc(mine.score, mine.status), abs=1e-12)


def test_histogram_and_density(scored, frame):
    bars = distribution.histogram(scored).toPandas()
    density = distribution.kernel_density(scored)
    # The grid meets sums, not the profile's rows.
    plan = density._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("MapInArrow") and plan.count("Generate ") == 1
    curve = density.toPandas()
    assert set(curve.prs_id) == {"continuous", "tied", "one_class", "small"}
    for model in frame.prs_id.unique():
        mine = of_model(frame, model)
        part = bars[bars.prs_id == model].sort_values("bin")
        assert len(part) == 50 and part.n_people.sum() == len(mine)
        if model in ("few", "constant"):
            assert part.n_people.iloc[25] == len(mine) and part.bin_start.iloc[0] == -0.5
            continue
        z = (mine.score - mine.score.mean()) / mine.score.std()
        if model == "continuous":
            counts, edges = np.histogram(z, bins=50)
            assert list(part.n_people) == list(counts)
            np.testing.assert_allclose(part.bin_start, edges[:-1], atol=1e-9)
        h = len(z) ** -0.2
        grid = np.linspace(z.min() - 3 * h, z.max() + 3 * h, 200)
        density = np.exp(-0.5 * ((grid[:, None] - z.to_numpy()) / h) ** 2).sum(1) / (len(z) * h * math.sqrt(2 * math.pi))
        mine_curve = curve[curve.prs_id == model].sort_values("point")
        np.testing.assert_allclose(mine_curve.z, grid, atol=1e-9)
        np.testing.assert_allclose(mine_curve.density, density, atol=1e-12)


def test_tails(scored, frame):
    out = evaluation.tail_comparison(scored).toPandas().set_index("prs_id")
    # Too small, one class and degenerate models have no tails.
    assert set(out.index) == {"continuous", "tied"}
    for model in out.index:
        mine = of_model(frame, model)
        low, high = np.percentile(mine.score, [5, 95])
        bottom, top = mine[mine.score <= low], mine[mine.score >= high]
        r = out.loc[model]
        assert (r.bottom_n, r.bottom_cases, r.top_n, r.top_cases) == (
            len(bottom), bottom.status.sum(), len(top), top.status.sum()
        )
        assert r.top_prevalence == pytest.approx(100 * top.status.mean())


def exact_p(a, b, c, d):
    r, k, t = a + b, a + c, a + b + c + d
    p = {
        x: Fraction(math.comb(k, x) * math.comb(t - k, r - x), math.comb(t, r))
        for x in range(max(0, r + k - t), min(r, k) + 1)
    }
    return float(sum(v for v in p.values() if v <= p[a] * (1 + Fraction(1, 10**7))))


TABLES = [(8, 2, 1, 5), (0, 10, 5, 5), (3, 0, 2, 7), (1, 1, 1, 1), (40, 160, 25, 180), (5, 0, 0, 5), (0, 9, 0, 9),
          (300, 900, 340, 880), (2, 700, 9, 650)]


def test_fisher_exact(spark, monkeypatch):
    rows = [(str(i), *t) for i, t in enumerate(TABLES)]
    df = spark.createDataFrame(rows, "prs_id string, high_cases long, high_controls long, low_cases long, low_controls long")
    got = {int(r["prs_id"]): r for r in evaluation.fisher_exact(df).collect()}
    monkeypatch.setattr(evaluation, "SUPPORT_RUN", 3)
    in_runs = {int(r["prs_id"]): r["p_value"] for r in evaluation.fisher_exact(df).collect()}
    for i, (a, b, c, d) in enumerate(TABLES):
        assert got[i]["p_value"] == pytest.approx(exact_p(a, b, c, d), rel=1e-9)
        assert in_runs[i] == pytest.approx(exact_p(a, b, c, d), rel=1e-9)
        shift = 0.5 if 0 in (a, b, c, d) else 0
        assert got[i]["odds_ratio"] == pytest.approx((a + shift) * (d + shift) / ((b + shift) * (c + shift)))
    assert got[0]["p_value"] == pytest.approx(0.0349650, abs=1e-7)


def normalised_p(a, b, c, d):
    """The exact p by neighbours' ratios over the whole support in extended precision, normalised by their sum."""
    r, k, t = a + b, a + c, a + b + c + d
    x = np.arange(max(0, r + k - t), min(r, k), dtype=np.longdouble)
    logs = np.concatenate(([0], np.cumsum(np.log((k - x) * (r - x)) - np.log((x + 1) * (t - r - k + x + 1)))))
    logs -= logs.max()
    tail = logs <= logs[a - max(0, r + k - t)] + 1e-7
    return float(np.exp(logs[tail]).sum() / np.exp(logs).sum())


@pytest.mark.parametrize("run", [100_000, 997])
def test_fisher_exact_of_a_wide_support(spark, monkeypatch, run):
    monkeypatch.setattr(evaluation, "SUPPORT_RUN", run)
    tables = [(5_001_000, 4_999_000, 4_998_000, 5_002_000), (30, 9_999_970, 70, 9_999_930), (2_000_000, 1_000_000, 1_000_000, 500_000)]
    df = spark.createDataFrame([(i, *t) for i, t in enumerate(tables)], "prs_id long, high_cases long, high_controls long, low_cases long, low_controls long")
    got = {int(r["prs_id"]): r["p_value"] for r in evaluation.fisher_exact(df).collect()}
    for i, t in enumerate(tables):
        assert got[i] == pytest.approx(normalised_p(*t), rel=1e-9)


def test_hypergeometric_terms():
    for r, k, t in [(10, 4, 30), (1, 1, 2), (5, 29, 30), (29, 29, 30), (15, 15, 30)]:
        x = list(range(max(0, r + k - t), min(r, k) + 1))
        exact = [math.log(Fraction(math.comb(k, v) * math.comb(t - k, r - v), math.comb(t, r))) for v in x]
        assert hypergeometric.log_hypergeometric(np.array(x), r, k, t) == pytest.approx(exact, abs=1e-12)


def penalised_slope(z, y):
    """Plain gradient descent on the stated objective."""
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    b = np.zeros(2)
    x = np.column_stack([np.ones_like(z), z])
    for _ in range(20000):
        p = 1 / (1 + np.exp(-x @ b))
        b += (x.T @ (w * (y - p)) - b) / (len(y) * 0.5)
    return b[1]


def test_odds_ratio_per_sd(scored, frame):
    got = {r["prs_id"]: r["or_per_sd"] for r in logistic.odds_ratio_per_sd(scored).collect()}
    # One class and zero deviation are left out; a degenerate score with deviation has no effect.
    assert set(got) == {"continuous", "tied", "few", "small"}
    assert got["few"] == pytest.approx(1.0, abs=1e-12)
    for model in ("continuous", "tied", "small"):
        mine = of_model(frame, model)
        z = ((mine.score - mine.score.mean()) / mine.score.std()).to_numpy()
        assert got[model] == pytest.approx(math.exp(penalised_slope(z, mine.status.to_numpy())), rel=1e-6)


def test_summary(scored):
    rows = {r["prs_id"]: r for r in evaluation.model_summary(scored).collect()}
    assert len(rows) == 6
    assert rows["one_class"]["auc"] is None and rows["one_class"]["or_per_sd"] is None
    assert rows["continuous"]["p_top_bottom"] is not None and rows["small"]["or_top_bottom"] is None
    text = {r["prs_id"]: r for r in evaluation.summary_text(evaluation.model_summary(scored)).collect()}
    assert text["one_class"]["auc"] == "Not Calculated" and text["few"]["auc"] == "0.5000"


def test_describe(scored, frame):
    out = distribution.describe_scores(scored).toPandas().set_index(["prs_id", "measure"])
    x = of_model(frame, "continuous").score
    d = x.describe()
    got = out.loc[("continuous", "score")]
    np.testing.assert_allclose(
        [got.n, got["mean"], got["std"], got["min"], got.p25, got.p50, got.p75, got["max"]], d.to_numpy(), rtol=1e-12
    )
    assert out.loc[("few", "zscore")]["max"] == 0


def test_unusable_rows(spark):
    rows = [("m", "1", float("nan"), 1, 0.0), ("m", "2", float("inf"), 1, 0.0), ("m", "3", None, 1, 0.0), ("m", "4", 1.0, 1, None)]
    labels = spark.createDataFrame([(str(i), 1) for i in range(1, 5)], "s string, phenotype_status long")
    joined = distribution.join_status(spark.createDataFrame(rows, SCHEMA), labels)
    assert tuple(distribution.dropped_rows(joined).first()) == ("m", 4, 3)
    assert distribution.scored_cohort(joined).people.rows == 1
    with pytest.raises(EmptyInputError):
        distribution.scored_cohort(joined.where("s = '1'"))


def test_one_person_has_no_deviation(spark):
    joined = spark.createDataFrame([("m", "1", 1.0, 1, 1, 1.0)], "prs_id string, s string, score double, status long, variant_count long, normalized_score double")
    r = distribution.scored_cohort(joined).models.df.first()
    assert r["degenerate"] and r["q"] == [1.0] * 21
