"""Association scan against a direct fit per phecode."""

import math
import random

import numpy as np
import pytest

from riskloom.operators import phewas

FEATURES = ["exposure", "age", "pc1", "sex"]


def data():
    rng = random.Random(5)
    people, counts = [], []
    for i in range(900):
        exposure, sex = int(rng.random() < 0.3), rng.randint(0, 1)
        age, pc1 = rng.randint(20, 80), rng.gauss(0, 0.01)
        people.append((i, exposure, age, pc1, sex))
        for k in range(5):
            risk = 0.1 + (0.25 if k == 0 and exposure else 0)
            u = rng.random()
            if u < risk:
                counts.append((i, f"C{k}", rng.randint(2, 5)))
            elif u < risk + 0.1:
                counts.append((i, f"C{k}", 1))
        if i < 10:
            counts.append((i, "rare", 3))
    people.append((10_000, 1, None, 0.0, 1))  # incomplete
    counts.append((10_000, "C1", 4))
    counts.append((77_777, "C1", 4))  # outside the cohort
    # Two single occurrences make a case.
    counts += [(899, "C4x", 1), (899, "C4x", 1)]
    return people, counts


def fit(x, y):
    b = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ b))
        h = (x * (p * (1 - p))[:, None]).T @ x
        b = b + np.linalg.solve(h, x.T @ (y - p))
    return b[1], math.sqrt(np.linalg.inv(h)[1, 1])


@pytest.fixture(scope="module")
def inputs(spark):
    people, counts = data()
    return (
        spark.createDataFrame(people, "person_id long, exposure int, age int, pc1 double, sex int"),
        spark.createDataFrame(counts, "person_id long, phecode string, n long"),
    )


@pytest.fixture(scope="module")
def results(inputs):
    return phewas.association_scan(*inputs, "exposure", ["age", "pc1"], "sex").cache()


def test_scan_equals_separate_fits(results):
    people, counts = data()
    people = [p for p in people if None not in p]
    got = {r["phecode"]: r for r in results.collect()}
    assert set(got) == {f"C{k}" for k in range(5)}
    for code, r in got.items():
        n = {i: c for i, k, c in counts if k == code}
        used = [p for p in people if n.get(p[0], 0) != 1]
        x = np.array([[1, *p[1:]] for p in used], dtype=float)
        y = np.array([float(n.get(p[0], 0) >= 2) for p in used])
        beta, error = fit(x, y)
        assert (r["n_cases"], r["n_controls"]) == (y.sum(), len(y) - y.sum())
        assert r["beta"] == pytest.approx(beta, abs=1e-8) and r["std_err"] == pytest.approx(error, rel=1e-8)
        assert r["p_value"] == pytest.approx(math.erfc(abs(beta / error) / math.sqrt(2)), rel=1e-6)
        assert r["neg_log10_p"] == pytest.approx(-math.log10(r["p_value"]))
        assert r["odds_ratio"] == pytest.approx(math.exp(beta)) and r["ci_low"] < r["odds_ratio"] < r["ci_high"]
        assert r["converged"]


def test_bonferroni(results):
    assert [r["phecode"] for r in phewas.bonferroni_hits(results).collect()] == ["C0"]
    summary = phewas.scan_summary(results).first()
    assert (summary["n_tested"], summary["n_above"]) == (5, 1)
    assert summary["threshold"] == pytest.approx(-math.log10(0.05 / 5))
    nothing = phewas.scan_summary(results.limit(0)).first()
    assert (nothing["n_tested"], nothing["threshold"], nothing["n_above"]) == (0, None, 0)


def test_several_fits_give_the_same(inputs, results, monkeypatch):
    monkeypatch.setattr(phewas, "PHECODES_PER_FIT", 2)
    monkeypatch.setattr(phewas, "SLICE", 7)
    again = phewas.association_scan(*inputs, "exposure", ["age", "pc1"], "sex")
    first = {r["phecode"]: r["beta"] for r in results.collect()}
    assert {r["phecode"]: r["beta"] for r in again.collect()} == pytest.approx(first, abs=1e-9)


def test_constant_covariate_is_no_obstacle(spark, inputs, results):
    people, counts = inputs
    one_sex = people.withColumn("sex2", people["sex"] * 0 + 1)
    out = phewas.association_scan(one_sex, counts, "exposure", ["age", "pc1", "sex"], "sex2")
    first = {r["phecode"]: r["beta"] for r in results.collect()}
    assert {r["phecode"]: r["beta"] for r in out.collect()} == pytest.approx(first, abs=1e-9)
    with pytest.raises(ValueError):
        phewas.association_scan(one_sex, counts, "sex2", ["age"], "sex")


def test_separated_phecode_does_not_stop_the_others(spark, inputs):
    people, counts = inputs
    exposed = people.where("exposure = 1 and age is not null").selectExpr("person_id", "'split' as phecode", "2L as n")
    out = phewas.association_scan(people, counts.unionByName(exposed), "exposure", ["age", "pc1"], "sex")
    got = {r["phecode"]: r["converged"] for r in out.collect()}
    assert got["split"] is False and got["C0"] and got["C3"]


def test_case_counts_use_the_sum_of_occurrences(inputs):
    people, counts = inputs
    got = {r["phecode"]: r for r in phewas.phecode_case_counts(people, counts, min_cases=1).collect()}
    assert got["C4x"]["n_cases"] == 1 and got["C4x"]["n_controls"] == 900


def ruled(spark, rows, definitions, male_as_one=True, use_exclusions=False):
    """Counts by hand and by the operator, for people (id, sex) with phecode counts."""
    people, counts = rows
    cohort = spark.createDataFrame([(i, s) for i, s in people], "person_id long, sex int")
    marks = spark.createDataFrame(counts, "person_id long, phecode string, n long")
    known = spark.createDataFrame(definitions, "phecode string, sex string, exclude_first string, exclude_last string")
    rules = phewas.RiskRules(known, "sex", male_as_one, use_exclusions)
    got = {r["phecode"]: (r["n_cases"], r["n_controls"], r["n_excluded"]) for r in phewas.phecode_case_counts(cohort, marks, 2, 1, rules).collect()}
    total = {}
    for i, code, n in counts:
        total[i, code] = total.get((i, code), 0) + n
    limits, ranges = {}, {}
    for code, sex, first, last in definitions:
        if sex in ("Male", "Female"):
            limits[code] = sex
        if first is not None:
            ranges.setdefault(code, []).append((float(first), float(last)))
    expected = {}
    for code in {c for _, c in total}:
        members = [i for i, s in people if code not in limits or (s == (1 if male_as_one else 0)) == (limits[code] == "Male")]
        cases = [i for i in members if total.get((i, code), 0) >= 2]
        out = [
            i for i in members if i not in cases and (
                total.get((i, code), 0) > 0
                or use_exclusions and any(total.get((i, c), 0) > 0 and a <= float(c) <= b for c in {c for _, c in total} for a, b in ranges.get(code, []))
            )
        ]
        if cases:
            expected[code] = (len(cases), len(members) - len(cases) - len(out), len(out))
    return got, expected


def test_risk_sets_by_hand(spark):
    rnd = random.Random(2)
    people = [(i, i % 2) for i in range(60)]
    codes = ["250.1", "250.2", "251", "252.5", "401"]
    counts = [(rnd.randrange(65), rnd.choice(codes), rnd.randint(0, 2)) for _ in range(200)]
    definitions = [
        ("250.1", "Male", "250", "250.99"), ("250.2", "Both", "250", "250.99"), ("250.2", "Both", "401", "401"),
        ("251", "Female", None, None), ("252.5", None, "300", "200"),
    ]
    for male_as_one in (True, False):
        for use_exclusions in (True, False):
            got, expected = ruled(spark, (people, counts), definitions, male_as_one, use_exclusions)
            assert got == expected


def test_one_sex_is_fitted_on_its_own_people(spark):
    """A phecode of men has the estimates of a cohort of men."""
    rnd = random.Random(6)
    rows = [(i, i % 2, rnd.randint(0, 1), rnd.random()) for i in range(400)]
    people = spark.createDataFrame(rows, "person_id long, sex int, exposure int, age double")
    marked = [(i, "600", 2) for i, sex, exposure, _ in rows if rnd.random() < 0.2 + 0.3 * exposure]
    counts = spark.createDataFrame(marked, "person_id long, phecode string, n long")
    known = spark.createDataFrame([("600", "Male", None, None)], "phecode string, sex string, exclude_first string, exclude_last string")
    got = phewas.association_scan(people, counts, "exposure", ["age"], "sex", rules=phewas.RiskRules(known, "sex")).first()
    men = people.where("sex = 1")
    alone = phewas.association_scan(men, counts, "exposure", ["age"], "sex").first()
    assert (got["n_cases"], got["n_controls"]) == (alone["n_cases"], alone["n_controls"])
    assert got["beta"] == pytest.approx(alone["beta"], rel=1e-8)
    assert got["std_err"] == pytest.approx(alone["std_err"], rel=1e-6)
