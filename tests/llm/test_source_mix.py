"""Source mixing: targets by hand, rounding by its invariants."""

import random
import re
from collections import Counter, defaultdict

import pytest

from riskloom.llm import source_mix as sm

SCHEMA = "doc_id long, text string, source string, size long, place long, n int, target string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, 9, 9, 9, "z") for i, t, s in rows], SCHEMA)


def slow_targets(sizes):
    """Water filling, one source after the other."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    left, open_names, out = sum(sizes.values()), list(names), {}
    while True:
        total = sum(weight[s] for s in open_names)
        over = [s for s in open_names if left * weight[s] > 3 * sizes[s] * total]
        if not over:
            return out | {s: left * weight[s] / total for s in open_names}
        for s in over:
            out[s] = 3.0 * sizes[s]
            left -= 3 * sizes[s]
            open_names.remove(s)


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 10, "b": 10, "c": 10},
        {"a": 1000, "b": 10, "c": 1, "é": 5, "z": 0, None: 40},
        {"a": 10**6, "b": 1, "c": 2, "d": 30, "e": 400, "f": 5000, "g": 60000, "\U0001f600": 7, "￿": 9},
        {None: 5},
        {"a": 0, "b": 0},
        {},
    ],
)
def test_targets(spark, sizes):
    found = sm.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    expected = slow_targets(sizes) if sizes else {}
    assert {r["source"] for r in found} == set(sizes)
    for r in found:
        assert r["target"] == pytest.approx(expected[r["source"]], rel=1e-12)
    assert [r["place"] for r in sorted(found, key=lambda r: (r["source"] is None, (r["source"] or "").encode()))] == list(range(1, len(sizes) + 1))


def test_words(spark):
    texts = [None, "", " ", "a", " a  b\t\n", "\x0b\x0c\r", "a b c", "x" * 50000 + " y", " " * 50000]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(sm.n_words(sm.F.col("t")).alias("n")).collect()
    assert [r["n"] for r in got] == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]


def test_transfer_keeps_words_and_expectation():
    rnd = random.Random(3)
    for _ in range(300):
        sa, sb = rnd.randint(1, 50), rnd.randint(1, 50)
        a, b = rnd.random(), rnd.random()
        outcomes = [sm.transfer(sa, a, sb, b, (u + 0.5) / 2000) for u in range(2000)]
        for x, y in outcomes:
            assert sa * x + sb * y == pytest.approx(sa * a + sb * b)
            assert x in (0.0, 1.0) or y in (0.0, 1.0)
            assert -1e-12 <= x <= 1 + 1e-12 and -1e-12 <= y <= 1 + 1e-12
        assert sum(x for x, _ in outcomes) / 2000 == pytest.approx(a, abs=2e-3)


def test_settle_against_smaller():
    rnd = random.Random(9)
    for _ in range(200):
        sizes = sorted((rnd.randint(1, 60) for _ in range(rnd.randint(1, 30))), reverse=True)
        f = rnd.random()
        more = sm.settle_against_smaller(sizes, [f] * len(sizes), [rnd.random() for _ in sizes])
        error = abs(sum(s for s, m in zip(sizes, more) if m) - f * sum(sizes))
        assert error <= sizes[0] / 2 + 1e-6
    sizes = sorted((int(rnd.paretovariate(0.7)) % 900 + 1 for _ in range(100)), reverse=True)
    for f in (0.2, 0.5, 0.9):
        more = sm.settle_against_smaller(sizes, [f] * 100, [rnd.random() for _ in sizes])
        assert abs(sum(s for s, m in zip(sizes, more) if m) - f * sum(sizes)) <= 1
    # Where both directions are open, documents keep their expectation.
    sizes, hits = [9, 8, 7, 6] + [3] * 40, Counter()
    for _ in range(5000):
        hits.update(i for i, m in enumerate(sm.settle_against_smaller(sizes, [0.3] * 44, [rnd.random() for _ in sizes])) if m)
    assert all(abs(hits[i] / 5000 - 0.3) < 0.03 for i in range(30))


def documents(seed, n):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        source = rnd.choice(["hot"] * 5 + ["b", "c", "d", None])
        rows.append((i, " ".join("w" * rnd.randint(1, 5) for _ in range(int(rnd.paretovariate(0.7)) % 900)), source))
    return rows


def mixed(spark, rows, partitions=None):
    docs = frame(spark, rows)
    if partitions:
        docs = docs.repartition(partitions)
    copies, targets = sm.rounded_copies(docs)
    each = copies.selectExpr("*", "explode(sequence(1, n)) i").selectExpr("place", "doc_id", "size", "base + if(i <= ups, 1, 0) times").collect()
    return each, {r["place"]: r for r in targets.collect()}


def check(rows, each, targets):
    assert Counter((r["doc_id"], r["size"]) for r in each) == Counter((i, len((t or "").split())) for i, t, _ in rows)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in each:
        assert 0 <= r["times"] <= 3
        taken[r["place"]] += r["size"] * r["times"]
        largest[r["place"]] = max(largest[r["place"]], r["size"])
        p = targets[r["place"]]["target"] / max(1, targets[r["place"]]["source_size"])
        assert int(p + 1e-9) <= r["times"] <= -(-p // 1) + 1e-9
    for place, t in targets.items():
        assert abs(taken[place] - t["target"]) <= largest[place]
    return taken


def test_targets_are_met_and_partitions_do_not_matter(spark, monkeypatch):
    monkeypatch.setattr(sm, "LEAF_ROWS", 16)
    monkeypatch.setattr(sm, "FAN_IN", 4)
    rows = documents(1, 900)
    each, targets = mixed(spark, rows)
    taken = check(rows, each, targets)
    for place, t in targets.items():
        assert taken[place] == pytest.approx(t["target"], rel=0.01)
    monkeypatch.setattr(sm, "RESERVE", 20)
    each, targets = mixed(spark, rows)
    check(rows, each, targets)
    again, _ = mixed(spark, rows, 13)
    assert sorted(map(tuple, each)) == sorted(map(tuple, again))


def test_equal_rows_nulls_and_empty(spark, monkeypatch):
    monkeypatch.setattr(sm, "EQUAL_ROWS", 7)
    rows = [(None, "a b c", None)] * 50 + [(1, None, "x"), (1, "", "x"), (2, "one two", "y"), (2, "two one", "y"), (3, "k " * 40, "x")]
    each, targets = mixed(spark, rows)
    check(rows, each, targets)
    assert mixed(spark, []) == ([], {})


def test_mixture_holds_the_copies(spark):
    rows = documents(4, 200) + [(None, "same text", "b")] * 6 + [(500, None, "b")]
    docs = frame(spark, rows)
    each, _ = mixed(spark, rows)
    out = sm.mixture(docs).collect()
    expected = Counter()
    for r in each:
        expected[(r["doc_id"], r["size"])] += r["times"]
    assert Counter((r["doc_id"], len((r["text"] or "").split())) for r in out) == +expected
    texts = {(i, t or "", s) for i, t, s in rows}
    assert all((r["doc_id"], r["text"] or "", r["source"]) in texts for r in out)


def test_query(spark):
    found = sm.op11(spark, "/root/testdata/sf0.001").collect()
    assert len(found) == 200
    by = defaultdict(list)
    for r in found:
        assert r["taken"] <= 3 * r["size"]
        by[r["source"]].append(r)
    for rows in by.values():
        assert sum(r["size"] for r in rows) == rows[0]["source_size"]
        assert abs(sum(r["taken"] for r in rows) - rows[0]["target"]) <= max(r["size"] for r in rows)
