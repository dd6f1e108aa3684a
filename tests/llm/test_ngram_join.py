"""Components of alike documents against all pairs."""

import random

import pytest

from riskloom.llm import components, ngram_join


def brute(pairs, k, num, den):
    sets = []
    for _, t in pairs:
        w = "".join(c.lower() if c.isascii() else c for c in (t or "")).encode().split()
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    root = list(range(len(pairs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(pairs)):
        for j in range(i):
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(pairs):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(pairs)), key=repr)


def corpus(seed, families, copies, words, edits):
    rnd = random.Random(seed)
    word = lambda: rnd.choice(["the", "Of", "x"]) if rnd.random() < 0.3 else "w" + str(rnd.randint(0, 4000))
    passage = [word() for _ in range(30)]
    texts = []
    for _ in range(families):
        base = [word() for _ in range(rnd.randint(3, words))]
        if rnd.random() < 0.5:
            base += passage
        for _ in range(rnd.randint(1, copies)):
            t = list(base)
            for _ in range(rnd.randint(0, edits)):
                t[rnd.randrange(len(t))] = word()
            if rnd.random() < 0.2:
                t += [word() for _ in range(rnd.randint(1, 12))]
            texts.append(rnd.choice([" ", "\n"]).join(t))
    pairs = list(enumerate(texts)) + [(-4, None), (-5, ""), (-6, " \t"), (-7, "one"), (-8, "ONE "), (-9, "one two"), (4, texts[4]), (5, texts[9]), (None, "lone words here now"), (None, texts[0])]
    rnd.shuffle(pairs)
    return pairs


@pytest.mark.parametrize(("seed", "k", "num", "den", "edits"), [(1, 3, 90, 100, 3), (2, 5, 8, 10, 4), (3, 2, 6, 10, 9), (4, 1, 1, 1, 1)])
def test_components(spark, seed, k, num, den, edits):
    pairs = corpus(seed, 40, 9, 150, edits)
    rows = spark.createDataFrame([(i, t, 1, "x") for i, t in pairs], "doc_id long, text string, batch int, sid string")
    got = ngram_join.join(rows.repartition(5), k, num, den).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(pairs, k, num, den)


def test_no_rows(spark):
    assert ngram_join.join(spark.createDataFrame([], "doc_id long, text string"), 3, 9, 10).count() == 0


def test_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (300, 200), (200, 300)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {200: 200, 300: 200}
