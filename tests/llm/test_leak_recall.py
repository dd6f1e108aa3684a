"""Recall of benchmark leaks with more items than the latent space has dimensions, and with more documents."""

import random

import numpy as np
import pytest

from riskloom.llm import latent_leaks

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def many_items(spark):
    """(documents, items, passage of each item's own words between others, the same with 20 % of its words replaced)."""
    texts = [r["text"].split() for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect() if len((r["text"] or "").split()) > 80]
    rnd = random.Random(12)
    vocabulary = [w for t in texts for w in t]
    items, plain, edited = [], [], []
    for _ in range(latent_leaks.BLOCK_ITEMS):
        t = rnd.choice(texts)
        n = rnd.randint(15, 59)
        a = rnd.randrange(len(t) - n)
        own = t[a : a + n]
        other = list(own)
        for k in rnd.sample(range(n), n // 5):
            other[k] = rnd.choice(vocabulary)
        around = lambda: " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, 90)))
        items.append(" ".join(own))
        plain.append(f"{around()} {' '.join(own)} {around()}")
        edited.append(f"{around()} {' '.join(other)} {around()}")
    return [" ".join(t) for t in texts], items, plain, edited


def recall(search, texts, which=None):
    """Share of the texts whose own item is found."""
    found = search.leaks([t.encode() for t in texts])
    ids = search.space.items.ids
    return sum(i in {ids[x["item"]] for x in leaks} for i, leaks in zip(which or range(len(texts)), found)) / len(texts)


@pytest.fixture(scope="module")
def search(spark, many_items):
    texts, items, plain, edited = many_items
    docs = spark.createDataFrame([(t,) for t in texts + plain[::4]], "text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    (found,) = latent_leaks.searches(docs, bench)
    return found


def test_a_full_block_is_found(many_items, search):
    _, _, plain, edited = many_items
    assert recall(search, plain) == 1.0
    assert recall(search, edited) >= 0.97


@pytest.mark.parametrize("copies", [1, 40])
def test_recall_does_not_fall_with_documents(spark, copies):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text")
    vocabulary = [w for r in docs.collect() for w in (r["text"] or "").split()]
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    (search,) = latent_leaks.searches(docs.crossJoin(spark.range(copies)), bench)
    own = {r["item_id"]: r["text"].split() for r in bench.collect()}
    items, rnd = search.space.items, random.Random(9)
    texts, which = [], []
    for words, i, tail in zip(items.words, items.ids, items.answers):
        for _ in range(8):  # 40 % of the words replaced, the answer kept
            other = list(own[i])
            body = len(other) - tail
            for k in rnd.sample(range(body), min(body, int(0.4 * len(other)))):
                other[k] = rnd.choice(vocabulary)
            text = " ".join(other)
            there = latent_leaks.words_of([text.encode()]).hashes
            if latent_leaks.common_subsequence(words, there) >= 0.5 * len(words):
                texts.append(text)
                which.append(i)
    assert len(texts) > 200 and recall(search, texts, which) >= 0.98


def test_weights_depend_on_shares_only():
    df, slots = np.array([0.0, 2.0, 50.0, 900.0]), [np.array([0, 1, 3]), np.array([2, 3])]
    small, foreign = latent_leaks.term_weights(df, 1000, slots)
    large, other = latent_leaks.term_weights(df * 5000, 5_000_000, slots)
    assert np.allclose(small, large, atol=0.3) and abs(foreign - other) < 0.2 and foreign < small.max()


def test_no_passage_is_left_out_for_repeated_words(many_items, search, monkeypatch):
    """Candidates are those of all passages, also where an item's word stands many times between strange ones."""
    _, items, plain, _ = many_items
    rnd = random.Random(3)
    texts = []
    for i in range(0, len(items), 20):
        own = items[i].split()
        word = rnd.choice(own)
        strange = [f"strange{rnd.randrange(10**6)}" for _ in range(rnd.randint(5, 60))]
        texts.append(" ".join(rnd.sample(strange + [word] * rnd.randint(2, 9) + own[:3], len(strange) + 4)))
        texts.append(plain[i])
    words = latent_leaks.words_of([t.encode() for t in texts])
    slots = search.space.items.slots(words.hashes)
    found = set(search.candidates(words, slots))
    monkeypatch.setattr(latent_leaks, "MASS", 0.0)
    everything = set(search.candidates(words, slots))
    assert {x[:4] for x in found} == {x[:4] for x in everything}
    assert found


def test_the_space_is_fitted_on_all_documents(spark, monkeypatch):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 90))) for _ in range(4000)]
    items = latent_leaks.Items.of([(i, " ".join(words[5 * i : 5 * i + 5])) for i in range(8)])
    seen = {}
    monkeypatch.setattr(latent_leaks, "_svd", lambda passages, items, weights: seen.update(rows=passages.collect(), df=passages, weights=weights) or np.eye(len(weights)))
    source = spark.createDataFrame([(i, t.encode()) for i, t in enumerate(texts)], "doc_id long, data binary").repartition(5)
    latent_leaks.fit(source, items)
    each = [t.split()[a : a + latent_leaks.FIT_WORDS] for t in texts for a in range(0, len(t.split()), latent_leaks.FIT_WORDS)]
    assert sum(len(latent_leaks.unpack(r["sizes"], np.uint8)) for r in seen["rows"]) == len(each)
    # the products, in several bands and slices, are those of all passages' rows
    monkeypatch.setattr(latent_leaks, "BAND_CELLS", 300)
    monkeypatch.setattr(latent_leaks, "SLICE_CELLS", 70)
    n = len(items.terms)
    rows = np.zeros((len(each), n))
    for row, passage in zip(rows, each):
        slots = items.slots(latent_leaks.words_of([" ".join(passage).encode()]).hashes)
        row += np.bincount(slots[slots >= 0], minlength=n) * seen["weights"]
    rows = rows[:, np.argsort(seen["weights"], kind="stable")]
    rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)
    got, starts = np.zeros((n, n)), latent_leaks._row_starts(n)
    for r in latent_leaks._products(seen["df"], seen["weights"]).collect():
        cells, at = latent_leaks.unpack(r["data"], np.float64), r["first"]
        while len(cells):
            got[at, at:], cells, at = cells[: n - at], cells[n - at :], at + 1
    assert starts[-1] == n * (n + 1) // 2
    np.testing.assert_allclose(got, np.triu(rows.T @ rows), rtol=1e-9, atol=1e-12)
