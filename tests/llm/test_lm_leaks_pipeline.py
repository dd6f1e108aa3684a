"""Class bigrams, benchmark leaks and the pipeline against brute force."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskloom.llm import class_lm as lm
from riskloom.llm import language_id, latent_leaks, ngram_join, packing, suffix_dedup
from tests.llm.test_fingerprints_packing_urls import check_pieces
from tests.llm.test_ngram_join import brute as brute_components
from tests.llm.test_ngram_join import corpus as near_corpus

SF = "/root/testdata/sf0.001"


# --- class bigrams ---


def words_of(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()


@pytest.fixture(scope="module")
def scored(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(
        spark.createDataFrame([(100_000, None), (100_001, ""), (100_002, "Nie gesehen XYZZY the"), (None, "the of"), (5, "repeated id")], "doc_id long, text string")
    )
    model, counts = lm.train(lm.in_training(docs), 3)
    return docs.collect(), model, lm.score(docs, model, counts).collect()


def test_base_scores(scored):
    docs, _, got = scored
    training = Counter()
    for r in docs:
        if not lm.tested_id(r["doc_id"]):
            training.update(words_of(r["text"]))
            training[b" "] += 1
    n, v = sum(training.values()), len(training)
    wanted = []
    for r in docs:
        tokens = words_of(r["text"]) + [b" "]
        base = sum(math.log10((training[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens)
        held = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1
        wanted.append((str(r["doc_id"]), held, len(tokens), sum(t in training for t in tokens), n, round(base, 5)))
    assert sorted((str(r[0]), *r[1:5], round(r["base_score"], 5)) for r in got) == sorted(wanted)


def test_scores_follow_the_model(scored):
    docs, m, got = scored
    training = Counter()
    for r in docs:
        if not lm.tested_id(r["doc_id"]):
            training.update(words_of(r["text"]))
    place = {w: i for i, w in enumerate(m.words.words)}
    cls = lambda w: int(m.classes[place[w] if place.get(w, lm.CLASSED) < lm.CLASSED else lm.ending_unit(w)])
    wanted = []
    for r in docs:
        before, total = lm.CLASSES, 0.0
        for w in words_of(r["text"]):
            c = cls(w)
            total += m.transitions[before, c]
            total += math.log10((training[w] - m.discounts[c]) / m.sizes[c]) if w in training else m.unseen[c]
            before = c
        wanted.append((str(r["doc_id"]), round(total + m.transitions[before, lm.CLASSES], 4)))
    assert sorted((str(r["doc_id"]), round(r["score"], 4)) for r in got) == sorted(wanted)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_probabilities_add_up(scored):
    docs, m, _ = scored
    assert np.allclose((10**m.transitions).sum(axis=1), 1)
    training = Counter(w for r in docs if not lm.tested_id(r["doc_id"]) for w in words_of(r["text"]))
    place = {w: i for i, w in enumerate(m.words.words)}
    sums = 10**m.unseen
    sums[lm.CLASSES] = 1
    sums[m.sizes == 0] = 1
    for w, c in training.items():
        k = m.classes[place[w] if place.get(w, lm.CLASSED) < lm.CLASSED else lm.ending_unit(w)]
        sums[k] += (c - m.discounts[k]) / m.sizes[k]
    assert np.allclose(sums, 1)


def test_a_small_lexicon_scores_alike(spark, monkeypatch, scored):
    docs, _, got = scored
    monkeypatch.setattr(lm, "HOT", 300)
    rows = spark.createDataFrame([(r["doc_id"], r["text"]) for r in docs], "doc_id long, text string")
    model, counts = lm.train(lm.in_training(rows), 1)
    assert 0 < len(model.words.words) <= 300
    again = lm.score(rows, model, counts).collect()
    key = lambda r: (str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 5))
    assert sorted(map(key, again)) == sorted(map(key, got))


def test_best_move_is_the_best_by_recount():
    rng = np.random.default_rng(3)
    width = lm.CLASSES + 1
    units, at = 90, rng.integers(0, lm.CLASSES, 90)
    n = rng.poisson(0.4, (units, units)).astype(float)

    def likelihood(classes):
        m = np.zeros((width, width))
        np.add.at(m, (np.repeat(classes, units), np.tile(classes, units)), n.ravel())
        return lm._xlogx(m).sum() - lm._xlogx(m.sum(axis=1)).sum() - lm._xlogx(m.sum(axis=0)).sum(), m

    base, pairs = likelihood(at)
    for u in (0, 7, 41):
        after, before = np.zeros(width), np.zeros(width)
        np.add.at(after, at, n[u])
        np.add.at(before, at, n[:, u])
        target, gain = lm.best_moves(pairs, after[None], before[None], n[u, u][None], at[u : u + 1])
        each = [likelihood(np.where(np.arange(units) == u, b, at))[0] - base for b in range(lm.CLASSES)]
        # rows and columns of a closed corpus have the same sums; here they differ a little
        assert gain[0] <= max(each) + 12 and each[int(target[0])] >= max(each) - 12


def test_no_training(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    model, counts = lm.train(lm.in_training(docs.limit(0)), 2)
    got = sorted(lm.score(docs, model, counts).collect())
    assert [r["n_tokens"] for r in got] == [3, 1] and all(r["n_known"] == 0 and r["base_score"] == 0 for r in got)
    assert lm.score(docs.limit(0), model, counts).count() == 0


# --- benchmark leaks ---


def test_leaks_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    rnd = random.Random(2)
    own = [(r["doc_id"], r["text"]) for r in docs]
    planted, texts = set(), [t for _, t in own]
    for k in range(40):  # paraphrases: a few words dropped, replaced and put in, the last sentence kept
        item = items[k % len(items)]
        words = re.findall(r"\S+", item["text"])
        body = [w for w in words[:-6] if rnd.random() > 0.1]
        for _ in range(len(body) // 10):
            body[rnd.randrange(len(body))] = "otherwise"
        planted.add((5000 + k, item["item_id"]))
        a, b = rnd.choice(texts).split(), rnd.choice(texts).split()
        own.append((5000 + k, " ".join(a[: rnd.randint(0, 200)] + body + words[-6:] + b[: rnd.randint(0, 200)])))
    rows = spark.createDataFrame([(*r, 1) for r in own], "doc_id long, text string, cosine int")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]) for r in latent_leaks.find_leaks(rows, bench).collect()}
    squeeze = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    verbatim = {(d, i["item_id"]) for d, t in own for i in items if squeeze(i["text"]) in squeeze(t)}
    block = latent_leaks.Items.of([(i["item_id"], i["text"]) for i in items])
    words = latent_leaks.words_of([t.encode() for _, t in own])
    wanted = set()
    for (d, _), a, n in zip(own, words.starts.tolist(), words.counts.tolist()):
        h = words.hashes[a : a + n]
        for item, w, tail in zip(block.ids, block.words, block.answers):
            for s in range(0, max(1, n - len(w) + 1), max(1, len(w) // 6)):
                region = h[s : s + int(1.5 * len(w)) + 1]
                share = latent_leaks.common_subsequence(w, region) / len(w)
                if share >= 0.8 or (share >= 0.5 and latent_leaks.common_subsequence(w[len(w) - tail :], region) >= 0.8 * tail):
                    wanted.add((d, item))
    assert verbatim <= got and len(verbatim) > 3
    assert len(wanted & got) >= 0.95 * len(wanted) and len(planted & got) >= 36
    assert got - wanted <= planted | verbatim
    kept = {r["doc_id"] for r in latent_leaks.decontaminate(rows, bench).collect()}
    assert kept == {d for d, _ in own} - {d for d, _ in got}


def test_leaks_of_odd_rows(spark):
    bench = spark.createDataFrame([(1, "the quick brown fox jumps over it"), (2, None), (3, "..."), (4, "one"), (5, "the quick brown fox jumps over it")], "item_id long, text string")
    text = "well, The quick brown fox -- jumps over it!"
    docs = spark.createDataFrame([(1, text), (1, text), (None, text), (3, None), (4, ""), (5, "nothing here " * 3000)], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["item_id"]) for r in latent_leaks.find_leaks(docs, bench).collect()), key=repr)
    assert got == sorted([(1, 1), (1, 5), (1, 1), (1, 5), (None, 1), (None, 5)], key=repr)
    assert latent_leaks.find_leaks(docs.limit(0), bench).count() == 0 == latent_leaks.find_leaks(docs, bench.limit(0)).count()
    assert latent_leaks.decontaminate(docs, bench).count() == 3


def test_common_subsequence():
    rnd = random.Random(6)
    for _ in range(200):
        a, b = ([rnd.randint(0, 4) for _ in range(rnd.randint(1, 12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert latent_leaks.common_subsequence(np.array(a), np.array(b)) == table[-1][-1]


def test_answers():
    text = b"One two. Three four? Five six!  "
    assert text[latent_leaks.answer_start(text) :].split() == [b"Five", b"six!"]
    assert latent_leaks.answer_start(b"no stop here") == 0


# --- pipeline ---


def test_near_duplicate_stage(spark):
    pairs = [p for p in near_corpus(7, 30, 8, 120, 4) if p[0] not in (4, 5)]  # an id names one text here
    docs = spark.createDataFrame([(i, t, "en", "n") for i, t in pairs] + [(5000, pairs[0][1], "en", "n")] * 2, "doc_id long, text string, lang string, node string")
    rows = pairs + [(5000, pairs[0][1])] * 2
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()
    component = brute_components(rows, 5, 8, 10)
    wordless = [d for d, n, _ in component if n == 0]
    got = sorted((r["doc_id"] for r in kept), key=repr)
    groups = {c for d, n, c in component if n}
    assert sorted(wordless, key=repr) == sorted((r["doc_id"] for r in kept if not (r["text"] or "").split()), key=repr)
    assert len(got) == len(groups) + len(wordless) and kept[0].asDict().keys() == {"doc_id", "text", "lang", "node"}


def test_repeated_passage_stage(spark):
    rnd = random.Random(8)
    word = lambda: "wé" + str(rnd.randint(0, 10**6))
    passage = " ".join(word() for _ in range(80))
    own = [" ".join(word() for _ in range(60)) for _ in range(6)]
    texts = [own[0] + " " + passage + own[1], own[2], passage, None, own[3] + passage, own[4], own[4], ""]
    docs = spark.createDataFrame([(i, t, len(t or ""), i) for i, t in enumerate(texts)], "doc_id long, text string, n_chars long, _x int")
    got = {r["doc_id"]: r for r in corpus_pipeline.drop_repeated_passages(spark, docs, SF).collect()}
    assert set(got) == {0, 1, 3, 4, 7}  # 2, 5 and 6 are repeats and nothing else
    assert got[1]["text"] == own[2] and got[3]["text"] is None and got[0]["n_chars"] == len(got[0]["text"])
    assert own[0] in got[0]["text"] and own[1][1:] in got[0]["text"] and passage[5:-5] not in got[0]["text"] + got[4]["text"]


def test_language_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(9000, None, "en", "x", 0), (9001, "12 34 !!", "en", "x", 8)], docs.schema)
    kept = corpus_pipeline.keep_known_languages(spark, docs.unionByName(odd), SF)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in docs.collect())


def test_whole_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        rows = out.collect()
        assert 0 < len(rows) <= docs.count()
        docs = spark.createDataFrame(rows, docs.schema)
    pieces = corpus_pipeline.run(spark, SF).collect()
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert check_pieces(pieces, texts, packing.WINDOW, packing.word_tokens(packing.default_tokenizer())) == 0


def test_no_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_hashes_of_words_are_sparks(spark):
    words = [b"one", b"\xc3\xa9t\xc3\xa9", b"a", b"x" * 90]
    hashed = F.shiftrightunsigned(F.xxhash64("word"), 64 - lm.HASH_BITS)
    wanted = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, word binary").select("i", hashed.alias("h")).collect()
    assert lm.word_hashes(words).tolist() == [r["h"] for r in sorted(wanted)]
    assert lm.units_of([b"b", *words], {b"b": 3})[1].tolist() == [3, *map(lm.ending_unit, words)]
