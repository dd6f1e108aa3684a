"""Substring and suffix dedup against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from riskloom.llm import common, substring_dedup, suffix_dedup


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, batch string, keys int")


def with_clashes(pairs):
    return [(i, t, "x", 1) for i, t in pairs]


def brute_words(pairs, window):
    words = [(i, [w for w in (t or "").encode().split()]) for i, t in pairs]
    first = {}
    for i, w in words:
        for p in range(len(w) - window + 1):
            key = tuple(w[p : p + window])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = set()
        for p in range(len(w) - window + 1):
            if i is not None and first[tuple(w[p : p + window])] < i:
                gone.update(range(p, p + window))
        kept = [x for j, x in enumerate(w) if j not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=repr)


def brute_bytes(pairs, length):
    texts = [(i, (t or "").encode()) for i, t in pairs]
    seen = Counter(t[p : p + length] for _, t in texts for p in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                gone[p : p + length] = True
        starts, _ = common.runs_of(gone)
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((i, len(t), int(gone.sum()), len(starts), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed, n, words):
    rnd = random.Random(seed)
    vocabulary = ["a", "é", "the", "on", "x\u0000", "Wort", "z" * 9]
    texts = []
    for _ in range(n):
        t = [rnd.choice(vocabulary) for _ in range(rnd.randint(0, words))]
        if texts and rnd.random() < 0.6:
            other = rnd.choice(texts).split()
            a = rnd.randint(0, len(other))
            t[rnd.randint(0, len(t)) :] = other[a : a + rnd.randint(0, 80)]
        texts.append(rnd.choice([" ", "\n", "\t "]).join(t))
    pairs = list(enumerate(texts)) + [(3, texts[5]), (3, texts[3]), (None, texts[2]), (n + 7, None), (n + 8, ""), (n + 9, "ab" * 900)]
    rnd.shuffle(pairs)
    return pairs


@pytest.mark.parametrize("window", [4, 9])
def test_windows(spark, window):
    pairs = corpus(window, 60, 120)
    got = substring_dedup.digest(docs_of(spark, with_clashes(pairs)).repartition(4), window).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_words(pairs, window)


def test_windows_empty(spark):
    assert substring_dedup.digest(docs_of(spark, [])).count() == 0


@pytest.mark.parametrize("length", [12, 40])
def test_bytes(spark, length, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "LEAD", 8)
    pairs = corpus(length, 60, 120)
    got = suffix_dedup.digest(docs_of(spark, with_clashes(pairs)).repartition(4), length).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_bytes(pairs, length)


def test_bytes_of_hot_leads(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "LEAD", 8)
    monkeypatch.setattr(suffix_dedup, "GROUP", 2)
    pairs = corpus(5, 60, 120)
    got = suffix_dedup.digest(docs_of(spark, with_clashes(pairs)).repartition(4), 24).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_bytes(pairs, 24)


def test_bytes_of_many_leads_in_a_range(spark):
    # Each passage stands in three texts, and a range holds far more contexts than a task compares at a time.
    rnd = random.Random(11)
    some = lambda n: "".join(rnd.choice("abcdefgh") for _ in range(n))
    pairs = [(3 * i + j, some(30) + passage + some(30)) for i, passage in enumerate(some(40) for _ in range(6000)) for j in range(3)]
    got = suffix_dedup.digest(docs_of(spark, with_clashes(pairs)).repartition(4), 40).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_bytes(pairs, 40)


def test_bytes_empty(spark):
    assert suffix_dedup.digest(docs_of(spark, [])).count() == 0


def test_multikey_ranks():
    rnd = np.random.default_rng(1)
    strings = rnd.integers(0, 2, (300, 21)).astype(np.uint8)
    strings[100:] = strings[rnd.integers(0, 40, 200)]
    lengths = rnd.integers(0, 22, 300)
    for row, n in zip(strings, lengths):
        row[n:] = 0
    order, common_prefix = suffix_dedup.multikey_ranks(strings, lengths)
    assert [bytes(strings[i]) for i in order] == sorted(bytes(s) for s in strings)
    for depth in (0, 1, 5, 13, 21):
        classes = suffix_dedup.depth_classes(order, common_prefix, depth)
        long = [i for i in range(300) if lengths[i] >= depth]
        by_class, by_bytes = {}, {}
        for i in long:
            by_class.setdefault(classes[i], set()).add(i)
            by_bytes.setdefault(bytes(strings[i][:depth]), set()).add(i)
        assert sorted(map(sorted, by_class.values())) == sorted(map(sorted, by_bytes.values()))


def test_exchange(spark):
    rnd = np.random.default_rng(2)
    rows, total, least = [], Counter(), {}
    for b in range(5):
        keys = np.unique(common.mix(rnd.integers(0, 60, 40).astype(np.uint64)))
        pay = rnd.integers(1, 9, len(keys))
        rows.append((b, common.pack(keys), common.pack(pay.astype(np.int64))))
        for k, p in zip(keys.tolist(), pay.tolist()):
            total[k] += p
            least[k] = min(least.get(k, 99), p)
    sent = spark.createDataFrame(rows, "batch long, keys binary, payload binary")
    for how in ("sum", "least"):
        for r in sent.join(common.exchange(sent, "t", how), "batch").collect():
            row = r.asDict(recursive=True)
            keys, pay = common.unpack(row["keys"], np.uint64).tolist(), common.unpack(row["payload"], np.int64).tolist()
            wanted = [total[k] for k in keys] if how == "sum" else [int(least[k] < p) for k, p in zip(keys, pay)]
            assert common.answers(row, how).tolist() == wanted


def brute_strings(pairs, length, words):
    """Bytes covered by a string of ``length`` bytes, or of ``words`` words if these end earlier, that starts elsewhere too."""
    texts = [(i, (t or "").encode()) for i, t in pairs]

    def strings(t):
        stops = [m.end() for m in re.finditer(rb"[^\x20\x09-\x0d]+", t)]
        for p in range(len(t)):
            ahead = [s for s in stops if s > p][:words]
            end = min(p + length, ahead[-1] if len(ahead) == words else p + length)
            if end <= len(t):
                yield p, end

    seen = Counter(t[p:e] for _, t in texts for p, e in strings(t))
    out = []
    for i, t in texts:
        gone = np.zeros(len(t), bool)
        for p, e in strings(t):
            gone[p:e] |= seen[t[p:e]] > 1
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((i, len(t), int(gone.sum()), len(common.runs_of(gone)[0]), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("group", [20_000, 2])
def test_strings_of_words(spark, group, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    pairs = corpus(21, 60, 120)
    got = suffix_dedup.digest(docs_of(spark, with_clashes(pairs)).repartition(4), 40, 9).collect()
    wanted = brute_strings(pairs, 40, 9)
    assert sorted((tuple(r) for r in got), key=repr) == wanted
    assert sum(r[2] for r in wanted) > sum(r[2] for r in brute_bytes(pairs, 40))


def test_strings_of_words_across_slices(monkeypatch):
    rnd = random.Random(3)
    text = " ".join("abcde"[: rnd.randint(1, 5)] for _ in range(900)).encode()
    whole = suffix_dedup.Runs([text, b"short", b""], 40, 8, 9)
    monkeypatch.setattr(suffix_dedup, "SLICE", 64)
    cut = suffix_dedup.Runs([text, b"short", b""], 40, 8, 9)
    each = lambda runs: [(d, p, a) for d, f, l, a in zip(runs.doc, runs.first, runs.last, runs.anchor) for p in range(f, l + 1)]
    assert each(whole) == each(cut) and {d for d, _, _ in each(whole)} == {0}


def test_pipeline_drops_short_words_passages(spark):
    # 60 words of less than 400 bytes
    rnd = random.Random(5)
    some = lambda n: " ".join("".join(rnd.choice("abcdefgh") for _ in range(4)) for _ in range(n))
    passage, own = some(60), [some(40) for _ in range(4)]
    texts = [f"{own[0]} {passage} {own[1]}", f"{own[2]} {passage}", own[3]]
    assert len(passage) < suffix_dedup.LENGTH
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["text"].split() for r in corpus_pipeline.drop_repeated_passages(spark, docs, "").collect()}
    assert got == {0: own[0].split() + own[1].split(), 1: own[2].split(), 2: own[3].split()}
