"""Order MinHash, packing and URL rules against brute force."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest

from riskloom.llm import order_minhash as omh
from riskloom.llm import packing, url_rules


def corpus(seed, n):
    rnd = random.Random(seed)
    texts = ["".join(rnd.choice("abcdé \n") for _ in range(rnd.choice([0, 1, 3, 7, 40, 700]))) for _ in range(n)]
    texts[5] = texts[9]
    return texts


def docs(spark, pairs):
    return spark.createDataFrame([(i, t, "x", 0) for i, t in pairs], "doc_id long, text string, bucket string, extra int")


# --- order MinHash ---


def slow_fingerprint(text):
    """All numbered k-mers hashed and sorted under each order, one at a time."""
    codes = [ord(c) for c in text]
    hashes = omh.kmers(np.array(codes, np.uint32))
    seen, items = {}, []
    for h in hashes.tolist():
        seen[h] = seen.get(h, -1) + 1
        items.append((h, seen[h]))
    ids = omh.numbered(hashes)
    assert len(set(ids.tolist())) == len(set(items))
    if not len(ids):
        return np.zeros(omh.PERMUTATIONS, np.uint16)
    out = []
    for j in range(omh.PERMUTATIONS):
        order = sorted(range(len(ids)), key=lambda i: ((((int(ids[i]) ^ int(omh._XOR[j, 0])) * int(omh._ODD[j, 0])) & 0xFFFFFFFF) >> 1, i))
        pick = sorted(order[:2])
        pair = [int(ids[i]) for i in pick]
        if len(pair) == 1:
            pair = [0, pair[0]]
        value = omh.mix(np.array([pair[0] << 32 | pair[1]], np.uint64) ^ omh._SEEDS[j : j + 1])[0] >> np.uint64(48)
        out.append(int(value))
    return np.array(out, np.uint16)


@pytest.mark.parametrize("text", ["", "a", "abcdefgh", "abcdefghi", "ab" * 40, "the cat sat on the mat, the cat sat"])
def test_fingerprint(text, monkeypatch):
    assert omh.fingerprint(text).tolist() == slow_fingerprint(text).tolist()
    monkeypatch.setattr(omh, "BLOCK", 5)
    assert omh.fingerprint(text).tolist() == slow_fingerprint(text).tolist()


def test_edited_pairs_equal_fingerprints_of_each():
    rnd = random.Random(3)
    for n in (0, 1, 3, 8, 9, 12, 40, 300):
        a, b = ("".join(rnd.choice("ab c") for _ in range(n)) for _ in range(2))
        edited, kept = omh.edit(a, b)
        x, y = omh.both_fingerprints(a, edited, kept)
        assert x.tolist() == omh.fingerprint(a).tolist() and y.tolist() == omh.fingerprint(edited).tolist()


def test_rows_follow_each_other(spark):
    texts = corpus(1, 60)
    pairs = [(i * 3 % 181, t) for i, t in enumerate(texts)] + [(None, "last")]
    got = {r["doc_id"]: r for r in omh.fingerprints(docs(spark, pairs).repartition(5)).collect()}
    ordered = sorted(pairs, key=lambda p: (p[0] is None, p[0] or 0))
    assert len(got) == len(pairs)
    for (i, t), (_, following) in zip(ordered, ordered[1:] + ordered[:1]):
        edited, _ = omh.edit(t, following)
        r = got[i]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == omh.text_form(omh.fingerprint(t))
        assert r["edited_fingerprint"] == omh.text_form(omh.fingerprint(edited))
        assert r["near_edited"] == omh.likeness(omh.fingerprint(t), omh.fingerprint(edited))
        assert r["near_next"] == omh.likeness(omh.fingerprint(t), omh.fingerprint(following))


def test_repeated_null_and_single_rows(spark):
    rows = omh.fingerprints(docs(spark, [(1, "same text here"), (1, "same text here"), (2, None)])).collect()
    assert sorted(r["doc_id"] for r in rows) == [1, 1, 2]
    assert sorted(r["near_next"] for r in rows if r["doc_id"] == 1)[-1] == 1.0
    one = omh.fingerprints(docs(spark, [(7, "alone alone alone")])).first()
    assert one["near_next"] == 1.0
    assert omh.fingerprints(docs(spark, [])).count() == 0


def test_edits_and_moves_lower_the_likeness():
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(400)]
    text, moved = " ".join(words), " ".join(words[200:] + words[:200])
    light = " ".join(w if i % 40 else "x" + w for i, w in enumerate(words))
    near = lambda other: omh.likeness(omh.fingerprint(text), omh.fingerprint(other))
    assert near(text) == 1 and near(light) > 0.75 and near(moved) < 0.85 and near(" ".join(reversed(words))) < 0.4


# --- packing ---


def check_pieces(rows, pairs, window, words):
    ids = {i: words.ids_of([(t or "").encode()])[0] for i, t in pairs}
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] > 0 and zlib.crc32(part.astype("<u4").tobytes()) == r["ids_crc32"]
        assert r["doc_tokens"] == len(ids[r["doc_id"]])
    assert set(by_doc) == set(ids)
    for i, parts in by_doc.items():
        parts.sort(key=lambda r: r["start"])
        assert [p["start"] for p in parts] == [sum(q["length"] for q in parts[:k]) for k in range(len(parts))]
        assert sum(p["length"] for p in parts) == len(ids[i])
    padding = 0
    for parts in by_sequence.values():
        parts.sort(key=lambda r: r["offset"])
        assert [p["offset"] for p in parts] == [sum(q["length"] for q in parts[:k]) for k in range(len(parts))]
        size = sum(p["length"] for p in parts)
        assert size <= window
        padding += 0 if size & (size - 1) == 0 else window - size
    return padding


@pytest.mark.parametrize("parts", [1, 7, 70])
def test_pieces(spark, parts):
    pairs = list(enumerate(corpus(2, 150))) + [(900, None), (901, "wort " * 3000), (None, "no id")]
    words = packing.word_tokens(packing.default_tokenizer())
    rows = packing.pack(docs(spark, pairs).repartition(parts), packing.default_tokenizer(), 256, 4).collect()
    assert check_pieces(rows, pairs, 256, words) == 0


def test_no_rows(spark):
    assert packing.pack(docs(spark, []), packing.default_tokenizer()).count() == 0


def test_tokens_equal_the_tokenizer():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    words = packing.word_tokens(packing.default_tokenizer())
    texts = ["", "It's DON'T we'll 'S x''s", "a<|endoftext|>b < | > <|startoftext|>", "É é é Σας ΟΔΟΣ İ", "12 3.5%%% a_b ²½ ª­b",
             "a b c\u0085d\x0be\x1cf", "日本語 текст", "tab\tnew\nline\r\n end", "ÀÖØß×÷µ", "x" * 200 + " " + "ab" * 30 + "!" * 90]
    import duckdb

    texts += [r[0] for r in duckdb.sql("select text from '/root/testdata/sf0.001/documents.parquet'").fetchall()]
    for t, ids in zip(texts, words.ids_of([t.encode() for t in texts])):
        assert ids.tolist() == tokenizer.encode(t, add_special_tokens=False).ids + [2], t


# --- URL rules ---

URLS = [
    "http://www.example.org/es/1", "https://example.org/en/1737", "http://EXAMPLE.org/en/2", "http://example.orgx/en/1", "http://org/",
    "http://notexample.org/es/", "http://x.com/fr/1?a=http://y.org/", "http://com/de/", "x.com/fr/", None, "", "http://a.com", "http://a.com?x/fr/",
    "ftp://user@a.com:80/fr/", "://org/x#y", "http://deep.a.b.c.example.org/es/es", "http://example.org/EN/1", "http://a.org", "http:///fr/",
]


def slow_verdicts(urls, rules, otherwise):
    out = []
    for i, url in urls:
        rest = (url or "").partition("://")[2] if "://" in (url or "") else ""
        cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
        tail = rest[cut:]
        path = tail[: min([tail.index(c) for c in "?#" if c in tail] or [len(tail)])]
        fits = [(len(h + p), len(h), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, 0, None, otherwise))
        out.append((i, host, path, best[2], best[3]))
    return sorted(out, key=repr)


def pages(spark, urls):
    return spark.createDataFrame([(i, u, 1, "x") for i, u in urls], "page_id long, url string, bucket int, stack string")


def test_verdicts(spark):
    urls = list(enumerate(URLS)) + [(None, URLS[0]), (1, URLS[1]), (1, URLS[1])]
    got = url_rules.judge(pages(spark, urls).repartition(3), url_rules.rule_table(spark)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == slow_verdicts(urls, url_rules.RULES, "allow")


def test_many_nested_rules(spark):
    rnd = random.Random(4)
    host = lambda: ".".join(rnd.choice("ab") for _ in range(rnd.randint(1, 4)))
    rules = list({(h, p): (rnd.choice(["allow", "block"]), h, p) for h, p in ((host(), rnd.choice(["", "/"]) + "x" * rnd.randint(0, 3)) for _ in range(40))}.values())
    rules = [r for r in rules if r[2] == "" or r[2][0] == "/"]
    urls = [(i, f"http://{host()}/{'x' * rnd.randint(0, 4)}") for i in range(300)] + [(i, "http://a.b/xx") for i in range(1000, 1300)]
    got = url_rules.judge(pages(spark, urls), url_rules.rule_table(spark, tuple(rules)), "block").collect()
    assert sorted((tuple(r) for r in got), key=repr) == slow_verdicts(urls, rules, "block")


def test_no_pages_and_no_rules(spark):
    rules = url_rules.rule_table(spark)
    assert url_rules.judge(pages(spark, []), rules).count() == 0
    assert {r["verdict"] for r in url_rules.judge(pages(spark, [(1, URLS[0])]), rules.limit(0)).collect()} == {"allow"}


def test_sql_agrees(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{sf}/pages.parquet'")
    wanted = con.execute(url_rules.op9_sql()).fetchall()
    got = [tuple(r) for r in url_rules.op9(spark, sf).collect()]
    assert sorted(got, key=repr) == sorted(wanted, key=repr) and len(got) == 50
