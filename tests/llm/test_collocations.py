"""Phrase collocations against counting every phrase one by one, and against SQL."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from riskloom.llm import collocations as co
from riskloom.llm.common import Cells

SCHEMA = "doc_id long, text string, lang string, word string, c long, id long, n long, batch long, key long, bucket int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, g, "w", 1, 2, 3, 4, 5, 6) for i, (t, g) in enumerate(rows)], SCHEMA)


def slow(rows, least=10):
    counts, sizes = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for k in (1, 2, 3):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = {}
    for lang, seen in counts.items():
        for phrase, a in seen.items():
            if len(phrase) == 1 or a < least:
                continue
            longer = [g for g, c in seen.items() if len(g) > len(phrase) and c >= least and 100 * c >= 50 * a and phrase in (g[:-1], g[1:])]
            if longer:
                continue
            cuts = [(1_000_000 * a * a // (seen[phrase[:k]] * seen[phrase[k:]]), k, seen[phrase[:k]], seen[phrase[k:]]) for k in range(1, len(phrase))]
            score, _, left, right = min(cuts)
            out[lang, " ".join(phrase)] = (a, left, right, sizes[lang], score)
    return out


def found(spark, rows):
    phrases, sizes = co.collocations(frame(spark, rows))
    n = {r["lang"]: r["n"] for r in sizes.collect()}
    return {(r["lang"], r["phrase"]): (r["a"], r["l"], r["r"], n[r["lang"]], r["score"]) for r in phrases.collect()}


def corpus(seed, n, words=40):
    rnd = random.Random(seed)
    names = [f"w{i}" if i % 7 else f"Ü{i}é" for i in range(words)]
    rows = []
    for _ in range(n):
        text = ""
        for _ in range(rnd.choice([0, 1, 5, 60, 400])):
            text += names[min(int(rnd.paretovariate(0.5)), words) - 1].replace("w", rnd.choice("wW")) + rnd.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", " \x0b"])
        rows.append((text, rnd.choice(["en", "en", "en", "de", None, "und"])))
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus(1, 80) + [("deep learning model works", "en")] * 30 + [(None, "en"), ("", None), ("...", "fr"), ("one", "fr")]


def test_equals_counting_one_by_one(spark, rows):
    assert found(spark, rows) == slow(rows)


def test_small_tiles_buckets_and_batches(spark, rows, monkeypatch):
    for name, value in {
        "TILE": 8, "DENSE": 2, "STRIPS": 4, "FAN_IN": 2, "HELD_CELLS": 20, "BUCKET_PAIRS": 50, "HELD_WORDS": 15,
        "ROWS_AT_ONCE": 3, "CHUNK_BYTES": 100, "BATCH_BYTES": 300, "BUCKET_BYTES": 64,
    }.items():
        monkeypatch.setattr(co, name, value)
    assert found(spark, rows) == slow(rows)


def test_a_piece_may_be_longer_than_a_chunk(spark, monkeypatch):
    monkeypatch.setattr(co, "CHUNK_BYTES", 64)
    rows = [("alpha beta gamma " * 60 + ". delta " * 30, "en")]
    assert found(spark, rows) == slow(rows)
    assert b"".join(co.chunks(rows[0][0].encode())) == rows[0][0].encode()


def test_equal_scores_take_the_first_cut(spark):
    rows = [("a b c", "x")] * 12
    assert found(spark, rows) == {("x", "a b c"): (12, 12, 12, 36, 1_000_000)}


@pytest.mark.parametrize("rows", [[], [(None, None)], [("a b c", "en")] * 9])
def test_nothing(spark, rows):
    assert found(spark, rows) == {}


def test_batches_stay_in_their_buckets(spark):
    from pyspark.sql import functions as F

    from riskloom.llm.common import save, save_in_buckets

    stored = save_in_buckets(spark.range(40).select(F.col("id").alias("batch"), F.lit("x").alias("ids")), "stay", "batch")
    answers = save(spark.range(40).select(F.col("id").alias("batch"), F.lit("y").alias("answers")), "answers")
    joined = stored.join(answers.hint("merge"), "batch")
    assert joined._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert joined.count() == 40


def test_cells():
    rng = np.random.default_rng(2)
    cells, seen = Cells(100), Counter()
    for _ in range(50):
        codes, counts = np.unique(rng.integers(0, 400, 90), return_counts=True)
        cells.add(codes, counts)
        seen.update(dict(zip(codes.tolist(), counts.tolist())))
    codes, counts = cells.merge()
    assert dict(zip(codes.tolist(), counts.tolist())) == dict(seen)
    assert (np.diff(codes) > 0).all()


def test_strips_cover_the_corner():
    codes = np.concatenate([co.strip_codes(-1 - b) for b in range(co.DENSE * co.DENSE * co.STRIPS)])
    side = co.DENSE * co.TILE
    expected = (np.arange(side)[:, None] << co.SECOND | np.arange(side)[None, :]).ravel()
    assert np.array_equal(np.sort(codes), expected)


def test_scores_beyond_64_bits(spark):
    a = 3_000_000_007
    got = spark.range(1).select(co.score(co.F.lit(a), co.F.lit(a + 5), co.F.lit(a + 9)).alias("s")).first()["s"]
    assert got == 1_000_000 * a * a // ((a + 5) * (a + 9))


def test_query_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    got = co.op12(spark, sf_dir)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    sql = con.execute(co.op12_sql())
    names = [d[0] for d in sql.description]
    assert names == got.columns
    assert sorted(sql.fetchall()) == sorted(map(tuple, got.collect()))
