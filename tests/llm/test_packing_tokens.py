"""The packing cache: small, quick, and right for strings that share a hash."""

import gc
import random
import tracemalloc

import numpy as np
import pytest

from riskloom.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.default_tokenizer())


def equal(words, tokenizer, texts):
    for t, ids in zip(texts, words.ids_of([t.encode() for t in texts]), strict=True):
        assert ids.tolist() == tokenizer.encode(t, add_special_tokens=False).ids + [packing.END_ID], t


def texts(rnd, n):
    letters = "abAB'stre1²½ é߀日<>|­\u0085\x1c  \n\t.,%"
    return ["".join(rnd.choices(letters, k=rnd.choice([0, 1, 5, 200, 2000]))) for _ in range(n)] + ["x" * 65 + " " + "!" * 64 + "a" * 70]


def test_known_words_take_little_memory():
    words = packing.WordTokens(packing.default_tokenizer())
    rnd = random.Random(1)
    text = " ".join("".join(rnd.choices("abcdefghij.0", k=8)) for _ in range(60_000)).encode()
    gc.collect()
    tracemalloc.start()
    words.ids_of([text])
    gc.collect()
    kept, known = tracemalloc.get_traced_memory()[0], len(words.words.young) + len(words.pieces.young)
    tracemalloc.stop()
    assert known > 60_000 and kept / known < 64


def test_merges_do_not_follow_the_number_of_lengths(tokenizer, monkeypatch):
    words, calls = packing.WordTokens(packing.default_tokenizer()), []
    rank = packing.Merges.rank
    monkeypatch.setattr(packing.Merges, "rank", lambda *a: calls.append(1) or rank(*a))
    rnd = random.Random(2)
    equal(words, tokenizer, ["".join(rnd.choices("etaoinsr", k=n)) for n in range(1, packing.LONGEST + 1)])
    assert len(calls) <= 2 * packing.LONGEST


@pytest.mark.parametrize("entries, group", [(10**6, 1 << 19), (40, 100), (0, 1)])
def test_bounded_cache(tokenizer, monkeypatch, entries, group):
    monkeypatch.setattr(packing, "CACHE_ENTRIES", entries)
    monkeypatch.setattr(packing, "GROUP_BYTES", group)
    words, rnd = packing.WordTokens(packing.default_tokenizer()), random.Random(3)
    for _ in range(4):
        equal(words, tokenizer, texts(rnd, 5))


def test_strings_that_share_a_hash(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "WEIGHTS", np.ones(packing.LONGEST, np.uint64))
    words, rnd = packing.WordTokens(packing.default_tokenizer()), random.Random(4)
    equal(words, tokenizer, ["abc cba a1b b1a", "bca 1ab"])
    for _ in range(4):
        equal(words, tokenizer, texts(rnd, 10))
