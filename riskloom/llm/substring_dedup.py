"""Substring dedup: repeated word windows behind a count-min prefilter.

A window of ``WINDOW`` words is represented in the sketch by the least hash of its ``GRAM``-word parts, so that equal
windows have equal representatives and a run of neighbouring windows shares one. Every batch of documents adds up
a sparse sketch of ``ROWS`` rows: for each cell the number of its documents that hit it. The partial sketches are merged cell by
cell, which overestimates in how many documents a window can be, and never underestimates. Only windows estimated to
be in two documents or more go to the second pass, which groups them by their own hash and finds the least doc_id
of each. The width of the sketch follows the measured size of the text, so its error does not grow with the corpus.

Word and window hashes have 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import (
    U64, Words, answers, batches, exchange, map_rows, merged_intervals, mix, pack, rolling, save, sliding_min, small_side,
    table, texts_of, unpack,
)

WINDOW = 50
GRAM = 25
ROWS = 2
# Cells of a sketch row for each expected key.
CELLS_PER_KEY = 16
NO_ID = 2**63 - 1

_ROW_SEEDS = (0x8BB84B93962EACC9, 0x2D358DCCAA6C78A5)


def representatives(words: Words, at: np.ndarray, window: int, gram: int) -> np.ndarray:
    """Least hash of the ``gram``-word parts of the windows at the given positions."""
    if not len(at):
        return np.empty(0, U64)
    return sliding_min(rolling(words.hashes, gram), window - gram + 1)[at]


def cells(keys: np.ndarray, row: int, bits: int) -> np.ndarray:
    """Cell of each key, as a 64-bit number led by the cell and ended by the row."""
    return mix(keys ^ U64(_ROW_SEEDS[row])) >> U64(64 - bits) << U64(64 - bits) | U64(row)


def partial_sketch(docs: np.ndarray, keys: np.ndarray, known: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells hit by a batch and by how many of its documents; ``known`` leaves out documents without an id."""
    change = np.concatenate(([True], (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1])))[: len(keys)]
    docs, keys = docs[change], keys[change]
    docs, keys = docs[known[docs]], keys[known[docs]]
    found, counts = [], []
    for row in range(ROWS):
        cell = cells(keys, row, bits)
        order = np.lexsort((docs, cell))
        c, d = cell[order], docs[order]
        once = np.concatenate(([True], (c[1:] != c[:-1]) | (d[1:] != d[:-1])))[: len(c)]
        unique, n = np.unique(c[once], return_counts=True)
        found.append(unique)
        counts.append(n)
    joined = np.concatenate(found)
    order = np.argsort(joined)
    return joined[order], np.concatenate(counts)[order].astype(np.int64)


def sketch_bits(docs: DataFrame, window: int, gram: int) -> int:
    """Bits of a cell number, from the bytes of all texts: about one key for each step of the least part."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    keys = max(1, int(size / 6 * 2 / (window - gram + 2)))
    return min(56, max(12, (CELLS_PER_KEY * keys).bit_length()))


def repeated_words(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """(batches of whole texts, removed words): the second has for each batch the documents' maximal removed spans.

    A word is removed if a window covers it whose words also start, as a window, in a document with a smaller
    doc_id. Documents without an id neither lose words nor take them from others.
    """
    bits = sketch_bits(docs, window, gram)

    def sketch(ids: list, texts: list[bytes]) -> dict:
        words = Words(texts)
        at = words.windows(window)
        keys = representatives(words, at, window, gram)
        known = np.array([i is not None for i in ids])
        c, n = partial_sketch(words.doc[at], keys, known, bits) if len(at) else (np.empty(0, U64), np.empty(0, np.int64))
        return {"keys": pack(c), "payload": pack(n)}

    held = batches(docs, "windows", sketch, "keys binary, payload binary")
    estimates = exchange(held, "sketch")

    def second(row: dict) -> Iterator[dict]:
        words = Words(texts_of(row))
        at = words.windows(window)
        keys = representatives(words, at, window, gram)
        often = unpack(row["keys"], U64)[answers(row) >= 2]
        maybe = np.ones(len(at), bool)
        for r in range(ROWS):
            maybe &= np.isin(cells(keys, r, bits), often)
        ids = np.array([NO_ID if i is None else i for i in row["doc_ids"]], np.int64)
        maybe &= np.array([i is not None for i in row["doc_ids"]], bool)[words.doc[at]]
        at = at[maybe]
        hashes = rolling(words.hashes, window)[at] if len(at) else np.empty(0, U64)
        unique, which = np.unique(hashes, return_inverse=True)
        least = np.full(len(unique), NO_ID, np.int64)
        np.minimum.at(least, which, ids[words.doc[at]])
        yield {
            "batch": row["batch"], "doc_ids": row["doc_ids"], "keys": pack(unique), "payload": pack(least),
            "starts": pack(words.starts), "at": pack(np.diff(at, prepend=0).astype(np.uint32)), "which": pack(which.astype(np.uint32)),
        }

    joined = held.drop("payload").join(small_side(estimates), "batch")
    grouped = save(
        map_rows(joined, second, "batch long, doc_ids array<bigint>, keys binary, payload binary, starts binary, at binary, which binary"),
        "repeated-windows",
    )
    elsewhere = exchange(grouped, "least-ids", "least")

    def removed(row: dict) -> Iterator[dict]:
        at = np.cumsum(unpack(row["at"], np.uint32).astype(np.int64))
        which, starts = unpack(row["which"], np.uint32), unpack(row["starts"], np.int64)
        doc = np.searchsorted(starts, at, side="right") - 1
        ids = np.array([NO_ID if i is None else i for i in row["doc_ids"]], np.int64)
        flagged = (answers(row, "least")[which] == 1) | (unpack(row["payload"], np.int64)[which] < ids[doc])
        at, doc = at[flagged], doc[flagged]
        lost = []
        for d in np.unique(doc).tolist():
            a, b = merged_intervals(at[doc == d] - starts[d], window)
            lost.append({"doc": d, "starts": a.tolist(), "ends": b.tolist()})
        yield {"batch": row["batch"], "lost": lost}

    spans = "batch long, lost array<struct<doc: int, starts: array<int>, ends: array<int>>>"
    return held, save(map_rows(grouped.join(small_side(elsewhere), "batch"), removed, spans), "removed-words")


def digest(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row; a null text has no words.

    Texts with fewer words than a window, and rows without a doc_id, keep all their words. Rows that repeat a doc_id
    take nothing from each other, as neither id is smaller. An empty table gives no rows.
    """
    held, lost = repeated_words(docs, window, window // 2)

    def rows(row: dict) -> Iterator[dict]:
        lost_of = {x["doc"]: (x["starts"], x["ends"]) for x in row["lost"] or []}
        for d, (doc_id, text) in enumerate(zip(row["doc_ids"], texts_of(row))):
            words = text.split()
            starts, ends = lost_of.get(d, ([], []))
            kept = [w for a, b in zip([0, *ends], [*starts, len(words)]) for w in words[a:b]] if starts else words
            digest_of = hashlib.sha256(b" ".join(kept)).hexdigest()
            yield {"doc_id": doc_id, "n_words": len(words), "n_removed": len(words) - len(kept), "kept_sha256": digest_of}

    joined = held.select("batch", "doc_ids", "lens", "blob").join(small_side(lost), "batch", "left")
    return map_rows(joined, rows, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "documents"))


def op6_sql(window: int = WINDOW) -> str:
    """Exact grouping of all windows, without a sketch."""
    return f"""
with d as (
  select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as words from documents
), w as (
  select doc_id, p, md5(array_to_string(words[p:p + {window - 1}], ' ')) as h
  from (select doc_id, words, unnest(range(1, len(words) - {window - 2})) as p from d where len(words) >= {window})
), least as (select h, min(doc_id) as first_id from w group by h having min(doc_id) < max(doc_id)),
gone as (
  select doc_id, unnest(range(p, p + {window})) as i from w join least using (h) where doc_id > first_id
), lost as (select doc_id, list(distinct i) as lost from gone group by doc_id)
select doc_id, cast(len(words) as bigint) as n_words, cast(coalesce(len(lost), 0) as bigint) as n_removed,
  sha256(array_to_string(list_transform(list_filter(range(1, len(words) + 1), lambda i: not coalesce(list_contains(lost, i), false)), lambda i: words[i]), ' ')) as kept_sha256
from d left join lost using (doc_id)"""
