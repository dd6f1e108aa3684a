"""Document fingerprints: order MinHash over code-point k-mers.

Every k-mer is numbered by its occurrence within the text. Under each of ``PERMUTATIONS`` orders of the numbered
k-mers the ``2`` least are selected, put back into text order and hashed as a tuple; the tuple hashes are the
fingerprint. Two texts agree at a place only if they hold the same selected k-mers in the same order, so the share
of agreeing places falls with edits as well as with moved passages.

A text and its edited form share all numbered k-mers of the kept part, whose least ones are found once for both.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import U64, arrow_schema, batch_of, mix, rolling, shuffle_partitions, table, texts_as_bytes

K = 8
PERMUTATIONS = 64
# Columns of hashes computed at a time: bounds the memory for a text of any length.
BLOCK = 1 << 14

OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

_SEEDS = mix(np.arange(1, PERMUTATIONS + 1, dtype=U64) * U64(0x9E3779B97F4A7C15))
_XOR = (_SEEDS >> U64(32)).astype(np.uint32)[:, None]
_ODD = (_SEEDS.astype(np.uint32) | np.uint32(1))[:, None]
_ROWS = np.arange(PERMUTATIONS)
_NONE = np.uint32(0xFFFFFFFF)


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def kmers(codes: np.ndarray, k: int = K) -> np.ndarray:
    """32-bit hashes of all k-mers; a shorter text is its own only k-mer; none for an empty text."""
    if not len(codes):
        return np.empty(0, np.uint32)
    return (rolling(mix(codes.astype(U64) + U64(1)), min(k, len(codes)))[: max(1, len(codes) - k + 1)] >> U64(32)).astype(np.uint32)


def numbered(hashes: np.ndarray) -> np.ndarray:
    """32-bit identity of (k-mer, occurrence number), occurrences counted in text order."""
    n = len(hashes)
    if not n:
        return hashes
    ranked = np.sort(hashes.astype(U64) << U64(32) | np.arange(n, dtype=U64))
    place, kmer = (ranked & U64(0xFFFFFFFF)).astype(np.int64), ranked >> U64(32)
    fresh = np.concatenate(([True], kmer[1:] != kmer[:-1]))
    starts = np.flatnonzero(fresh)
    turn = np.arange(n) - starts[np.cumsum(fresh) - 1]
    out = np.empty(n, np.uint32)
    out[place] = (mix(kmer << U64(24) ^ turn.astype(U64) * U64(0xD6E8FEB86659FD93)) >> U64(32)).astype(np.uint32)
    return out


Least = tuple[np.ndarray, np.ndarray]  # order values and places of the two least, one row for each permutation


def least_two(items: np.ndarray, shift: int) -> Least:
    """The two least items under each order; places count from ``shift``; missing ones have place -1."""
    values = np.full((PERMUTATIONS, 2), _NONE, np.uint32)
    places = np.full((PERMUTATIONS, 2), -1, np.int64)
    for at in range(0, len(items), BLOCK):
        part = items[at : at + BLOCK]
        h = (part[None, :] ^ _XOR) * _ODD
        h >>= np.uint32(1)  # leaves the greatest value for "none"
        found_v, found_p = [], []
        for _ in range(min(2, len(part))):
            p = h.argmin(axis=1)
            found_v.append(h[_ROWS, p])
            found_p.append(p + at + shift)
            h[_ROWS, p] = _NONE
        if found_v:
            values, places = merged((values, places), (np.stack(found_v, 1), np.stack(found_p, 1)))
    return values, places


def merged(a: Least, b: Least) -> Least:
    values, places = np.concatenate((a[0], b[0]), 1), np.concatenate((a[1], b[1]), 1)
    order = np.argsort(values, axis=1, kind="stable")[:, :2]
    return values[_ROWS[:, None], order], places[_ROWS[:, None], order]


def signature(chosen: Least, items: np.ndarray) -> np.ndarray:
    """Hashes of the selected items in text order, 16 bits each; all zero for an empty text."""
    places = np.sort(chosen[1], axis=1)
    if not len(items):
        return np.zeros(PERMUTATIONS, np.uint16)
    at = lambda column: np.where(column >= 0, items[np.maximum(column, 0)], 0).astype(U64)
    pair = at(places[:, 0]) << U64(32) | at(places[:, 1])
    return (mix(pair ^ _SEEDS) >> U64(48)).astype(np.uint16)


def fingerprint(text: str) -> np.ndarray:
    items = numbered(kmers(codes_of(text)))
    return signature(least_two(items, 0), items)


def both_fingerprints(text: str, edited: str, kept: int) -> tuple[np.ndarray, np.ndarray]:
    """Of ``text`` and of ``edited``, which share their first ``kept`` code points."""
    a, b = kmers(codes_of(text)), kmers(codes_of(edited))
    shared = max(0, min(kept - K + 1, len(a), len(b)))
    x, y = numbered(a), numbered(b)
    head = least_two(x[:shared], 0)
    return signature(merged(head, least_two(x[shared:], shared)), x), signature(merged(head, least_two(y[shared:], shared)), y)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of common numbered k-mers: a place agrees with the square of that probability."""
    return float(np.sqrt(np.mean(a == b)))


def edit(text: str, following: str) -> tuple[str, int]:
    """The last quarter replaced by the first as many code points of ``following``; and how many are kept."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut], len(text) - cut


def text_form(signs: np.ndarray) -> str:
    return signs.astype(">u2").tobytes().hex()


def _measured(doc_id: int | None, text: str, following: str) -> dict:
    edited, kept = edit(text, following)
    own, other = both_fingerprints(text, edited, kept)
    return {
        "doc_id": doc_id, "n_chars": len(text), "edited_sha256": hashlib.sha256(edited.encode()).hexdigest(),
        "fingerprint": text_form(own), "edited_fingerprint": text_form(other), "near_edited": likeness(own, other), "signs": own,
    }


class Successions:
    """Rows of one range in order, the head of the next range last; gives each row once its successor is known."""

    def __init__(self):
        self.current: tuple[int | None, str] | None = None  # waits for the text of its successor
        self.previous: dict | None = None  # waits for the fingerprint of its successor

    def add(self, doc_id: int | None, text: str, extra: bool) -> Iterator[dict]:
        if self.current is not None:
            row = _measured(*self.current, text)
            if self.previous is not None:
                yield self.previous | {"near_next": likeness(self.previous["signs"], row["signs"])}
            self.previous = row
        if not extra:
            self.current = (doc_id, text)
        elif self.current is not None:  # further copies of the next range's head change nothing
            yield self.previous | {"near_next": likeness(self.previous["signs"], fingerprint(text))}
            self.current = self.previous = None


def _last_key(doc_id: int | None) -> int:
    return 2**63 - 1 if doc_id is None else doc_id


def _heads(source: DataFrame, cuts: list[int]) -> dict[int, tuple[int, int]]:
    """(doc_id, hash) of the first row of each range that has rows: a pair for each range."""

    def first(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[int, tuple[int, int]] = {}
        for frame in frames:
            for row in zip(map(_last_key, frame.column("doc_id").to_pylist()), frame.column("hash").to_pylist()):
                b = bisect_right(cuts, row[0])
                least[b] = min(least.get(b, row), row)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(least), pa.int32()), pa.array([v[0] for v in least.values()], pa.int64()), pa.array([v[1] for v in least.values()], pa.int64())],
            names=["bucket", "key", "hash"],
        )

    found = source.select("doc_id", "hash").mapInArrow(first, "bucket int, key long, hash long")
    return {r["bucket"]: (r["head"]["key"], r["head"]["hash"]) for r in found.groupBy("bucket").agg(F.min(F.struct("key", "hash")).alias("head")).collect()}


def fingerprints(docs: DataFrame) -> DataFrame:
    """For each row the fingerprints of its text and of its edited text, and its likeness to that and to the next row.

    Rows are ordered by doc_id, then by a hash of the text; null ids come last. A null text is empty; two empty texts
    are alike (1.0). A single row is its own successor. An empty table gives no rows.

    Texts cross the network once, compressed, dealt to ranges of doc_id. The first row of a range is sent to the
    range before as well (the very first to the last range), so each range finds all its successors.
    """
    spark = docs.sparkSession
    source = texts_as_bytes(docs).withColumn("hash", F.xxhash64("data"))
    n = 4 * shuffle_partitions(spark)
    # Range ends come from a sketch of bounded size.
    cuts = sorted({int(c) for c in docs.select(F.col("doc_id").cast("long").alias("doc_id")).approxQuantile("doc_id", [i / n for i in range(1, n)], 1 / (4 * n))})
    heads = _heads(source, cuts)
    order = sorted(heads)
    sent = {heads[order[(i + 1) % len(order)]]: b for i, b in enumerate(order)}
    dealt_schema = arrow_schema(spark, "bucket int, extra int, key long, hash long, doc_id long, data binary")

    def deal(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for frame in frames:
            rows = []
            for doc_id, h, data in zip(*(frame.column(c).to_pylist() for c in ("doc_id", "hash", "data"))):
                key, packed = _last_key(doc_id), squeeze.compress(data)
                rows.append((bisect_right(cuts, key), 0, key, h, doc_id, packed))
                if (key, h) in sent:
                    rows.append((sent[key, h], 1, key, h, doc_id, packed))
            yield batch_of({f.name: [r[i] for r in rows] for i, f in enumerate(dealt_schema)}, dealt_schema)

    dealt = source.mapInArrow(deal, "bucket int, extra int, key long, hash long, doc_id long, data binary")
    placed = dealt.repartition(shuffle_partitions(spark), "bucket").sortWithinPartitions("bucket", "extra", "key", "hash")
    out = arrow_schema(spark, OUT)

    def run(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand, state = zstandard.ZstdDecompressor(), Successions()
        for frame in frames:
            rows = []
            for extra, doc_id, data in zip(*(frame.column(c).to_pylist() for c in ("extra", "doc_id", "data"))):
                rows.extend(state.add(doc_id, expand.decompress(data).decode(), bool(extra)))
            yield batch_of({n: [r[n] for r in rows] for n in out.names}, out)

    return placed.mapInArrow(run, OUT)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
