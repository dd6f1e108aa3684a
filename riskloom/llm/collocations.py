"""Phrase collocations by direct-address tiling.

Words that occur often enough are ranked by frequency over the corpus; the rank is a word's id. A pair of neighbours is
then a cell of a matrix (first id, second id), cut into tiles of ``TILE`` x ``TILE`` cells. The tiles of the most
frequent ids are dense: every task counts them in arrays by ``numpy.bincount``. All other tiles are sparse: sorted
coordinates with counts, merged as sorted arrays. Cells that reach the least count are ranked by frequency in turn, and
a phrase's rank with the next word's id is the cell of a longer phrase: one more round counts the phrases of three.

Texts are read twice: for the words' counts, and to turn them into batches of word numbers. A batch asks for the ids of
its distinct words, later for those of its distinct pairs, by their hash buckets (``lookup``), so no dictionary is ever
held whole by a task. Words are told apart by 64-bit hashes of (language, word) there; counts of single words, and what is
returned, are those of the words themselves.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.common import U64, Cells, Words, arrow_schema, batch_of, limit_frames, map_rows, mix, pack, partition_number, save, save_in_buckets, small_side, table, trimmed, unpack
from riskloom.operators.running import running

AT_LEAST = 10
MOST = 2000
NO_LANGUAGE = "und"
# A phrase goes if a longer one that holds it has at least half of its occurrences.
SHARE = (50, 100)

# Cells along a tile's side, and tiles along the side of the dense corner.
TILE = 1024
DENSE = 2
# A dense tile is sent in so many strips.
STRIPS = 16
# Tasks whose dense tiles are added up before they meet the others'.
FAN_IN = 32
# Bits of a cell's code that hold the second id.
SECOND = 31

# Sparse cells that a task holds before it sends them, and occurrences for each bucket of sparse tiles.
HELD_CELLS = 1 << 19
BUCKET_PAIRS = 1 << 22
# Distinct words that a task holds before it sends their counts, and bytes of text read for them.
HELD_WORDS = 200_000
HELD_BYTES = 64 << 20
ROWS_AT_ONCE = 10_000
# Bytes of text hashed at once, and in a batch; longer texts are cut between pieces.
CHUNK_BYTES = 1 << 20
BATCH_BYTES = 4 << 20
# Bytes of asked keys in a bucket of a lookup.
BUCKET_BYTES = 16 << 20

_SEPARATORS = b".,;:!?\n\x0b\x0c\r"
_PIECE_END = re.compile(rb"[.,;:!?\x0A-\x0D]")
_TO_SPACE = bytes(0x20 if b in _SEPARATORS else b for b in range(256))
_ENDS_PIECE = np.isin(np.arange(256), list(_SEPARATORS))
_BETWEEN = _ENDS_PIECE | np.isin(np.arange(256), [0x20, 0x09])


def language_and_bytes(docs: DataFrame, text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    limit_frames(docs.sparkSession)
    return docs.select(
        F.coalesce(F.col(lang_column), F.lit(NO_LANGUAGE)).alias("lang"),
        F.coalesce(F.col(text_column), F.lit("")).cast("binary").alias("data"),
    )


# --- words ---


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, word, c) of all words, and with a null word the sum over the language."""
    schema = arrow_schema(texts.sparkSession, "lang string, word binary, c long")

    def rows(counts: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, seen in counts.items():
            words = [None, *seen]
            totals = [seen.total(), *seen.values()]
            for i in range(0, len(words), ROWS_AT_ONCE):
                part = words[i : i + ROWS_AT_ONCE]
                yield batch_of({"lang": [lang] * len(part), "word": part, "c": totals[i : i + ROWS_AT_ONCE]}, schema)

    def count(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        read = 0
        for frame in frames:
            for lang, data in zip(frame.column("lang").to_pylist(), frame.column("data")):
                for chunk in chunks(data.as_py()):
                    counts.setdefault(lang, Counter()).update(chunk.lower().translate(_TO_SPACE).split())
                    read += len(chunk)
                    if read > HELD_BYTES or sum(map(len, counts.values())) > HELD_WORDS:
                        yield from rows(counts)
                        counts, read = {}, 0
        yield from rows(counts)

    return texts.mapInArrow(trimmed(count), "lang string, word binary, c long").groupBy("lang", "word").agg(F.sum("c").alias("c"))


def chunks(data: bytes) -> Iterator[bytes]:
    """The text in parts of about ``CHUNK_BYTES``, cut after the end of a piece; a longer piece stays whole."""
    start = 0
    while len(data) - start > CHUNK_BYTES:
        end = _PIECE_END.search(data, start + CHUNK_BYTES)
        if end is None:
            break
        yield data[start : end.end()]
        start = end.end()
    yield data[start:] if start else data


def ranked(counted: DataFrame, tie: list[str], label: str) -> DataFrame:
    """``counted`` (with column c) and ``id``: its place by falling c, from 0; written."""
    one = counted.select(F.lit(0).alias("all"), (-F.col("c")).alias("fewer"), *counted.columns, F.lit(1).cast("long").alias("one"))
    placed = running(one, ["all"], ["fewer", *tie], {"place": ("sum", "one")}, label)
    return save(placed.select(*counted.columns, (F.col("place") - 1).alias("id")), label)


def _language_code(lang: str) -> np.uint64:
    return U64(xxhash.xxh64_intdigest(lang.encode(), seed=7))


def word_keys(words: DataFrame) -> DataFrame:
    """(key, id) of ranked words; key as a signed number."""
    schema = arrow_schema(words.sparkSession, "key long, id long")

    def run(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            if frame.num_rows:
                hashes = Words(frame.column("word").to_pylist(), between=_BETWEEN).hashes
                codes = np.array([_language_code(lang) for lang in frame.column("lang").to_pylist()], U64)
                yield batch_of({"key": mix(hashes ^ codes).view(np.int64), "id": frame.column("id")}, schema)

    return words.select("lang", "word", "id").mapInArrow(trimmed(run), "key long, id long")


def token_batches(texts: DataFrame) -> DataFrame:
    """(batch, n_keys, n_words, keys, places, ends), written: a batch's distinct words, and its words as places among them.

    ``ends`` are the words before which a piece ends.
    """
    ddl = "batch long, n_keys long, n_words long, keys binary, places binary, ends binary"
    schema = arrow_schema(texts.sparkSession, ddl)

    def hashed(langs: list[str], parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the words, and whether each begins a piece."""
        words = Words(parts, lower=True, between=_BETWEEN)
        codes = np.array([_language_code(lang) for lang in langs], U64)
        keys = mix(words.hashes ^ codes[words.doc])
        data = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
        ends = np.flatnonzero(_ENDS_PIECE[data])
        edges = np.flatnonzero(np.diff(np.concatenate(([True], _BETWEEN[data]))))[::2]
        seen = np.searchsorted(ends, edges)
        begins = np.ones(len(keys), bool)
        begins[1:] = (np.diff(seen) > 0) | (np.diff(words.doc) > 0)
        return keys, begins

    def row(number: int, found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        keys, places = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
        begins = np.flatnonzero(np.concatenate([b for _, b in found])).astype(np.uint32)
        out = {"batch": number, "n_keys": len(keys), "n_words": len(places), "keys": pack(keys)}
        out |= {"places": pack(places.astype(np.uint32)), "ends": pack(np.diff(begins, prepend=np.uint32(0)))}
        return batch_of({k: [v] for k, v in out.items()}, schema)

    def build(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = partition_number() << 24
        langs, parts, size, found, whole = [], [], 0, [], 0
        for frame in frames:
            for lang, data in zip(frame.column("lang").to_pylist(), frame.column("data")):
                for part in chunks(data.as_py()):
                    langs.append(lang)
                    parts.append(part)
                    size += len(part) + 16
                    if size >= CHUNK_BYTES:
                        found.append(hashed(langs, parts))
                        whole += size
                        langs, parts, size = [], [], 0
                    if whole >= BATCH_BYTES:
                        yield row(number, found)
                        number, found, whole = number + 1, [], 0
        if parts:
            found.append(hashed(langs, parts))
        if found:
            yield row(number, found)

    return save_in_buckets(texts.mapInArrow(trimmed(build), ddl), "word-batches", "batch")


# --- lookup ---


def hash_buckets(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Equal ranges of 64-bit hashes."""
    return ((keys >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)


def lookup_buckets(n_keys: int) -> int:
    return max(16, 8 * n_keys // BUCKET_BYTES)


def lookup(
    asked: DataFrame, keys_of: Callable[[dict, int], tuple[np.ndarray, np.ndarray]], reads: list[str], n_keys: int,
    known: DataFrame, bucket_of: Callable[[np.ndarray, int], np.ndarray], label: str,
) -> DataFrame:
    """(batch, answers): the ids that ``known`` (key, id) has for the distinct keys of each row of ``asked``; else -1.

    ``keys_of`` gives a row's keys and their buckets, in order of (bucket, key); ``bucket_of`` gives the buckets of any keys. Their number
    follows ``n_keys``, the keys asked for. Answers come as one packed array a bucket: read them by ``answered``.
    """
    spark = asked.sparkSession
    buckets = lookup_buckets(n_keys)
    parts_ddl, out_ddl = "bucket int, batch long, keys binary", "batch long, bucket int, answer binary"
    parts_schema, out_schema = arrow_schema(spark, parts_ddl), arrow_schema(spark, out_ddl)
    known_schema = arrow_schema(spark, "bucket int, key long, id long")

    def split(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for i in range(frame.num_rows):
                keys, bucket = keys_of({c: frame.column(c)[i].as_py() for c in reads}, buckets)
                starts = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist()
                parts = [pack(np.diff(keys[x:y].view(np.int64), prepend=0)) for x, y in zip(starts, [*starts[1:], len(keys)])]
                batch = [frame.column("batch")[i].as_py()] * len(parts)
                yield batch_of({"bucket": bucket[starts].tolist(), "batch": batch, "keys": parts}, parts_schema)

    def with_bucket(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            bucket = bucket_of(frame.column("key").to_numpy().view(U64), buckets)
            yield batch_of({"bucket": bucket, "key": frame.column("key"), "id": frame.column("id")}, known_schema)

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        known_keys = right.column("key").to_numpy().astype(np.int64)
        order = np.argsort(known_keys)
        known_keys, ids = known_keys[order], right.column("id").to_numpy()[order]
        out = []
        for keys in left.column("keys"):
            keys = np.cumsum(unpack(keys.as_py(), np.int64))
            if len(known_keys):
                at = np.minimum(np.searchsorted(known_keys, keys), len(known_keys) - 1)
                out.append(pack(np.where(known_keys[at] == keys, ids[at], -1)))
            else:
                out.append(pack(np.full(len(keys), -1, np.int64)))
        return pa.table({"batch": left.column("batch"), "bucket": left.column("bucket"), "answer": pa.array(out, pa.binary())}, schema=out_schema)

    parts = asked.select("batch", *reads).mapInArrow(trimmed(split), parts_ddl).groupBy("bucket")
    there = known.mapInArrow(trimmed(with_bucket), "bucket int, key long, id long").groupBy("bucket")
    found = parts.cogroup(there).applyInArrow(answer, out_ddl)
    return save(found.groupBy("batch").agg(F.sort_array(F.collect_list(F.struct("bucket", "answer"))).alias("answers")), label)


def answered(row: dict) -> np.ndarray:
    found = [unpack(a["answer"], np.int64) for a in row["answers"] or []]
    return np.concatenate(found) if found else np.empty(0, np.int64)


def word_questions(row: dict, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    keys = unpack(row["keys"], U64)
    return keys, hash_buckets(keys, buckets)


# --- tiles ---

CELLS = "bucket long, task long, codes binary, counts binary"


class Tiles:
    """One task's counts: arrays for the dense corner's tiles, sorted cells for the others."""

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.dense = [np.zeros(TILE * TILE, np.uint32) for _ in range(DENSE * DENSE)]
        self.sparse = Cells(HELD_CELLS // 2)

    def add(self, first: np.ndarray, second: np.ndarray) -> Iterator[dict]:
        corner = (first < DENSE * TILE) & (second < DENSE * TILE)
        x, y = first[corner], second[corner]
        of_tile = x // TILE * DENSE + y // TILE
        cell = x % TILE * TILE + y % TILE
        for t, tile in enumerate(self.dense):
            tile += np.bincount(cell[of_tile == t], minlength=TILE * TILE).astype(np.uint32)
        codes, counts = np.unique(first[~corner] << SECOND | second[~corner], return_counts=True)
        self.sparse.add(codes, counts)
        if self.sparse.merged > HELD_CELLS:
            yield from self.sparse_rows()

    def sparse_rows(self) -> Iterator[dict]:
        codes, counts = self.sparse.merge()
        self.sparse = Cells(HELD_CELLS // 2)
        bucket = bucket_of(codes, self.buckets)
        order = np.argsort(bucket, kind="stable")
        bucket, codes, counts = bucket[order], codes[order], counts[order]
        starts = np.flatnonzero(np.diff(bucket, prepend=-1))
        for x, y in zip(starts, [*starts[1:], len(bucket)]):
            yield {"bucket": int(bucket[x]), "codes": pack(np.diff(codes[x:y], prepend=0)), "counts": pack(counts[x:y].astype(np.uint32))}

    def dense_rows(self) -> Iterator[dict]:
        for t, tile in enumerate(self.dense):
            for s, strip in enumerate(np.split(tile, STRIPS)):
                if strip.any():
                    yield {"bucket": -1 - (t * STRIPS + s), "codes": None, "counts": pack(strip.astype(np.int64))}


def bucket_of(codes: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of a cell: that of its tile."""
    codes = codes.view(np.int64)
    tile = (codes >> SECOND) // TILE << SECOND | (codes & ((1 << SECOND) - 1)) // TILE
    return (mix(tile.view(U64)) % U64(buckets)).astype(np.int64)


def strip_codes(bucket: int) -> np.ndarray:
    """The codes of a dense strip's cells."""
    t, s = divmod(-1 - bucket, STRIPS)
    cell = np.arange(TILE * TILE // STRIPS, dtype=np.int64) + s * (TILE * TILE // STRIPS)
    return (t // DENSE * TILE + cell // TILE) << SECOND | (t % DENSE * TILE + cell % TILE)


def _sums(frames: Iterable[pa.RecordBatch], by: tuple[str, ...]) -> Iterator[tuple[tuple, np.ndarray, np.ndarray]]:
    """(group, codes, counts) of rows that come in the groups' order; dense groups have no codes. One group is held at a time."""
    group, strip, cells = None, None, Cells(HELD_CELLS // 2)
    for frame in frames:
        for i in range(frame.num_rows):
            key = tuple(frame.column(c)[i].as_py() for c in by)
            if key != group:
                if group is not None:
                    yield group, None if strip is not None else cells.merge()[0], strip if strip is not None else cells.merge()[1]
                group, strip, cells = key, None, Cells(HELD_CELLS // 2)
            codes, counts = frame.column("codes")[i].as_py(), frame.column("counts")[i].as_py()
            if codes is None:
                strip = unpack(counts, np.int64) + (0 if strip is None else strip)
            else:
                cells.add(np.cumsum(unpack(codes, np.int64)), unpack(counts, np.uint32).astype(np.int64))
    if group is not None:
        yield group, None if strip is not None else cells.merge()[0], strip if strip is not None else cells.merge()[1]


def frequent_cells(batches: DataFrame, cells_of: Callable[[dict], tuple[np.ndarray, np.ndarray]], reads: list[str], pairs: int, least: int, label: str) -> DataFrame:
    """(x, y, c) of all cells with at least ``least`` occurrences; ``cells_of`` gives a batch's ids of first and second.

    ``pairs`` bounds the occurrences; the number of buckets follows it.
    """
    spark = batches.sparkSession
    schema, out_schema = arrow_schema(spark, CELLS), arrow_schema(spark, "x long, y long, c long")
    buckets = max(16, -(-pairs // BUCKET_PAIRS))

    def count(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles, task = Tiles(buckets), partition_number()

        def frame_of(rows: Iterable[dict]) -> pa.RecordBatch:
            rows = list(rows)
            return batch_of({"bucket": [r["bucket"] for r in rows], "task": [task] * len(rows), "codes": [r["codes"] for r in rows], "counts": [r["counts"] for r in rows]}, schema)

        for frame in frames:
            for i in range(frame.num_rows):
                yield frame_of(tiles.add(*cells_of({c: frame.column(c)[i].as_py() for c in reads})))
        yield frame_of(tiles.sparse_rows())
        yield frame_of(tiles.dense_rows())

    def add(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (bucket, some), _, counts in _sums(frames, ("bucket", "some")):
            yield batch_of({"bucket": [bucket], "task": [some], "codes": [None], "counts": [pack(counts)]}, schema)

    def often(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (bucket,), codes, counts in _sums(frames, ("bucket",)):
            kept = counts >= least
            codes = (strip_codes(bucket) if codes is None else codes)[kept]
            counts = counts[kept]
            for i in range(0, len(codes), 1 << 16):
                some = codes[i : i + (1 << 16)]
                yield batch_of({"x": some >> SECOND, "y": some & ((1 << SECOND) - 1), "c": counts[i : i + (1 << 16)]}, out_schema)

    sent = save(batches.mapInArrow(trimmed(count), CELLS), f"{label}-cells")
    dense = sent.where("bucket < 0").withColumn("some", F.floor(F.col("task") / FAN_IN))
    dense = dense.repartition("bucket", "some").sortWithinPartitions("bucket", "some").select("bucket", "some", "codes", "counts").mapInArrow(trimmed(add), CELLS)
    met = sent.where("bucket >= 0").unionByName(dense).repartition("bucket").sortWithinPartitions("bucket")
    return met.select("bucket", "codes", "counts").mapInArrow(trimmed(often), "x long, y long, c long")


# --- phrases ---


def _neighbours(ids: np.ndarray) -> np.ndarray:
    """Places of words whose follower is a word of the same piece."""
    return np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))


def word_pairs(row: dict) -> tuple[np.ndarray, np.ndarray]:
    ids = unpack(row["ids"], np.int64)
    at = _neighbours(ids)
    return ids[at], ids[at + 1]


def distinct_pairs(row: dict, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The codes of a batch's distinct pairs and their buckets, in order of (bucket, code); for each of its pairs the place
    among them; where the pairs are; the words' ids."""
    ids = unpack(row["ids"], np.int64)
    at = _neighbours(ids)
    codes, places = np.unique(ids[at] << SECOND | ids[at + 1], return_inverse=True)
    bucket = bucket_of(codes, buckets)
    order = np.argsort(bucket, kind="stable")
    moved = np.empty(len(order), np.int64)
    moved[order] = np.arange(len(order))
    return codes[order], bucket[order], moved[places], at, ids


def pair_questions(row: dict, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    return distinct_pairs(row, buckets)[:2]


def pair_and_word(row: dict, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequent pairs followed by a word with which the pair's second word makes a frequent pair."""
    _, _, places, at, ids = distinct_pairs(row, buckets)
    pair = np.full(len(ids), -1, np.int64)
    pair[at] = answered(row)[places]
    follows = np.flatnonzero((pair[:-1] >= 0) & (pair[1:] >= 0))
    return pair[follows], ids[follows + 2]


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (l r)), exact up to counts of 15 digits."""
    d = lambda c: c.cast("decimal(15,0)")
    top = d(a) * d(a) * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", top, d(left) * d(right))


def collocations(docs: DataFrame, least: int = AT_LEAST, share: tuple[int, int] = SHARE) -> tuple[DataFrame, DataFrame]:
    """All phrases of two and three words with their best evidence, and the languages' sizes (lang, n).

    Phrases are (lang, phrase, n_words, cut, a, l, r, score). Null texts are empty, null languages are ``und``; repeated rows
    count each time; of equally low cuts the first counts. Columns other than text and lang, whatever their names, are not
    read. An empty table has no phrases.
    """
    texts = language_and_bytes(docs)
    counted = save(word_counts(texts).where(F.col("word").isNull() | (F.col("c") >= least)), "word-counts")
    words = ranked(counted.where("word is not null"), ["lang", "word"], "ranked-words")
    sizes = counted.where("word is null").select("lang", F.col("c").alias("n"))

    batches = token_batches(texts)
    n_keys, n_words = batches.agg(F.sum("n_keys"), F.sum("n_words")).first()
    n_keys, n_words = n_keys or 0, n_words or 0
    found = lookup(batches, word_questions, ["keys"], n_keys, word_keys(words), hash_buckets, "word-ids")

    def as_ids(row: dict) -> Iterator[dict]:
        ids = answered(row)[unpack(row["places"], np.uint32)]
        ids = np.insert(ids, np.cumsum(unpack(row["ends"], np.uint32).astype(np.int64)), -1)
        wanted = (ids >= 0) | (np.concatenate(([0], ids[:-1])) >= 0)
        yield {"batch": row["batch"], "ids": pack(ids[wanted])}

    # Batches stay in their buckets: of both joins only the answers are shuffled, at any size.
    with_ids = batches.select("batch", "places", "ends").join(found.hint("merge"), "batch", "left")
    numbered = save_in_buckets(map_rows(with_ids, as_ids, "batch long, ids binary"), "numbered-texts", "batch")

    pairs = ranked(frequent_cells(numbered, word_pairs, ["ids"], n_words, least, "pairs"), ["x", "y"], "ranked-pairs")
    keyed = pairs.select((F.shiftleft(F.col("x"), SECOND).bitwiseOR(F.col("y"))).alias("key"), "id")
    # A batch has no more distinct pairs than words.
    pair_ids = lookup(numbered, pair_questions, ["ids"], n_words, keyed, bucket_of, "pair-ids")
    buckets = lookup_buckets(n_words)
    followed = numbered.join(pair_ids.hint("merge"), "batch")
    triples = frequent_cells(followed, lambda row: pair_and_word(row, buckets), ["ids", "answers"], n_words, least, "triples")
    return _phrases(words, pairs, save(triples, "frequent-triples"), share), sizes


def _phrases(words: DataFrame, pairs: DataFrame, triples: DataFrame, share: tuple[int, int]) -> DataFrame:
    def word(i: int, at: str) -> DataFrame:
        return small_side(words).select(F.col("id").alias(at), F.col("word").cast("string").alias(f"w{i}"), F.col("c").alias(f"f{i}"), F.col("lang").alias(f"lang{i}"))

    starts = small_side(pairs).select(F.col("id").alias("p"), F.col("x").alias("first"), F.col("y").alias("middle"), F.col("c").alias("f12"))
    ends = small_side(pairs).select(F.col("id").alias("q"), F.col("x").alias("middle"), F.col("y").alias("last"), F.col("c").alias("f23"))
    threes = triples.select(F.col("x").alias("p"), F.col("y").alias("last"), F.col("c").alias("a")).join(starts, "p").join(ends, ["middle", "last"])
    threes = save(threes, "triples-parts")

    inside = threes.select(F.col("p").alias("id"), "a").unionByName(threes.select(F.col("q").alias("id"), "a"))
    longer = inside.groupBy("id").agg(F.max("a").alias("longer"))
    least, of = share
    # A long phrase's pairs are few beside all pairs, but may be many: no hint.
    twos = pairs.join(longer, "id", "left").where(F.col("longer").isNull() | (F.col("longer") * of < F.col("c") * least))
    twos = twos.select(F.col("x").alias("first"), F.col("y").alias("last"), F.col("c").alias("a"))
    twos = twos.join(word(1, "first"), "first").join(word(2, "last"), "last")
    two = twos.select(
        F.col("lang1").alias("lang"), F.concat_ws(" ", "w1", "w2").alias("phrase"), F.lit(2).alias("n_words"), F.lit(1).alias("cut"), "a",
        F.col("f1").alias("l"), F.col("f2").alias("r"), score(F.col("a"), F.col("f1"), F.col("f2")).alias("score"),
    )

    threes = threes.join(word(1, "first"), "first").join(word(2, "middle"), "middle").join(word(3, "last"), "last")
    early, late = score(F.col("a"), F.col("f1"), F.col("f23")), score(F.col("a"), F.col("f12"), F.col("f3"))
    pick = lambda one, other: F.when(late < early, other).otherwise(one)
    three = threes.select(
        F.col("lang1").alias("lang"), F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), F.lit(3).alias("n_words"),
        pick(F.lit(1), F.lit(2)).alias("cut"), "a", pick(F.col("f1"), F.col("f12")).alias("l"), pick(F.col("f23"), F.col("f3")).alias("r"),
        F.least(early, late).alias("score"),
    )
    return two.unionByName(three)


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2000 phrases of ``documents`` with the highest scores."""
    phrases, sizes = collocations(table(spark, sf_dir, "documents"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    top = phrases.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= MOST)
    # A row for each language, and the phrases are at most MOST of each.
    return top.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_sql() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
    WITH pieces AS (
      SELECT coalesce(lang, 'und') AS lang,
             unnest(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\x0A-\x0D]')) AS piece
      FROM documents),
    lists AS (
      SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws FROM pieces),
    grams AS (
      SELECT lang, unnest(ws) AS g, 1 AS k FROM lists
      UNION ALL
      SELECT lang, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])), 2 FROM lists WHERE len(ws) >= 2
      UNION ALL
      SELECT lang, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])), 3
      FROM lists WHERE len(ws) >= 3),
    f AS (SELECT lang, g, k, count(*) AS c FROM grams GROUP BY lang, g, k),
    total AS (SELECT lang, sum(c)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
    often AS (SELECT lang, g, k, c, string_split(g, ' ') AS w FROM f WHERE c >= {AT_LEAST}),
    twos AS (
      SELECT o.lang, o.g, o.c AS a, x.c AS l, y.c AS r,
             ((1000000::HUGEINT * o.c * o.c) // (x.c::HUGEINT * y.c))::BIGINT AS score
      FROM often o
      JOIN often x ON x.lang = o.lang AND x.k = 1 AND x.g = o.w[1]
      JOIN often y ON y.lang = o.lang AND y.k = 1 AND y.g = o.w[2]
      WHERE o.k = 2),
    threes AS (
      SELECT o.lang, o.g, o.c AS a, o.w[1] || ' ' || o.w[2] AS p, o.w[2] || ' ' || o.w[3] AS q,
             x.c AS l1, yz.c AS r1, xy.c AS l2, z.c AS r2,
             ((1000000::HUGEINT * o.c * o.c) // (x.c::HUGEINT * yz.c))::BIGINT AS s1,
             ((1000000::HUGEINT * o.c * o.c) // (xy.c::HUGEINT * z.c))::BIGINT AS s2
      FROM often o
      JOIN often x ON x.lang = o.lang AND x.k = 1 AND x.g = o.w[1]
      JOIN often z ON z.lang = o.lang AND z.k = 1 AND z.g = o.w[3]
      JOIN often xy ON xy.lang = o.lang AND xy.k = 2 AND xy.g = o.w[1] || ' ' || o.w[2]
      JOIN often yz ON yz.lang = o.lang AND yz.k = 2 AND yz.g = o.w[2] || ' ' || o.w[3]
      WHERE o.k = 3),
    longer AS (
      SELECT lang, g, max(a) AS most FROM (SELECT lang, p AS g, a FROM threes UNION ALL SELECT lang, q, a FROM threes) GROUP BY lang, g),
    kept AS (
      SELECT t.lang, t.g, t.a, t.l, t.r, t.score FROM twos t LEFT JOIN longer USING (lang, g) WHERE most IS NULL OR 100 * most < 50 * t.a
      UNION ALL
      SELECT lang, g, a, CASE WHEN s2 < s1 THEN l2 ELSE l1 END, CASE WHEN s2 < s1 THEN r2 ELSE r1 END, least(s1, s2) FROM threes),
    placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank FROM kept)
    SELECT lang, rank, g AS phrase, a, l, r, n, score FROM placed JOIN total USING (lang) WHERE rank <= {MOST}
    """
