"""Shared pieces of the text operators: batches of whole texts and exact exchanges of hashed keys.

Several operators ask of very many hashed items (shingles, windows, anchors) how often each occurs in the
whole corpus, and need the answer back where the text is. Rows of single items would cost a shuffle many times
the input. Instead whole texts are gathered into *batches* of a few megabytes, written once, and a batch sends
its distinct keys, already summed, as packed arrays to key buckets and gets packed answers back. A key held by a
third of all documents so costs one entry for each batch. A batch's rows never change after it was written, so
a task that is run again after the loss of an executor sees the same documents under the same numbers.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.sources.stored import new_path, temporary_tables

# Bytes of text after which a batch is closed; a longer text is a batch of its own.
BATCH_BYTES = 1 << 20
# Written bytes up to which the answers of an exchange, or other small sides, are broadcast.
BROADCAST_BYTES = 32 << 20

# Rows, and bytes, that an executor hands to Python at a time; Spark's own defaults are ten times as many and more.
FRAME_ROWS = 1000
FRAME_BYTES = 4 << 20
# A batch's number: the partition's number, then the batch's place in it. A document's: the batch's, then its place.
PLACE_IN_PARTITION = 20
PLACE_IN_BATCH = 18

BATCH_SCHEMA = "batch long, doc_ids array<bigint>, lens array<bigint>, blob binary"

U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def save(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: cuts lineage, freezes generated numbers."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def save_alone(spark: SparkSession, label: str, build: Callable[[], DataFrame]) -> DataFrame:
    """As ``save`` of what ``build()`` gives; the tables saved on the way, which nothing reads any more, are deleted."""
    path = new_path(spark, label)
    with temporary_tables(spark):
        df = build()
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def save_in_buckets(df: DataFrame, label: str, key: str) -> DataFrame:
    """As ``save``, in as many buckets of ``key`` as there are shuffle partitions, without a shuffle.

    Joined on ``key``, the table stays where it is, and only the other side is shuffled. Each task writes a file for each bucket it has.
    """
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    df.write.bucketBy(shuffle_partitions(spark), key).option("path", new_path(spark, label)).saveAsTable(name)
    return spark.table(name)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def written_bytes(saved: DataFrame) -> int:
    """Bytes of the files of a table that ``save`` has just written."""
    spark = saved.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(saved.written_to)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


def small_side(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """A written table, hinted for broadcast only if its measured size allows it; else both sides shuffle."""
    return F.broadcast(df) if written_bytes(df) <= limit else df


def text_key(text: bytes) -> int:
    """What ``xxhash64`` of a text column gives for it; of a null text as for an empty one once it is coalesced."""
    return int(U64(xxhash.xxh64_intdigest(text, seed=42)).astype(np.int64))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def unpack(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def batch_of(columns: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def give_back() -> None:
    """Hand memory that a task has freed back to the system: Python workers live on between tasks, and keep it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(_LIBC, "malloc_trim", None)
    if trim is not None:
        trim(0)


def kept_between_tasks(forget: Callable[[], None]) -> None:
    """Register how to forget what a module keeps in a Python worker for its own later tasks."""
    _KEPT.append(forget)


def forget_kept() -> None:
    for forget in _KEPT:
        forget()


def trimmed(run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]], keep: bool = False) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``, with ``give_back`` at the end of every task.

    What other tasks have kept in the worker is forgotten first, unless ``keep`` says that ``run`` uses it.
    """

    def wrapped(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keep:
            forget_kept()
        yield from run(frames)
        give_back()

    return wrapped


_KEPT: list[Callable[[], None]] = []

try:
    _LIBC = ctypes.CDLL(None)
except (OSError, TypeError):  # not a POSIX system
    _LIBC = None


# --- hashing ---


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (finaliser with two multiplications)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_BASE = 0x9E3779B97F4A7C15
# A random-looking number for each byte.
BYTE_CODES = mix(np.arange(1, 257, dtype=U64) * U64(_BASE))
LOWER_CASE = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
IS_SPACE = np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
_POWERS: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, U64)
            steps[0] = 1
            _POWERS[i] = np.multiply.accumulate(steps)
    return _POWERS


def span_hashes(codes: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of the codes from each ``first`` to its ``last`` (exclusive), the same wherever they stand."""
    power, inverse = _powers(len(codes))
    sums = np.concatenate((np.zeros(1, U64), np.cumsum(codes * power[: len(codes)])))
    return mix((sums[last] - sums[first]) * inverse[first] + (last - first).astype(U64) * U64(0xD6E8FEB86659FD93))


class Words:
    """The words of a batch's texts, end to end, as 64-bit hashes: runs of bytes other than those ``between`` words.

    A word's hash is that of its bytes wherever it stands: a polynomial over the byte codes, read off prefix sums.
    """

    def __init__(self, texts: list[bytes], lower: bool = False, between: np.ndarray = IS_SPACE):
        data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        if lower:
            data = LOWER_CASE[data]
        space = between[data]
        edges = np.flatnonzero(np.diff(np.concatenate(([True], space))))
        first, last = edges[::2], edges[1::2]
        self.hashes = span_hashes(BYTE_CODES[data], first, last)
        stops = np.cumsum([len(t) + 1 for t in texts])
        self.ends = np.searchsorted(first, stops)
        self.starts = np.concatenate(([0], self.ends[:-1]))
        self.counts = self.ends - self.starts
        self.doc = np.repeat(np.arange(len(texts)), self.counts)

    def windows(self, size: int) -> np.ndarray:
        """Positions at which a window of that many words lies within one document."""
        return np.flatnonzero(np.arange(len(self.hashes)) + size <= self.ends[self.doc])


def rolling(x: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` items from each position, polynomial modulo 2^64, by doubling; the last k-1 are void."""
    current, length = x.copy(), 1
    done, covered = None, 0
    rest = k
    while rest:
        if rest & 1:
            if done is None:
                done, covered = current.copy(), length
            else:
                factor = U64(pow(_BASE, length, 1 << 64))
                done = done * factor
                if covered < len(x):
                    done[:-covered] += current[covered:]
                covered += length
        rest >>= 1
        if rest:
            factor = U64(pow(_BASE, length, 1 << 64))
            following = current[length:].copy()
            current *= factor
            if length < len(x):
                current[:-length] += following
            length *= 2
    return mix(done)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Least of the ``w`` items from each position; the last w-1 are void."""
    m, length = x.copy(), 1
    while length * 2 <= w and length < len(x):
        np.minimum(m[:-length], m[length:].copy(), out=m[:-length])
        length *= 2
    shift = w - length
    if 0 < shift < len(x):
        np.minimum(m[:-shift], m[shift:].copy(), out=m[:-shift])
    return m


def varied_min(x: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """Least of the ``widths[i]`` items from each position ``i``."""
    out = np.empty(len(widths), x.dtype)
    power = 1 << np.log2(widths).astype(np.int64)
    length, most = 1, int(power.max())
    while True:
        at = np.flatnonzero(power == length)
        out[at] = np.minimum(x[at], x[at + widths[at] - length])
        if length == most:
            return out
        x = np.minimum(x[:-length], x[length:])
        length *= 2


def runs_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the maximal runs of True."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return edges[::2], edges[1::2]


def merged_intervals(starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by intervals of one size: their starts and ends."""
    s = np.unique(starts)
    fresh = np.flatnonzero(np.concatenate(([True], s[1:] > s[:-1] + size)))
    return s[fresh], s[np.concatenate((fresh[1:] - 1, [len(s) - 1]))] + size


def merged_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by intervals of any size: their starts and ends."""
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    fresh = np.flatnonzero(np.concatenate(([True], s[1:] > e[:-1]))[: len(s)])
    return s[fresh], e[np.concatenate((fresh[1:], [len(s)]))[: len(fresh)] - 1]


def summed_cells(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct codes with the sums of their counts."""
    joined, each = np.concatenate(codes), np.concatenate(counts)
    order = np.argsort(joined, kind="stable")
    joined = joined[order]
    starts = np.flatnonzero(np.concatenate(([True], joined[1:] != joined[:-1]))) if len(joined) else np.empty(0, np.int64)
    return joined[starts], (np.add.reduceat(each[order], starts) if len(starts) else each[:0])


class Cells:
    """Codes with counts that are being summed, in sorted runs; these are merged when they have doubled, or grown by ``step``."""

    def __init__(self, step: int = 1 << 20):
        self.codes, self.counts, self.size, self.merged, self.step = [], [], 0, 0, step

    def add(self, codes: np.ndarray, counts: np.ndarray) -> None:
        self.codes.append(codes)
        self.counts.append(counts)
        self.size += len(codes)
        if self.size > 2 * self.merged + self.step:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.codes) > 1:
            codes, counts = summed_cells(self.codes, self.counts)
            self.codes, self.counts = [codes], [counts]
        if not self.codes:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        self.size = self.merged = len(self.codes[0])
        return self.codes[0], self.counts[0]


# --- batches ---


def limit_frames(spark: SparkSession) -> None:
    """Sets the session's Arrow frames to at most ``FRAME_ROWS`` rows and about ``FRAME_BYTES``, as texts are long."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > FRAME_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(FRAME_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(FRAME_BYTES))


def texts_as_bytes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id and the UTF-8 bytes of the text (null: empty); other columns, whatever their names, are left out."""
    limit_frames(docs.sparkSession)
    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).cast("binary").alias("data"),
    )


def partition_number() -> int:
    return TaskContext.get().partitionId()


def gather(frames: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    """(ids, texts) of a bounded number of bytes each."""
    ids, texts, size = [], [], 0
    for frame in frames:
        for i, data in zip(frame.column("doc_id").to_pylist(), frame.column("data").to_pylist()):
            ids.append(i)
            texts.append(data)
            size += len(data) + 64
            if size >= BATCH_BYTES:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def batches(
    docs: DataFrame, label: str, derive: Callable[[list, list[bytes]], dict[str, object]], schema: str = ""
) -> DataFrame:
    """Write ``docs`` as batches, each with the columns that ``derive(ids, texts)`` computes from it."""
    wanted = docs.sparkSession.createDataFrame([], BATCH_SCHEMA + (", " + schema if schema else "")).schema
    arrow = _arrow(wanted)

    def build(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number = partition_number() << PLACE_IN_PARTITION, 0
        for ids, texts in gather(frames):
            row = {"batch": base + number, "doc_ids": ids, "lens": [len(t) for t in texts]}
            row["blob"] = zstandard.ZstdCompressor(level=1).compress(b"".join(texts))
            row |= derive(ids, texts)
            yield batch_of({k: [v] for k, v in row.items()}, arrow)
            number += 1

    return save(texts_as_bytes(docs).mapInArrow(trimmed(build), wanted), label)


def _arrow(schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def arrow_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    return _arrow(spark.createDataFrame([], ddl).schema)


def texts_of(row: dict) -> list[bytes]:
    data = zstandard.ZstdDecompressor().decompress(row["blob"])
    ends = np.cumsum(row["lens"])
    return [data[e - n : e] for e, n in zip(ends.tolist(), row["lens"])]


def map_rows(df: DataFrame, build: Callable[[dict], Iterable[dict]], schema: str) -> DataFrame:
    """One call per (large) row; yields rows of ``schema``."""
    arrow = arrow_schema(df.sparkSession, schema)

    def run(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for i in range(frame.num_rows):
                row = {n: frame.column(n)[i].as_py() for n in frame.schema.names}
                columns: dict[str, list] = {f.name: [] for f in arrow}
                for out in build(row):
                    for n in columns:
                        columns[n].append(out[n])
                yield batch_of(columns, arrow)

    return df.mapInArrow(trimmed(run), schema)


# --- exchange ---


def packed_keys(row: dict) -> tuple[np.ndarray, np.ndarray]:
    return unpack(row["keys"], U64), unpack(row["payload"], np.int64)


def exchange(
    sent: DataFrame, label: str, how: str = "sum", prepare: Callable[[dict], tuple[np.ndarray, np.ndarray]] = packed_keys,
    reads: tuple[str, ...] = ("keys", "payload"),
) -> DataFrame:
    """Meet all batches' keys: (batch, answers) for ``sent``'s rows of (batch, keys, payload).

    ``keys`` packs distinct ascending 64-bit hashes, ``payload`` one 64-bit number for each. With ``sum`` the
    answer is the sum of the payloads of a key over all batches, at most 65,535 (unsigned 16 bit); with ``least``
    it is whether another batch has a smaller payload for the key (one byte). Answers come in the order of the
    keys, as one packed array for each bucket, buckets in ascending order: read them by ``answers``.

    ``prepare`` may derive keys and payload from other columns, ``reads``, in the same Python worker.
    """
    spark = sent.sparkSession
    bits = max(4, (2 * shuffle_partitions(spark) - 1).bit_length())
    split_schema = arrow_schema(spark, "bucket int, batch long, keys binary, payload binary")
    answer_schema = arrow_schema(spark, "batch long, bucket int, answer binary")

    def split(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for i in range(frame.num_rows):
                keys, payload = prepare({c: frame.column(c)[i].as_py() for c in reads})
                cuts = np.searchsorted(keys >> U64(64 - bits), np.arange(1 << bits, dtype=U64)).tolist() + [len(keys)]
                parts = [(b, x, y) for b, (x, y) in enumerate(zip(cuts, cuts[1:])) if y > x]
                yield batch_of(
                    {
                        "bucket": [p[0] for p in parts],
                        "batch": [frame.column("batch")[i].as_py()] * len(parts),
                        "keys": [keys[x:y].tobytes() for _, x, y in parts],
                        "payload": [pack(payload[x:y]) for _, x, y in parts],
                    },
                    split_schema,
                )

    def merge(group: pa.Table) -> pa.Table:
        keys = [np.frombuffer(k, U64) for k in group.column("keys").to_pylist()]
        payload = np.concatenate([unpack(p, np.int64) for p in group.column("payload").to_pylist()])
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        joined = np.concatenate(keys)
        order = np.argsort(joined, kind="stable")
        ranked = joined[order]
        starts = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
        sizes = np.diff(np.concatenate((starts, [len(ranked)])))
        if how == "sum":
            each = np.minimum(np.add.reduceat(payload[order], starts), 65_535).astype(np.uint16)
            answer = np.empty(len(joined), np.uint16)
            answer[order] = np.repeat(each, sizes)
        else:
            least = np.empty(len(joined), np.int64)
            least[order] = np.repeat(np.minimum.reduceat(payload[order], starts), sizes)
            answer = (least < payload).astype(np.uint8)
        return pa.table(
            {
                "batch": group.column("batch"),
                "bucket": group.column("bucket"),
                "answer": pa.array([pack(a) for a in np.split(answer, cuts)], pa.binary()),
            },
            schema=answer_schema,
        )

    parts = sent.select("batch", *reads).mapInArrow(trimmed(split), "bucket int, batch long, keys binary, payload binary")
    merged = parts.groupBy("bucket").applyInArrow(merge, "batch long, bucket int, answer binary")
    back = merged.groupBy("batch").agg(F.sort_array(F.collect_list(F.struct("bucket", "answer"))).alias("answers"))
    return save(back, label)


def answers(row: dict, how: str = "sum") -> np.ndarray:
    """The answers of a joined row, aligned with its keys."""
    kind = np.uint16 if how == "sum" else np.uint8
    found = [unpack(a["answer"], kind) for a in row["answers"] or []]
    return np.concatenate(found) if found else np.empty(0, kind)
