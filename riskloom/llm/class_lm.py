"""LM scoring: Brown class-based bigrams.

Every training word has a class: the ``CLASSED`` most frequent words each for itself, all others by their last bytes, as one of ``ENDINGS``
groups. Exchange clustering assigns these units to ``CLASSES`` classes: from the counts of neighbouring units over
all training texts, each unit moves to the class that raises the likelihood of the class bigrams most. Units decide
at the same time, half of them in each sweep, so that a sweep is one pass over the written bigram counts.
Then every other word seen at least ``TOLD`` times leaves its group for the class that its own neighbours make likeliest, in one pass
over the training texts; its class stands in the table of counts. Rarer words stay with their group.

    P(word | word before) = P(class | class before) * P(word | class)

Transitions are smoothed towards the classes' shares. Emissions are discounted by what a class's words seen once and
twice suggest; the discount goes to the class's unseen words, taken as one word. So every text has a probability.

The counts of all words are a table, never one machine's dictionary. The ``HOT`` most frequent words, a fixed number, are broadcast
with their counts; occurrences of the others meet their counts in a join, whose keys are rare by construction.
"""

from __future__ import annotations

import zlib
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import Cells, arrow_schema, batch_of, gather, mix, pack, partition_number, save, table, texts_as_bytes, trimmed, unpack

HOT = 1 << 18
CLASSED = 8192
ENDINGS = 2048
# Occurrences from which a word's neighbours tell its class.
TOLD = 5
CLASSES = 64
SWEEPS = 12
# Weight of the classes' shares in a transition.
PRIOR = 20.0
# Units whose bigram counts are one row.
BLOCK = 64
# Distinct words, and bigrams or neighbour counts, that a task holds before it hands them on; rows it sends at a time.
HELD_WORDS = 150_000
HELD_CELLS = 1 << 20
ROWS_AT_ONCE = 10_000
# Training tokens for each bucket of neighbour counts.
BUCKET_TOKENS = 1 << 20

# A key that no word can have, as words hold no white space.
END = b" "
UNITS = CLASSED + ENDINGS + 1
END_UNIT = UNITS - 1


def words_of(text: bytes) -> list[bytes]:
    """A-Z lower-cased, cut at 0x20 and 0x09-0x0D."""
    return text.lower().split()


def ending_unit(word: bytes) -> int:
    return CLASSED + zlib.crc32(word[-3:]) % ENDINGS


def tested_id(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def in_training(docs: DataFrame) -> DataFrame:
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    return texts_as_bytes(docs).where(~F.coalesce(held, F.lit(False)))


# --- counts ---


def word_counts(training: DataFrame) -> DataFrame:
    """(word, c) of all training tokens, the end of a text among them; written."""
    schema = arrow_schema(training.sparkSession, "word binary, c long")

    def rows(seen: Counter) -> Iterator[pa.RecordBatch]:
        found = iter(seen.items())
        while part := list(islice(found, ROWS_AT_ONCE)):
            yield batch_of({"word": [w for w, _ in part], "c": [c for _, c in part]}, schema)

    def count(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for _, texts in gather(frames):
            for t in texts:
                seen.update(words_of(t))
            seen[END] += len(texts)
            if len(seen) > HELD_WORDS:
                yield from rows(seen)
                seen = Counter()
        yield from rows(seen)

    return save(training.mapInArrow(trimmed(count), "word binary, c long").groupBy("word").agg(F.sum("c").alias("c")), "word-counts")


@dataclass
class Lexicon:
    """The most frequent words, most frequent first, and their counts."""

    words: list[bytes]
    counts: np.ndarray
    least: int  # every word at least as frequent is here

    def index(self) -> dict[bytes, int]:
        return {w: i for i, w in enumerate(self.words)}


def lexicon(counts: DataFrame, most: int) -> Lexicon:
    """At most ``most`` words: all of at least some frequency, read off a histogram of a few hundred steps."""
    step = F.floor(F.log2("c") * 32).cast("int")
    sizes = {r["step"]: (r["n"], r["least"]) for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("n"), F.min("c").alias("least")).collect()}
    total, least = 0, None
    for s in sorted(sizes, reverse=True):
        total += sizes[s][0]
        if total > most:
            break
        least = sizes[s][1]
    if least is None:
        return Lexicon([], np.empty(0, np.int64), 2**62)
    rows = counts.where((F.col("c") >= least) & (F.col("word") != F.lit(END))).collect()  # at most ``most``
    rows = sorted(((-r["c"], bytes(r["word"])) for r in rows))
    return Lexicon([w for _, w in rows], np.array([-c for c, _ in rows], np.int64), least)


def units_of(words: list[bytes], index: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """(place in the lexicon or -1, unit) of each word."""
    place = np.fromiter(map(index.get, words, repeat(-1)), np.int64, len(words))
    unit = place.copy()
    others = np.flatnonzero((place < 0) | (place >= CLASSED))
    endings = [words[i][-3:] for i in others.tolist()]
    unit[others] = CLASSED + np.fromiter(map(zlib.crc32, endings), np.int64, len(endings)) % ENDINGS
    return place, unit


def bigram_blocks(training: DataFrame, words: Lexicon) -> DataFrame:
    """A row for every ``BLOCK`` units: their neighbours' counts. A key is (unit, side, neighbour); side 0 follows, 1 precedes."""
    spark = training.sparkSession
    schema = arrow_schema(spark, "block int, keys binary, n binary")
    shared = spark.sparkContext.broadcast(words.words[:CLASSED])

    def rows(codes: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        before, after = codes // UNITS, codes % UNITS
        keys = np.concatenate((before * 2 * UNITS + after, (after * 2 + 1) * UNITS + before))
        order = np.argsort(keys)
        keys, n = keys[order], np.concatenate((n, n))[order]
        block = keys // (2 * UNITS * BLOCK)
        cuts = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1], [True]))) if len(keys) else np.zeros(1, np.int64)
        parts = list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
        return batch_of(
            {"block": [int(block[a]) for a, _ in parts], "keys": [pack(keys[a:b]) for a, b in parts], "n": [pack(n[a:b]) for a, b in parts]}, schema
        )

    def count(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = {w: i for i, w in enumerate(shared.value)}
        cells = Cells()
        for _, texts in gather(frames):
            flat, ends = [], []
            for t in texts:
                flat += words_of(t)
                ends.append(len(flat))
            unit = np.insert(units_of(flat, index)[1], ends, END_UNIT)
            unit = np.concatenate(([END_UNIT], unit))
            cells.add(*np.unique(unit[:-1] * UNITS + unit[1:], return_counts=True))
            if cells.merged > HELD_CELLS:
                yield rows(*cells.merge())
                cells = Cells()
        yield rows(*cells.merge())

    def merge(group: pa.Table) -> pa.Table:
        cells = Cells()
        for keys, n in zip(group.column("keys"), group.column("n")):
            cells.add(unpack(keys.as_py(), np.int64), unpack(n.as_py(), np.int64))
        keys, n = cells.merge()
        return pa.Table.from_batches([batch_of({"block": [group.column("block")[0].as_py()], "keys": [pack(keys)], "n": [pack(n)]}, schema)])

    names = "block int, keys binary, n binary"
    return save(training.mapInArrow(trimmed(count), names).groupBy("block").applyInArrow(merge, names), "bigrams")


# --- exchange clustering ---


def block_counts(row_block: int, keys: np.ndarray, n: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(counts by class after each unit, before it, and of the unit beside itself) for a block's units."""
    unit, side, other = keys // (2 * UNITS), keys // UNITS % 2, keys % UNITS
    local, width = unit - row_block * BLOCK, CLASSES + 1
    sums = np.bincount((local * 2 + side) * width + classes[other], n, BLOCK * 2 * width).reshape(BLOCK, 2, width)
    own = (unit == other) & (side == 0)
    itself = np.bincount(local[own], n[own], BLOCK)
    return sums[:, 0], sums[:, 1], itself


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-9))


def best_moves(pairs: np.ndarray, after: np.ndarray, before: np.ndarray, itself: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(class, gain in log likelihood) of the best move of each unit; ``at`` is its class now, ``pairs`` the class bigrams.

    The likelihood is the sum of x log x over class bigrams, less twice that over classes. A unit is taken out of its class, then tried
    in each; only rows and columns of the two classes change.
    """
    k = CLASSES
    target, gain = at.copy(), np.zeros(len(at))
    for u in range(len(at)):
        a, s = at[u], itself[u]
        f, p = after[u].copy(), before[u].copy()
        total = f.sum()
        if a == k or total + p.sum() == 0:  # the end of a text keeps its class
            continue
        f[a] -= s
        p[a] -= s
        m = pairs.copy()
        m[a] -= f
        m[:, a] -= p
        m[a, a] -= s
        f[:], p[:] = f, p
        # f and p now count the unit's other neighbours; those in its own class lose it too
        sums = m.sum(axis=1)
        x, y = f > 0, p > 0  # other columns and rows stay as they are
        rows, columns = m[:, x], m[y]
        change = (_xlogx(rows + f[x]) - _xlogx(rows)).sum(axis=1) + (_xlogx(columns + p[y, None]) - _xlogx(columns)).sum(axis=0)
        d = np.arange(k + 1)
        both = m[d, d]
        change += _xlogx(both + f + p + s) - _xlogx(both + f) - _xlogx(both + p) + _xlogx(both)
        change -= 2 * (_xlogx(sums + total) - _xlogx(sums))
        change = change[:k]
        b = int(change.argmax())
        target[u], gain[u] = b, change[b] - change[a]
    return target, gain


def _first_classes(totals: np.ndarray) -> np.ndarray:
    classes = np.empty(UNITS, np.int64)
    order = np.argsort(-totals[:END_UNIT], kind="stable")
    classes[order] = np.arange(END_UNIT) % CLASSES
    classes[END_UNIT] = CLASSES
    return classes


def cluster(blocks: DataFrame, sweeps: int = SWEEPS) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """(class of each unit, class bigrams, log likelihood of class bigrams after each sweep).

    The driver holds a number for each unit and a matrix of classes, whatever the corpus.
    """
    spark = blocks.sparkSession
    width = CLASSES + 1

    def per_block(build, ddl: str) -> list:
        schema = arrow_schema(spark, ddl)

        def run(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for frame in frames:
                for b, keys, n in zip(*(frame.column(c).to_pylist() for c in ("block", "keys", "n"))):
                    yield batch_of(build(b, unpack(keys, np.int64), unpack(n, np.int64)), schema)

        return blocks.mapInArrow(trimmed(run), ddl).collect()

    def totals(b: int, keys: np.ndarray, n: np.ndarray) -> dict:
        unit, side = keys // (2 * UNITS), keys // UNITS % 2
        each = np.bincount(unit - b * BLOCK, n * (side == 1), BLOCK)
        return {"block": [b], "data": [pack(each.astype(np.int64))]}

    sums = np.zeros(-(-UNITS // BLOCK) * BLOCK, np.int64)
    for r in per_block(totals, "block int, data binary"):
        sums[r["block"] * BLOCK : (r["block"] + 1) * BLOCK] = unpack(r["data"], np.int64)
    classes = _first_classes(sums[:UNITS])

    def class_bigrams(b: int, keys: np.ndarray, n: np.ndarray) -> dict:
        unit, side, other = keys // (2 * UNITS), keys // UNITS % 2, keys % UNITS
        use = side == 0
        m = np.bincount(classes[unit[use]] * width + classes[other[use]], n[use], width * width)
        return {"data": [pack(m.astype(np.int64))]}

    def moves(b: int, keys: np.ndarray, n: np.ndarray) -> dict:
        at = classes[b * BLOCK : (b + 1) * BLOCK]
        after, before, itself = (x[: len(at)] for x in block_counts(b, keys, n, classes))
        target, gain = best_moves(pairs, after, before, itself, at)
        return {"block": [b], "target": [pack(target)], "gain": [pack(gain)]}

    def counted() -> np.ndarray:
        found = [unpack(r["data"], np.int64) for r in per_block(class_bigrams, "data binary")]
        return (sum(found) if found else np.zeros(width * width, np.int64)).reshape(width, width).astype(float)

    pairs, likelihoods = counted(), []
    best = (-np.inf, classes, pairs)
    for sweep in range(sweeps):
        turn = mix(np.arange(UNITS, dtype=np.uint64) + np.uint64(sweep * 1_000_003)) % np.uint64(2) == 0
        turn[END_UNIT] = False
        fresh = classes.copy()
        for r in per_block(moves, "block int, target binary, gain binary"):
            here = np.arange(r["block"] * BLOCK, min((r["block"] + 1) * BLOCK, UNITS))
            move = turn[here] & (unpack(r["gain"], np.float64) > 1e-6)
            fresh[here[move]] = unpack(r["target"], np.int64)[move]
        done = bool((fresh == classes).all())
        classes = fresh
        pairs = counted()
        value = float(_xlogx(pairs).sum() - _xlogx(pairs.sum(axis=1)).sum() - _xlogx(pairs.sum(axis=0)).sum())
        likelihoods.append(value)
        if value > best[0]:
            best = (value, classes, pairs)
        if done:
            break
    return best[1], best[2], likelihoods


# --- the other words ---


# A word's neighbour counts are keyed by 55 bits of its hash and 8 for what is counted: the class after it, the class before it,
# itself after it, and the class its group has now.
WIDTH = CLASSES + 1
BEFORE, TWICE, NOW = WIDTH, 2 * WIDTH, 2 * WIDTH + 1
HASH_BITS, CODE_BITS = 55, 8


def word_hashes(words: list[bytes]) -> np.ndarray:
    found = np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(42)), np.uint64, len(words))
    return (found >> np.uint64(64 - HASH_BITS)).astype(np.int64)


def word_classes(training: DataFrame, counts: DataFrame, words: Lexicon, classes: np.ndarray, pairs: np.ndarray, tokens: int) -> DataFrame:
    """``counts`` with ``cls``, the class of a word that is no unit and was seen ``TOLD`` times, else null; written.

    A task sums what it sees beside its words as sorted codes, and sends them packed to buckets of hashes, whose number follows
    ``tokens``. Words that share a hash would share a class.
    """
    spark = training.sparkSession
    ddl, out_ddl = "bucket int, codes binary, n binary", "word_key long, cls int"
    schema, out_schema = arrow_schema(spark, ddl), arrow_schema(spark, out_ddl)
    bits = max(4, (tokens // BUCKET_TOKENS).bit_length())
    shared = spark.sparkContext.broadcast(words.words[:CLASSED])

    def rows(codes: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        bucket = codes >> (HASH_BITS + CODE_BITS - bits)
        starts = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist()
        parts = list(zip(starts, [*starts[1:], len(codes)]))
        return batch_of(
            {
                "bucket": bucket[starts].tolist(), "codes": [pack(np.diff(codes[a:b], prepend=0)) for a, b in parts],
                "n": [pack(n[a:b].astype(np.uint32)) for a, b in parts],
            }, schema,
        )

    def count(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = {w: i for i, w in enumerate(shared.value)}
        cells = Cells()
        for _, texts in gather(frames):
            flat, ends = [END], [0]
            for t in texts:
                flat += words_of(t)
                ends.append(len(flat))
                flat.append(END)
            place, unit = units_of(flat, units)
            place[ends] = unit[ends] = END_UNIT
            cls = classes[unit]
            at = np.flatnonzero(place < 0)
            own = word_hashes([flat[i] for i in at.tolist()])
            number = np.full(len(flat), -1)
            number[at] = own
            twice = own[number[at + 1] == own]
            own <<= CODE_BITS
            seen = np.concatenate((own | cls[at + 1], own | (BEFORE + cls[at - 1]), twice << CODE_BITS | TWICE, own | (NOW + cls[at])))
            cells.add(*np.unique(seen, return_counts=True))
            if cells.merged > HELD_CELLS:
                yield rows(*cells.merge())
                cells = Cells()
        yield rows(*cells.merge())

    def assign(group: pa.Table) -> pa.Table:
        cells = Cells()
        for codes, n in zip(group.column("codes"), group.column("n")):
            cells.add(np.cumsum(unpack(codes.as_py(), np.int64)), unpack(n.as_py(), np.uint32).astype(np.int64))
        codes, n = cells.merge()
        keys, own = np.unique(codes >> CODE_BITS, return_inverse=True)
        code = codes & ((1 << CODE_BITS) - 1)
        now = code >= NOW
        at, seen = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        at[own[now]], seen[own[now]] = code[now] - NOW, n[now]
        kept = np.flatnonzero(seen >= TOLD)
        target = []
        for some in np.array_split(kept, -(-len(kept) // ROWS_AT_ONCE) or 1):
            number = np.full(len(keys), -1)
            number[some] = np.arange(len(some))
            use = (number[own] >= 0) & ~now
            sums = np.bincount(number[own[use]] * NOW + code[use], n[use], len(some) * NOW).reshape(len(some), NOW)
            target.append(best_moves(pairs, sums[:, :BEFORE], sums[:, BEFORE:TWICE], sums[:, TWICE], at[some])[0])
        return pa.Table.from_batches([batch_of({"word_key": keys[kept], "cls": np.concatenate(target)}, out_schema)])

    found = training.mapInArrow(trimmed(count), ddl).groupBy("bucket").applyInArrow(assign, out_ddl)
    keyed = counts.withColumn("word_key", F.shiftrightunsigned(F.xxhash64("word"), 64 - HASH_BITS))
    return save(keyed.join(found, "word_key", "left").drop("word_key"), "word-classes")


# --- model ---


@dataclass
class ClassModel:
    words: Lexicon
    classes: np.ndarray  # of each unit
    own_classes: np.ndarray  # of each word of the lexicon
    transitions: np.ndarray  # log10, from row to column
    sizes: np.ndarray  # tokens of each class
    discounts: np.ndarray
    unseen: np.ndarray  # log10 probability of a class's unseen words
    tokens: int
    types: int
    end_count: int


def class_sizes(counts: DataFrame, words: Lexicon, classes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Tokens, types, and types seen once and twice of every class."""
    spark = counts.sparkSession
    schema = arrow_schema(spark, "c int, tokens long, types long, once long, twice long")
    shared = spark.sparkContext.broadcast(words.words[:CLASSED])

    def total(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = {w: i for i, w in enumerate(shared.value)}
        index[END] = END_UNIT
        sums = np.zeros((CLASSES + 1, 4), np.int64)
        for frame in frames:
            c = frame.column("c").to_numpy()
            unit = np.array([index[w] if w in index else ending_unit(w) for w in frame.column("word").to_pylist()], np.int64)
            told = frame.column("cls").to_numpy()
            cls = np.where(told >= 0, told, classes[unit])
            for i, weight in enumerate((c, np.ones(len(c)), c == 1, c == 2)):
                sums[:, i] += np.bincount(cls, weight, CLASSES + 1).astype(np.int64)
        rows = np.arange(CLASSES + 1).tolist()
        yield batch_of({"c": rows} | {n: sums[:, i].tolist() for i, n in enumerate(("tokens", "types", "once", "twice"))}, schema)

    parts = counts.select("word", "c", F.coalesce("cls", F.lit(-1)).alias("cls")).mapInArrow(trimmed(total), "c int, tokens long, types long, once long, twice long")
    out = np.zeros((4, CLASSES + 1), np.int64)
    for r in parts.groupBy("c").agg(*[F.sum(n).alias(n) for n in ("tokens", "types", "once", "twice")]).collect():
        out[:, r["c"]] = r["tokens"], r["types"], r["once"], r["twice"]
    return tuple(out)


def train(training: DataFrame, sweeps: int = SWEEPS) -> tuple[ClassModel, DataFrame]:
    """(model, word counts and classes) from (doc_id, data) rows."""
    model, counts = fit_classes(training, sweeps)
    return with_transitions(model, in_classes(training, model, counts)), counts


def fit_classes(training: DataFrame, sweeps: int = SWEEPS) -> tuple[ClassModel, DataFrame]:
    """As ``train``, but without transitions: these are counted in texts whose words have their classes."""
    counts = word_counts(training)
    total = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v"), F.sum(F.when(F.col("word") == F.lit(END), F.col("c"))).alias("ends")).first()
    words = lexicon(counts, HOT)
    classes, pairs, _ = cluster(bigram_blocks(training, words), sweeps)
    counts = word_classes(training, counts, words, classes, pairs, total["n"] or 0)
    told = {bytes(r["word"]): r["cls"] for r in counts.where((F.col("c") >= words.least) & F.col("cls").isNotNull()).select("word", "cls").collect()}  # at most ``HOT``
    own = np.array([told.get(w, classes[i if i < CLASSED else ending_unit(w)]) for i, w in enumerate(words.words)], np.int64)
    tokens, types, once, twice = class_sizes(counts, words, classes)
    # share of a word's count that is kept for unseen words; a class without words has nothing else
    discounts = np.where(once > 0, once / np.maximum(once + 2 * twice, 1), 0.5)
    discounts = np.clip(discounts, 0.05, 0.95)
    discounts[CLASSES] = 0.0  # there is one end only
    with np.errstate(divide="ignore"):
        unseen = np.where(tokens > 0, np.log10(discounts * types / np.maximum(tokens, 1)), 0.0)
    model = ClassModel(words, classes, own, np.zeros_like(pairs), tokens, discounts, unseen, total["n"] or 0, total["v"], total["ends"] or 0)
    return model, counts


def with_transitions(model: ClassModel, texts: DataFrame) -> ClassModel:
    """The model with the transitions of the training rows of ``in_classes``: counted anew, as words have left their groups."""
    pairs = class_bigrams(texts)
    share = (model.sizes + 1) / (model.sizes.sum() + CLASSES + 1)
    model.transitions = np.log10((pairs + PRIOR * share) / (pairs.sum(axis=1, keepdims=True) + PRIOR))
    return model


# --- scoring ---

_LINES = "word binary, row long, doc_id long, held_out boolean, tf long, class int, n_tokens long, known long, base double, score double, classes binary, places binary"
_TEXTS = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, classes binary"


def in_classes(source: DataFrame, model: ClassModel, counts: DataFrame) -> DataFrame:
    """A row for each of (doc_id, data): the columns of ``score``, which here has the emissions only, and the packed classes
    of the text's words, with an end on both sides."""
    spark = source.sparkSession
    schema, out_schema = arrow_schema(spark, _LINES), arrow_schema(spark, _TEXTS)
    shared = spark.sparkContext.broadcast(model)  # at most ``HOT`` words, and matrices of classes
    scale = model.tokens + 0.5 * (model.types + 1)
    base_of = lambda c: np.log10((c + 0.5) / scale)

    def lines(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        index = m.words.index()
        cls = m.own_classes
        base = base_of(m.words.counts)
        emission = np.log10((m.words.counts - m.discounts[cls]) / np.maximum(m.sizes[cls], 1))
        end_base = base_of(m.end_count)
        row = partition_number() << 40
        for ids, texts in gather(frames):
            lines, rare = [], []  # a line for each text, and for each of its words beyond the lexicon
            for doc_id, text in zip(ids, texts):
                words = words_of(text)
                place = np.fromiter(map(index.get, words, repeat(-1)), np.int64, len(words))
                hot = place[place >= 0]
                classes = np.empty(len(words) + 2, np.uint8)
                classes[0] = classes[-1] = CLASSES
                classes[1:-1] = cls[place] if len(cls) else 0
                beyond: dict[bytes, list[int]] = {}
                for i in np.flatnonzero(place < 0).tolist():
                    beyond.setdefault(words[i], []).append(i + 1)
                for w, at in beyond.items():
                    group = int(m.classes[ending_unit(w)])
                    classes[at] = group
                    rare.append((w, row, len(at), group, array("i", at).tobytes()))
                lines.append(
                    (END + row.to_bytes(8, "big"), row, doc_id, tested_id(doc_id), len(words) + 1, len(hot) + (m.end_count > 0),
                     float(base[hot].sum() + end_base), float(emission[hot].sum()), pack(classes))
                )
                row += 1
            n, none = len(lines), [None] * len(rare)
            word, number, doc, held, size, known, based, score, packed = (list(c) for c in zip(*lines))
            other, of_row, tf, group, at = (list(c) for c in zip(*rare)) if rare else ([], [], [], [], [])
            nothing = [0] * len(rare)
            yield batch_of(
                {
                    "word": word + other, "row": number + of_row, "doc_id": doc + none, "held_out": held + none, "tf": [0] * n + tf,
                    "class": [0] * n + group, "n_tokens": size + nothing, "known": known + nothing, "base": based + nothing,
                    "score": score + nothing, "classes": packed + none, "places": [None] * n + at,
                }, schema,
            )

    def placed(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            classes = []
            for data, told in zip(frame.column("classes").to_pylist(), frame.column("told").to_pylist()):
                own = unpack(data, np.uint8).copy()
                for t in told:
                    own[np.frombuffer(t["places"], np.int32)] = t["cls"]
                classes.append(pack(own))
            kept = [frame.column(f.name) for f in out_schema if f.name != "classes"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(classes, pa.binary())], schema=out_schema)

    rare = counts.where(F.col("c") < model.words.least).withColumnRenamed("word", "known_word")
    met = source.mapInArrow(trimmed(lines), _LINES).join(rare, F.col("word") == F.col("known_word"), "left")
    number = lambda values: F.element_at(F.array(*[F.lit(float(x)) for x in values]), F.coalesce("cls", "class") + 1)
    emitted = F.when(F.col("c").isNull(), number(model.unseen)).otherwise(F.log10((F.col("c") - number(model.discounts)) / number(np.maximum(model.sizes, 1))))
    base = F.log10((F.coalesce("c", F.lit(0)) + 0.5) / scale)
    sums = met.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.col("known") + F.when(F.col("c").isNotNull(), F.col("tf")).otherwise(0)).alias("n_known"),
        F.sum(F.col("base") + F.when(F.col("tf") > 0, F.col("tf") * base).otherwise(0.0)).alias("base_score"),
        F.sum(F.col("score") + F.when(F.col("tf") > 0, F.col("tf") * emitted).otherwise(0.0)).alias("score"),
        F.first("classes", ignorenulls=True).alias("classes"),
        F.collect_list(F.when(F.col("cls").isNotNull(), F.struct("cls", "places"))).alias("told"),
    )
    return sums.drop("row").mapInArrow(trimmed(placed), _TEXTS)


def class_bigrams(texts: DataFrame) -> np.ndarray:
    """Counts of classes beside each other in the rows of ``in_classes``."""
    width = CLASSES + 1

    def count(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(width * width, np.int64)
        for frame in frames:
            for data in frame.column("classes").to_pylist():
                own = unpack(data, np.uint8).astype(np.int64)
                sums += np.bincount(own[:-1] * width + own[1:], minlength=width * width)
        there = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(sums[there])], names=["pair", "n"])

    out = np.zeros(width * width)
    for r in texts.select("classes").mapInArrow(trimmed(count), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        out[r["pair"]] = r["n"]
    return out.reshape(width, width)


def score(docs: DataFrame, model: ClassModel, counts: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    A null or empty text is its end alone. Rows that repeat a doc_id are scored each for itself; a row without one is
    not held out. Without training texts every token is unseen.
    """
    return with_class_score(in_classes(texts_as_bytes(docs), model, counts), model)


def with_class_score(texts: DataFrame, model: ClassModel) -> DataFrame:
    """The rows of ``in_classes`` with the transitions of their classes in the score."""
    shared = texts.sparkSession.sparkContext.broadcast(model.transitions)
    ddl = _TEXTS.removesuffix(", classes binary")
    at = ddl.split(", ").index("score double")

    def add(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            total = []
            for emitted, data in zip(frame.column("score").to_pylist(), frame.column("classes").to_pylist()):
                own = unpack(data, np.uint8)
                total.append(emitted + float(shared.value[own[:-1], own[1:]].sum()))
            yield frame.set_column(at, "score", pa.array(total, pa.float64())).drop_columns(["classes"])

    scored = texts.mapInArrow(trimmed(add), ddl)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model, counts = fit_classes(in_training(docs))
    # All texts meet their words' counts and classes once: the training ones among them tell the transitions.
    texts = save(in_classes(texts_as_bytes(docs), model, counts), "texts-in-classes")
    return with_class_score(texts, with_transitions(model, texts.where("not held_out")))
