"""Benchmark decontamination: latent semantic retrieval, then word order and the answer.

The features are the words of the benchmark, weighted by their inverse document frequency over all documents. Words outside of it
weigh as much as the items' own do on average, so that no weight grows with the number of documents alone. A
randomised SVD, by subspace iteration, finds the latent space of the TF-IDF vectors of the benchmark's items and of all passages of
all documents: these enter by the products of every two words' columns, summed over all rows in one pass and kept in slices.
Items count together as much as the passages, so that the space keeps their differences. Items of which the space holds too little, as there are more of them than
dimensions, add their own vectors to it until every item keeps ``KEPT`` of its length.

Every document is read as overlapping passages of several lengths. A passage with too little of its weight on words of
the benchmark cannot be near any item and is not embedded. Of the others, those whose cosine to an item reaches
``COSINE`` are candidates. A candidate is a leak if the longest common subsequence of words covers most of the item, or
half of it and the answer, which is the item's last sentence.

The benchmark is met in blocks of items; all rows are searched for each block.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import (
    U64, Words, arrow_schema, batch_of, gather, pack, save, table, texts_as_bytes, trimmed, unpack,
)

BLOCK_ITEMS = 1000
RANK = 256
# Least length of every item's normed vector inside the space; for this the space grows beyond ``RANK``, by a dimension an item at most.
KEPT = 0.95
EXTRA = 16
ROUNDS = 3
# Words of a passage that takes part in the fit.
FIT_WORDS = 40
# Products of two words' columns that a task sums at a time, and that a slice of the sums holds, about; and pairs made at a time.
BAND_CELLS = 1 << 24
SLICE_CELLS = 1 << 16
PAIRS_AT_ONCE = 1 << 20
COSINE = 0.4
# Least share of a passage's squared length on the benchmark's words: a cosine's square is not above it.
MASS = COSINE * COSINE
MOST = 0.8
# A word in a smaller share of the documents weighs as one in this share.
RARE = 1e-3
HALF = 0.5
ANSWER = 0.8
# Passages that are embedded at a time.
TOGETHER = 128
# Passages' lengths grow by this factor; neighbours overlap by three quarters.
GROWTH = 1.5


def separators() -> np.ndarray:
    """Bytes between words: everything in ASCII but letters and digits."""
    return np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


_BETWEEN = separators()
_SENTENCE_ENDS = b".!?:\n"


def words_of(texts: list[bytes]) -> Words:
    return Words(texts, lower=True, between=_BETWEEN)


def answer_start(text: bytes) -> int:
    """Byte at which the last sentence that has a word begins; 0 if there is only one."""
    last = max((i for i in range(256) if not _BETWEEN[i]), key=lambda b: text.rfind(bytes([b])))
    end = text.rfind(bytes([last]))
    return 1 + max(text.rfind(bytes([c]), 0, max(0, end)) for c in _SENTENCE_ENDS)


@dataclass
class Items:
    """A block of benchmark items: their words, and how many of the last ones are the answer."""

    ids: list
    words: list[np.ndarray]
    answers: list[int]
    terms: np.ndarray  # distinct word hashes, ascending

    @staticmethod
    def of(rows: list[tuple]) -> Items:
        rows = [(i, (t or "").encode()) for i, t in rows]
        found = words_of([t for _, t in rows])
        words = [found.hashes[a : a + n] for a, n in zip(found.starts.tolist(), found.counts.tolist())]
        kept = [k for k, w in enumerate(words) if len(w)]
        tails = words_of([rows[k][1][answer_start(rows[k][1]) :] for k in kept]).counts.tolist() if kept else []
        terms = np.unique(np.concatenate([words[k] for k in kept])) if kept else np.empty(0, U64)
        return Items([rows[k][0] for k in kept], [words[k] for k in kept], tails, terms)

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """Number of the term of each word, or -1."""
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, at, -1)


# --- fit ---


def _vector_rows(slots: list[np.ndarray], weights: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normed TF-IDF rows as (row, term, value)."""
    row, term, value = [], [], []
    for i, s in enumerate(slots):
        t, n = np.unique(s[s >= 0], return_counts=True)
        v = n * weights[t]
        norm = np.sqrt((v * v).sum())
        if norm > 0:
            row.append(np.full(len(t), i))
            term.append(t)
            value.append(v / norm * scale[i])
    if not row:
        return np.empty(0, int), np.empty(0, int), np.empty(0)
    return np.concatenate(row), np.concatenate(term), np.concatenate(value)


def _product(rows: tuple, n_rows: int, q: np.ndarray) -> np.ndarray:
    """transpose(A) (A q) for sparse rows A."""
    row, term, value = rows
    y = np.zeros((n_rows, q.shape[1]))
    np.add.at(y, row, value[:, None] * q[term])
    out = np.zeros_like(q)
    np.add.at(out, term, value[:, None] * y[row])
    return out


@dataclass
class Space:
    items: Items
    weights: np.ndarray  # inverse document frequency of each term
    foreign: float  # weight of a word that is no term
    near: np.ndarray  # terms x items: each term's part in the product with an item's normed latent vector


def fit(source: DataFrame, items: Items) -> Space:
    """``source``: (doc_id, data). Document frequencies and the SVD's passages cover all rows."""
    spark = source.sparkSession
    shared = spark.sparkContext.broadcast(items)
    total = source.count()
    ddl = "term int, df long, passages binary, sizes binary"
    schema = arrow_schema(spark, ddl)

    def read(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        df = np.zeros(len(own.terms), np.int64)
        for _, texts in gather(frames):
            words = words_of(texts)
            slots = own.slots(words.hashes)
            known = np.flatnonzero(slots >= 0)
            code = np.unique(words.doc[known] * len(own.terms) + slots[known])
            df += np.bincount(code % len(own.terms), minlength=len(own.terms))
            # a document's passages follow one another; of each, the number of known words, and these
            passages = -(-words.counts // FIT_WORDS)
            doc = words.doc[known]
            passage = (np.cumsum(passages) - passages)[doc] + (known - words.starts[doc]) // FIT_WORDS
            sizes = np.bincount(passage, minlength=int(passages.sum()))
            if len(sizes):
                yield batch_of({"term": [-1], "df": [0], "passages": [pack(slots[known].astype(_kind(len(own.terms))))], "sizes": [pack(sizes.astype(np.uint8))]}, schema)
        there = np.flatnonzero(df)
        yield batch_of({"term": there.tolist(), "df": df[there].tolist(), "passages": [None] * len(there), "sizes": [None] * len(there)}, schema)

    seen = save(source.mapInArrow(trimmed(read), ddl), "terms")
    df = np.zeros(len(items.terms))
    for r in seen.where("term >= 0").groupBy("term").agg(F.sum("df").alias("df")).collect():  # a row for each word of the block
        df[r["term"]] = r["df"]
    weights, foreign = term_weights(df, total, [items.slots(w) for w in items.words])
    passages = seen.where("term < 0").select("passages", "sizes")
    return Space(items, weights, foreign, _near(_svd(passages, items, weights), items, weights))


def term_weights(df: np.ndarray, total: int, slots: list[np.ndarray]) -> tuple[np.ndarray, float]:
    """(weight of each term, weight of a word that is no term); both depend on the terms' shares of the documents only.

    A word put in the place of an item's word is expected to weigh what that did: the root of the mean square over the items' words.
    """
    weights = np.clip(-np.log((df + 0.5) / (total + 1)), 1e-3, -np.log(RARE))
    return weights, float(np.sqrt((weights[np.concatenate(slots)] ** 2).mean()))


def _kind(n_terms: int) -> type:
    return np.uint16 if n_terms <= 1 << 16 else np.int32


def _row_starts(n: int) -> np.ndarray:
    """Where each row begins in the upper triangle, with its diagonal, of an n x n matrix; and its end."""
    rows = np.arange(n + 1)
    return rows * n - rows * (rows - 1) // 2


def _cut_rows(starts: np.ndarray, cells: int) -> list[tuple[int, int]]:
    """Runs of rows of about ``cells`` cells."""
    wanted = np.searchsorted(starts, np.arange(0, starts[-1], cells))
    cuts = np.unique(np.concatenate((wanted, [len(starts) - 1]))).tolist()
    return list(zip(cuts, cuts[1:]))


def _add_products(band: np.ndarray, rows: tuple[int, int], starts: np.ndarray, sizes: np.ndarray, slots: np.ndarray, weights: np.ndarray) -> None:
    """Add the products of every two terms' columns of the passages' normed rows; of those in ``rows``, the upper triangle."""
    n_terms = len(weights)
    code, times = np.unique(np.repeat(np.arange(len(sizes)), sizes) * n_terms + slots, return_counts=True)
    passage, term = code // n_terms, code % n_terms
    value = times * weights[term]
    value /= np.sqrt(np.bincount(passage, value * value, len(sizes)))[passage]
    held = np.bincount(passage, minlength=len(sizes))
    ends = np.cumsum(held)[passage]
    first = np.flatnonzero((term >= rows[0]) & (term < rows[1]))
    each = ends[first] - first  # terms ascend within a passage
    cell = starts[term[first]] - starts[rows[0]] - term[first]
    upto = np.cumsum(each)
    cuts = np.searchsorted(upto, np.arange(PAIRS_AT_ONCE, upto[-1], PAIRS_AT_ONCE)).tolist() if len(upto) else []
    for x, y in zip([0, *cuts], [*cuts, len(first)]):
        n = each[x:y]
        other = np.arange(n.sum()) + np.repeat(first[x:y] - np.cumsum(n) + n, n)
        np.add.at(band, np.repeat(cell[x:y], n) + term[other], np.repeat(value[first[x:y]], n) * value[other])


def _products(passages: DataFrame, weights: np.ndarray) -> DataFrame:
    """(first, data): the upper triangle of transpose(A) A for the passages' rows A, in slices of whole rows, written.

    The terms stand in order of their weight, so that the cells of frequent ones lie together.
    """
    spark = passages.sparkSession
    n_terms = len(weights)
    starts = _row_starts(n_terms)
    order = np.argsort(weights, kind="stable")
    shared = spark.sparkContext.broadcast((weights[order], np.argsort(order), starts))
    ddl = "first int, data binary"
    schema = arrow_schema(spark, ddl)
    # a task that has met some text sends every slice once: few tasks, whatever the input
    few = passages.coalesce(2 * spark.sparkContext.defaultParallelism)
    parts = None
    for rows in _cut_rows(starts, BAND_CELLS):

        def sums(frames: Iterable[pa.RecordBatch], rows=rows) -> Iterator[pa.RecordBatch]:
            weights, place, starts = shared.value
            base = starts[rows[0]]
            band = np.zeros(starts[rows[1]] - base)
            for frame in frames:
                for slots, sizes in zip(frame.column("passages").to_pylist(), frame.column("sizes").to_pylist()):
                    _add_products(band, rows, starts, unpack(sizes, np.uint8), place[unpack(slots, _kind(len(weights)))], weights)
            for a, b in _cut_rows(starts[rows[0] : rows[1] + 1] - base, SLICE_CELLS):
                part = band[starts[rows[0] + a] - base : starts[rows[0] + b] - base]
                if part.any():
                    yield batch_of({"first": [rows[0] + a], "data": [pack(part)]}, schema)

        found = few.mapInArrow(trimmed(sums), ddl)
        parts = found if parts is None else parts.unionByName(found)

    def add(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, total = None, None
        for frame in frames:
            for here, data in zip(frame.column("first").to_pylist(), frame.column("data").to_pylist()):
                if first is not None and here != first:
                    yield batch_of({"first": [first], "data": [pack(total)]}, schema)
                    total = None
                part = unpack(data, np.float64)
                first, total = here, part.copy() if total is None else total + part
        if first is not None:
            yield batch_of({"first": [first], "data": [pack(total)]}, schema)

    return save(parts.repartition("first").sortWithinPartitions("first").mapInArrow(trimmed(add), ddl), "term-products")


def _svd(passages: DataFrame, items: Items, weights: np.ndarray) -> np.ndarray:
    """Orthonormal basis, terms x rank: randomised subspace iteration; the driver holds as many numbers."""
    spark = passages.sparkSession
    n_terms, n_items = len(weights), len(items.ids)
    width = min(n_terms, RANK + EXTRA)
    rng = np.random.default_rng(7)
    q = np.linalg.qr(rng.standard_normal((n_terms, width)))[0]
    slots = [items.slots(w) for w in items.words]
    n_passages = _passages(passages)
    own = _vector_rows(slots, weights, np.full(n_items, np.sqrt(max(1.0, n_passages / max(1, n_items)))))
    schema = arrow_schema(spark, "slice int, data binary")
    step = 512
    ddl = "slice int, data binary"
    order = np.argsort(weights, kind="stable")
    # a task sends a row of sums for each term, whatever it has read: so few that together they send no more numbers than they read
    few = min(2 * spark.sparkContext.defaultParallelism, -(-n_terms // (2 * width)))
    products = _products(passages, weights).coalesce(max(1, few))

    def times(q: np.ndarray) -> np.ndarray:
        shared = spark.sparkContext.broadcast(q[order])

        def multiplied(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            basis = shared.value
            n = len(basis)
            starts = _row_starts(n)
            out = np.zeros_like(basis)
            for frame in frames:
                for first, data in zip(frame.column("first").to_pylist(), frame.column("data").to_pylist()):
                    cells = unpack(data, np.float64)
                    last = int(np.searchsorted(starts, starts[first] + len(cells)))
                    block = np.zeros((last - first, n - first))
                    for r in range(first, last):
                        block[r - first, r - first :] = cells[starts[r] - starts[first] : starts[r + 1] - starts[first]]
                    out[first:last] += block @ basis[first:]
                    block[np.arange(last - first), np.arange(last - first)] = 0.0  # the other triangle has no diagonal
                    out[first:] += block.T @ basis[first:last]
            slices = range(0, n, step)
            yield batch_of({"slice": [a // step for a in slices], "data": [pack(out[a : a + step]) for a in slices]}, schema)

        def add(group: pa.Table) -> pa.Table:
            total = sum(unpack(d, np.float64) for d in group.column("data").to_pylist())
            return pa.Table.from_batches([batch_of({"slice": [group.column("slice")[0].as_py()], "data": [pack(total)]}, schema)])

        out = _product(own, n_items, q)
        for r in products.mapInArrow(multiplied, ddl).groupBy("slice").applyInArrow(add, ddl).collect():
            out[order[r["slice"] * step : (r["slice"] + 1) * step]] += unpack(r["data"], np.float64).reshape(-1, q.shape[1])
        return out

    for _ in range(ROUNDS):
        q = np.linalg.qr(times(q))[0]
    small = q.T @ times(q)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    keep = np.argsort(-values)[: min(RANK, width)]
    return q @ vectors[:, keep]


def _near(basis: np.ndarray, items: Items, weights: np.ndarray) -> np.ndarray:
    """Terms x items: the items' vectors inside the basis, which is first completed, normed.

    The item of which least is inside adds the rest of its vector, until ``KEPT`` of every item is (a pivoted Cholesky
    decomposition of the rests' products, which ends before a pivot gets small).
    """
    n = len(items.ids)
    own = np.zeros((n, len(weights)), np.float32)
    row, term, value = _vector_rows([items.slots(w) for w in items.words], weights, np.ones(n))
    own[row, term] = value
    basis = basis.astype(np.float32)
    inside = own @ basis
    rests = (own @ own.T - inside @ inside.T).astype(np.float64)
    left = rests.diagonal().copy()
    factor = np.zeros((n, n))
    pivots: list[int] = []
    while len(pivots) < n and left.max() > 1 - KEPT**2:
        k, i = len(pivots), int(left.argmax())
        factor[:, k] = (rests[:, i] - factor[:, :k] @ factor[i, :k]) / np.sqrt(left[i])
        left = np.maximum(left - factor[:, k] ** 2, 0.0)
        left[i] = 0.0
        pivots.append(i)
    # the new directions are the pivots' rests times the inverse of their factor; an item's coordinate in them is its row of the factor
    factor = factor[:, : len(pivots)]
    mixed = np.linalg.solve(factor[pivots].T, factor.T).T.astype(np.float32) if pivots else np.zeros((n, 0), np.float32)
    latent = (inside - mixed @ inside[pivots]) @ basis.T + mixed @ own[pivots]
    length = np.sqrt(np.maximum((inside.astype(np.float64) ** 2).sum(axis=1) + (factor**2).sum(axis=1), 1e-18))
    return np.ascontiguousarray(latent.T / length.astype(np.float32))


def _passages(passages: DataFrame) -> int:
    def count(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = sum(len(unpack(s, np.uint8)) for frame in frames for s in frame.column("sizes").to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    return passages.mapInArrow(count, "n long").agg(F.sum("n")).first()[0] or 0


# --- search ---


def common_subsequence(item: np.ndarray, region: np.ndarray) -> int:
    """Length of the longest common subsequence of two word sequences, bit-parallel over the item."""
    places: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        places[w] = places.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    v = full
    for w in region.tolist():
        m = places.get(w)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(item) - v.bit_count()


class Search:
    """Leaks of texts to the items of a block."""

    def __init__(self, space: Space):
        self.space = space
        self.weights = space.weights.astype(np.float32)
        # most that one occurrence of a term adds to the product with any item
        self.most = space.weights * np.maximum(space.near.max(axis=1), 0.0)
        lengths = sorted(len(w) for w in space.items.words)
        self.scales = []
        size = max(2, lengths[0])
        while True:
            self.scales.append(size)
            if size >= lengths[-1]:
                break
            size = min(int(size * GROWTH) + 1, max(lengths[-1], size + 1))

    def candidates(self, words: Words, slots: np.ndarray) -> Iterator[tuple[int, int, int, int, float]]:
        """(doc, first word, words, item, cosine) of passages near an item."""
        s = self.space
        weight = np.where(slots >= 0, s.weights[slots], s.foreign).astype(np.float64)
        squares = np.concatenate(([0.0], np.cumsum(weight**2)))
        known = np.concatenate(([0.0], np.cumsum(np.where(slots >= 0, weight**2, 0.0))))
        reach = np.concatenate(([0.0], np.cumsum(np.where(slots >= 0, self.most[slots], 0.0))))
        # A word that a passage holds n times adds (n w)^2 to its squared length: n w^2 for each time. n is at most the
        # document's number of it, and the passage's size.
        here = np.flatnonzero(slots >= 0)
        _, which, times = np.unique(words.doc[here] * len(s.weights) + slots[here], return_inverse=True, return_counts=True)
        own, times = weight[here] ** 2, times[which]
        repeated = np.zeros(len(slots) + 1)
        for size in self.scales:
            repeated[here + 1] = own * np.minimum(times, size)
            most_inside = np.cumsum(repeated)
            stride = max(1, size // 4)
            n = np.maximum(words.counts - size, 0) // stride + 1
            n[words.counts == 0] = 0
            # the passages of a document: every stride, and its last words
            first = np.repeat(words.starts, n) + stride * (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
            tail = (np.maximum(words.ends - size, words.starts))[words.counts > 0]
            first = np.union1d(first, tail)
            last = np.minimum(first + size, words.ends[words.doc[first]])
            mass, inside = squares[last] - squares[first], known[last] - known[first]
            # neither can a cosine be above the terms' most over the least norm
            enough = most_inside[last] - most_inside[first] >= 0.999 * MASS / (1 - MASS) * (mass - inside)
            near = np.flatnonzero(enough & (reach[last] - reach[first] >= 0.999 * COSINE * np.sqrt(mass)))
            for at in range(0, len(near), TOGETHER):
                part = near[at : at + TOGETHER]
                a, b = first[part], last[part]
                values, terms = self._vectors(slots, a, b)
                # the norm of the whole passage, with words the space does not know
                norm = np.sqrt(np.einsum("ij,ij->i", values, values) + mass[part] - inside[part])
                cosine = values @ s.near[terms] / np.maximum(norm, 1e-9)[:, None].astype(np.float32)
                if cosine.max() < COSINE:
                    continue
                for i, item in zip(*np.nonzero(cosine >= COSINE)):
                    yield int(words.doc[a[i]]), int(a[i]), int(b[i] - a[i]), int(item), float(cosine[i, item])

    def _vectors(self, slots: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(passages x terms, the terms): neighbours share most of their words, so the distinct ones are few."""
        size = b - a
        row = np.repeat(np.arange(len(a)), size)
        term = slots[np.arange(size.sum()) + np.repeat(a - np.cumsum(size) + size, size)]
        row, term = row[term >= 0], term[term >= 0]
        there = np.zeros(len(self.weights), bool)
        there[term] = True
        terms = np.flatnonzero(there)
        column = (np.cumsum(there) - 1)[term]
        counts = np.bincount(row * len(terms) + column, minlength=len(a) * len(terms)).reshape(len(a), len(terms))
        return counts.astype(np.float32) * self.weights[terms], terms

    def leaks(self, texts: list[bytes]) -> list[list[dict]]:
        """For each text its leaked items: item, cosine, share of the item's words in order, whether the answer is there."""
        words = words_of(texts)
        out: list[list[dict]] = [[] for _ in texts]
        if not len(words.hashes):
            return out
        items = self.space.items
        best: dict[tuple[int, int], dict] = {}
        checked: set[tuple[int, int, int]] = set()
        for doc, first, size, item, cosine in self.candidates(words, items.slots(words.hashes)):
            own = items.words[item]
            margin = max(2, len(own) // 2)
            a = max(int(words.starts[doc]), first - margin)
            b = min(int(words.ends[doc]), first + max(size, len(own)) + margin)
            if (item, a, b) in checked:
                continue
            checked.add((item, a, b))
            region = words.hashes[a:b]
            share = common_subsequence(own, region) / len(own)
            tail = items.answers[item]
            answer = common_subsequence(own[len(own) - tail :], region) >= ANSWER * tail
            if share >= MOST or (share >= HALF and answer):
                found = best.setdefault((doc, item), {"item": item, "cosine": 0.0, "share": 0.0, "answer": False})
                if (share, cosine) > (found["share"], found["cosine"]):
                    found |= {"share": share, "cosine": cosine, "answer": bool(answer)}
        for (doc, _), found in best.items():
            out[doc].append(found)
        return out


def blocks_of_items(benchmark: DataFrame) -> Iterator[Items]:
    """The items in blocks of about ``BLOCK_ITEMS``, dealt by a hash; those without a word are left out."""
    source = benchmark.select(F.col("item_id").alias("item_id"), F.col("text").alias("text"))
    n = -(-source.count() // BLOCK_ITEMS)
    for b in range(n):
        rows = source.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).collect()
        items = Items.of(sorted(((r["item_id"], r["text"]) for r in rows), key=repr))
        if items.ids:
            yield items


def searches(docs: DataFrame, benchmark: DataFrame, text_column: str = "text") -> Iterator[Search]:
    source = texts_as_bytes(docs.select(F.lit(0).alias("doc_id"), text_column), text_column=text_column)
    for items in blocks_of_items(benchmark):
        yield Search(fit(source, items))


LEAKS = "doc_id long, item_id long, cosine double, share double, answer boolean"


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, cosine, share, answer: a row for each leaked item of each row of ``docs``.

    Null and empty texts and items leak nothing. Rows that repeat are searched each for itself; several items with the same text
    are all reported. An empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    schema = arrow_schema(spark, LEAKS)
    out = spark.createDataFrame([], LEAKS)
    for search in searches(docs, benchmark):
        shared = spark.sparkContext.broadcast(search)

        def run(frames: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for ids, texts in gather(frames):
                found = [(i, x) for i, leaks in zip(ids, shared.value.leaks(texts)) for x in leaks]
                yield batch_of(
                    {
                        "doc_id": [i for i, _ in found], "item_id": [shared.value.space.items.ids[x["item"]] for _, x in found],
                        "cosine": [x["cosine"] for _, x in found], "share": [x["share"] for _, x in found], "answer": [x["answer"] for _, x in found],
                    },
                    schema,
                )

        out = out.unionByName(texts_as_bytes(docs).mapInArrow(run, LEAKS))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all columns, that leak no item.

    Null and empty texts leak nothing; repeated rows are judged alike; an empty table or benchmark removes nothing. Columns go
    to Python by their places, whatever they are called.
    """
    spark = docs.sparkSession
    names = docs.columns
    at = names.index("text")
    out = docs
    for search in searches(docs, benchmark):
        shared = spark.sparkContext.broadcast(search)

        def run(frames: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for frame in frames:
                for start in range(0, frame.num_rows, 500):
                    part = frame.slice(start, 500)
                    leaks = shared.value.leaks([(t or "").encode() for t in part.column(at).to_pylist()])
                    kept = part.filter(pa.array([not x for x in leaks], pa.bool_()))
                    yield pa.RecordBatch.from_arrays(kept.columns, names=names)

        out = out.toDF(*[f"c{i}" for i in range(len(names))]).mapInArrow(run, docs.schema)
    return out


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
