"""N-gram Jaccard join: all documents whose shingle sets are alike, as components.

Exact set similarity with relations between sets used to skip work:

1.  Equal sets are one set. In any order common to all sets, the first shingles of two alike sets have several in
    common; how many first ones must have how many is known from the sizes. So, in the order of hashes, a set goes on only
    if enough of its first shingles are among those of any other sets. Most sets have a few of them, alike sets many.
2.  Among those, shingles are put in order of how many sets hold them, rarest first. Shingles of one set only come
    first of all, so a set with too many of its own is done. What remains is the inverted index: for each
    shingle the sets that have it early, each with its position.
3.  An entry's position bounds the size of a partner that could still be alike. Lists are cut into blocks of sizes, and blocks beyond that
    bound are skipped as a whole.
4.  Each list first compares its members with one of them only, the one with the earliest position: links grow with the
    length of lists, not with its square. Lists whose members are then in one component are done.
5.  For the others, a member's answers follow from those of the set it was compared with: the numbers of
    differing shingles obey the triangle inequality, so two sets with known differences to a third are often
    known to be alike, or known not to be. Only the undecided pairs, of different components, are compared.

Shingles are 64-bit hashes of word sequences; equality of sets is by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from math import log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import (
    PLACE_IN_BATCH, U64, Words, answers, arrow_schema, batches, exchange, map_rows, pack, rolling, save, save_alone, small_side, table, text_key,
    texts_of, unpack, unused,
)
from riskloom.llm.components import components

FIRST = 1 << PLACE_IN_BATCH


class Likeness:
    """Jaccard similarity of at least ``num / den``, in whole numbers."""

    def __init__(self, num: int, den: int):
        if not 0 < num <= den:
            raise ValueError("the similarity must be above 0 and at most 1")
        self.num, self.den = num, den

    def early(self, n):
        """How many first shingles of a set of size ``n`` must hold one in common with any partner."""
        return n + self.num * n // -self.den + 1

    def several(self, n):
        """How many common shingles the first filter asks for at once: a tenth of a set of size ``n``."""
        return -(-n // 10)

    def first(self, n: int) -> int:
        """How many shingles of least hash must hold that many common with any partner of the same size or larger."""
        return min(n, n - self.smallest(n) + self.several(n))

    def largest(self, n: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Size of the largest possible partner if the first common shingle is at ``position`` (from 1)."""
        return ((self.num + self.den) * (n - position + 1) - self.num * n) // self.num

    def smallest(self, n):
        return -(-self.num * n // self.den)

    def alike(self, common: Column, n: Column, m: Column) -> Column:
        return (self.num + self.den) * common >= self.num * (n + m)

    def sizes(self, n: Column, m: Column) -> Column:
        return self.num * F.greatest(n, m) <= self.den * F.least(n, m)


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Distinct k-word shingles of each text, ascending; with fewer words the whole sequence; A-Z lower-cased."""
    words = Words(texts, lower=True)
    if not len(words.hashes):
        return [np.empty(0, U64)] * len(texts)
    hashes = rolling(words.hashes, k) if len(words.hashes) >= k else words.hashes
    out = []
    for start, n in zip(words.starts.tolist(), words.counts.tolist()):
        if n == 0:
            out.append(np.empty(0, U64))
        elif n < k:
            own = words.hashes[start : start + n]
            out.append(rolling(np.concatenate((own, np.full(1, U64(n)))), n + 1)[:1])
        else:
            s = np.sort(hashes[start : start + n - k + 1])
            out.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
    return out


def _digest(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def members(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """node, doc_id, text_key, n, component, component_id of every row; written.

    ``node`` numbers the rows, ``component`` is the least node of a distinct set reachable by links (null for an empty
    set), ``text_key`` is xxhash64 of the text.
    """

    def build() -> DataFrame:
        like = Likeness(num, den)
        held, nodes, groups = _distinct_sets(docs, k, like)
        sets = _sets_in_order(held, groups, k, like)
        entries = save(
            sets.select("node", "n", F.explode("early").alias("e")).select("node", "n", "e.token", "e.position", "e.largest"), "index"
        )
        links = _links(sets, entries, like)
        labels = groups.join(components(links), groups.rep == F.col("node"), "left").select(
            "sid", "first_id", F.coalesce("component", "rep").alias("component")
        )
        least = labels.groupBy("component").agg(F.min("first_id").alias("component_id"))
        of_set = save(labels.join(least, "component").select("sid", "component", "component_id"), "components")
        return nodes.join(of_set, "sid", "left").drop("sid")

    return save_alone(docs.sparkSession, "members", build)


def join(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """doc_id, n_shingles, component_id of every row: the least doc_id reachable by links of similarity >= num / den.

    A text that is null or has no words has an empty set and is linked with nothing. Rows with equal sets, repeated rows
    among them, are linked. A null doc_id is never a component's id unless its component has no other. An empty
    table gives no rows.
    """
    return members(docs, k, num, den).select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def one_of_each(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """The rows of ``docs``, with all columns, without those linked to a kept one: each component keeps its least doc_id.

    Rows without words are all kept. Of rows that share doc_id and text one is kept, if any is.
    """

    def dropped() -> DataFrame:
        found = members(docs, k, num, den)
        order = F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "node")
        kept = found.where("component is not null").groupBy("component").agg(F.min(order).alias("kept"))
        rows = found.join(kept, "component").select(
            F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), (F.col("node") == F.col("kept.node")).alias("stays")
        )
        return rows.groupBy("_id", "_key").agg(F.max("stays").alias("_stays"), F.count("*").alias("_copies")).where("not _stays or _copies > 1")

    keys = save_alone(docs.sparkSession, "dropped", dropped)
    # Both sides have names of their own, whatever columns the documents have.
    own, key = docs.alias("own"), keys.alias("key")
    text_hash = F.xxhash64(F.coalesce("own.text", F.lit("")))
    same = F.col("own.doc_id").eqNullSafe(F.col("key._id")) & (text_hash == F.col("key._key"))
    out = own.join(small_side(keys).alias("key"), same, "left_anti")
    if not keys.where("_stays").isEmpty():
        hashed = unused(docs, "hash")
        once = own.join(key.where("_stays"), same, "left_semi").withColumn(hashed, text_hash)
        out = out.unionByName(once.dropDuplicates(["doc_id", hashed]).drop(hashed))
    return out


def _distinct_sets(docs: DataFrame, k: int, like: Likeness) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(batches with first shingles, a row for each document, a row for each distinct set)."""

    def first_shingles(ids: list, texts: list[bytes]) -> dict:
        sets = shingle_sets(texts, k)
        sids = [_digest(s) for s in sets]
        distinct = list(dict(zip(sids, sets)).values())
        early = [s[: like.first(len(s))] for s in distinct if len(s)]
        keys, counts = np.unique(np.concatenate(early), return_counts=True) if early else (np.empty(0, U64), np.empty(0, int))
        return {"text_keys": [text_key(t) for t in texts], "sizes": [len(s) for s in sets], "sids": sids, "keys": pack(keys), "payload": pack(counts.astype(np.int64))}

    held = batches(docs, "shingles", first_shingles, "text_keys array<bigint>, sizes array<bigint>, sids array<binary>, keys binary, payload binary")
    each = held.select("batch", F.posexplode(F.arrays_zip("doc_ids", "text_keys", "sizes", "sids")).alias("place", "d"))
    nodes = each.select(
        (F.col("batch") * FIRST + F.col("place")).alias("node"), F.col("d.doc_ids").alias("doc_id"),
        F.col("d.text_keys").alias("text_key"), F.col("d.sizes").alias("n"), F.when(F.col("d.sizes") > 0, F.col("d.sids")).alias("sid"),
    )
    groups = nodes.where("n > 0").groupBy("sid").agg(F.min("node").alias("rep"), F.min("doc_id").alias("first_id"))
    return held, nodes, save(groups, "distinct-sets")


def _sets_in_order(held: DataFrame, groups: DataFrame, k: int, like: Likeness) -> DataFrame:
    """Sets that may have a partner: node, n, their shared shingles rarest first, and the early ones of these."""
    reps = save(
        groups.select(F.floor(F.col("rep") / FIRST).alias("batch"), (F.col("rep") % FIRST).cast("int").alias("place"))
        .groupBy("batch").agg(F.collect_list("place").alias("places")),
        "places",
    )
    counted = exchange(held, "first-shingles")

    def survivors(row: dict) -> Iterator[dict]:
        often = unpack(row["keys"], U64)[answers(row) >= 2]
        places, texts = sorted(row["places"]), texts_of(row)
        kept, sets = [], []
        for place, s in zip(places, shingle_sets([texts[p] for p in places], k)):
            first = s[: like.first(len(s))]
            at = np.minimum(np.searchsorted(often, first), max(0, len(often) - 1))
            # a smaller partner has fewer first shingles: its number is what can be asked for
            if len(often) and (often[at] == first).sum() >= like.several(like.smallest(len(s))):
                kept.append(place)
                sets.append(s)
        if kept:
            yield {"batch": row["batch"], "places": kept, "sizes": [len(s) for s in sets], "shingles": np.concatenate(sets).tobytes()}

    read = held.select("batch", "lens", "blob", "keys")
    joined = read.join(small_side(reps), "batch").join(small_side(counted), "batch")
    going_on = save(
        map_rows(joined, survivors, "batch long, places array<int>, sizes array<bigint>, shingles binary"), "surviving-sets"
    )

    def distinct(row: dict) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = np.unique(np.frombuffer(row["shingles"], U64), return_counts=True)
        return keys, counts.astype(np.int64)

    held_by = exchange(going_on, "shingle-counts", prepare=distinct, reads=("shingles",))

    schema = "node long, n long, shingles array<bigint>, early array<struct<token: bigint, position: bigint, largest: bigint>>"
    arrow = arrow_schema(held.sparkSession, schema)

    def in_order(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for i in range(frame.num_rows):
                row = {c: frame.column(c)[i].as_py() for c in frame.schema.names}
                yield _ordered(row, like, arrow)

    return save(going_on.join(small_side(held_by), "batch").mapInArrow(in_order, schema), "sets")


def _ordered(row: dict, like: Likeness, schema: pa.Schema) -> pa.RecordBatch:
    """A batch's sets with their shared shingles, rarest first, and which of these are early enough to matter."""
    shingles, n = np.frombuffer(row["shingles"], U64), np.array(row["sizes"], np.int64)
    frequency = answers(row)[np.unique(shingles, return_inverse=True)[1]]
    shared = np.flatnonzero(frequency >= 2)
    doc = np.repeat(np.arange(len(n)), n)[shared]
    order = np.lexsort((shingles[shared], frequency[shared], doc))
    token, counts = shingles[shared[order]].view(np.int64), np.bincount(doc, minlength=len(n))
    starts = np.cumsum(counts) - counts
    position = np.arange(len(doc)) - starts[doc] + (n - counts)[doc] + 1
    largest = like.largest(n[doc], position)
    useful = (position <= like.early(n)[doc]) & (largest >= like.smallest(n)[doc])
    kept = np.flatnonzero(np.bincount(doc, useful, len(n)))
    there = np.isin(doc, kept)
    entry = pa.StructArray.from_arrays([pa.array(x[useful]) for x in (token, position, largest)], fields=list(schema.field("early").type.value_type))
    lists = lambda sizes, values, kind: pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), values).cast(kind)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(row["batch"] * FIRST + np.array(row["places"], np.int64)[kept]),
            pa.array(n[kept]),
            lists(counts[kept], pa.array(token[there]), schema.field("shingles").type),
            lists(np.bincount(doc, useful, len(n))[kept].astype(np.int64), entry, schema.field("early").type),
        ],
        schema=schema,
    )


def _common(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Number of common shingles, and sizes, of the given pairs (a, b)."""
    a = sets.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("shingles").alias("s_a"))
    b = sets.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("shingles").alias("s_b"))
    both = pairs.join(a, "a").join(b, "b")
    return both.select("a", "b", "n_a", "n_b", F.size(F.array_intersect("s_a", "s_b")).cast("long").alias("common"))


def _links(sets: DataFrame, entries: DataFrame, like: Likeness) -> DataFrame:
    """Enough links (a, b) that components by them are those of all links."""
    # each list against its earliest member
    center = F.min(F.struct((F.col("position") / F.col("n")).alias("p"), "node", "n", "largest"))
    centers = save(
        entries.groupBy("token").agg(center.alias("c"), F.count("*").alias("members")).where("members > 1")
        .select("token", F.col("c.node").alias("center"), F.col("c.n").alias("center_n"), F.col("c.largest").alias("center_largest")),
        "centers",
    )
    possible = (F.col("node") != F.col("center")) & like.sizes(F.col("n"), F.col("center_n"))
    possible &= (F.col("center_n") <= F.col("largest")) & (F.col("n") <= F.col("center_largest"))
    pairs = entries.join(centers, "token").where(possible).select(F.col("node").alias("a"), F.col("center").alias("b")).distinct()
    star = save(_common(pairs, sets), "star")
    linked = star.where(like.alike(F.col("common"), F.col("n_a"), F.col("n_b"))).select("a", "b")
    near = save(components(linked), "near")

    # what is left: members of one list in different components
    placed = entries.join(near, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = placed.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("token")
    known = star.select(F.col("a").alias("node"), F.col("b").alias("center"), (F.col("n_a") + F.col("n_b") - 2 * F.col("common")).alias("apart"))
    rest = save(
        placed.join(mixed, "token").join(centers.select("token", "center"), "token").join(known, ["node", "center"], "left")
        .withColumn("apart", F.when(F.col("node") == F.col("center"), 0).otherwise(F.col("apart"))),
        "undecided",
    )
    more = _undecided(rest, like)
    checked = _common(more.where("not sure").select("a", "b"), sets)
    found = checked.where(like.alike(F.col("common"), F.col("n_a"), F.col("n_b"))).select("a", "b")
    return save(linked.unionByName(found).unionByName(more.where("sure").select("a", "b")), "links")


def _undecided(rest: DataFrame, like: Likeness) -> DataFrame:
    """Pairs (a, b, sure) of one list and different components that size, position and known differences allow."""
    if like.num == like.den:
        block, steps, width = F.col("n"), [0], None
    else:
        width = log(like.den / like.num)
        block, steps = F.floor(F.log("n") / width), [0, 1, 2]
    rest = rest.withColumn("block", block.cast("long"))
    left = rest.select(*[F.col(c).alias(f"{c}_a") for c in ("node", "n", "largest", "component", "apart")], "token", "block")
    probes = left.withColumn("step", F.explode(F.array(*[F.lit(s) for s in steps]))).withColumn("block", F.col("block") + F.col("step"))
    if width is not None:  # a block whose least size is beyond what the position allows is skipped
        probes = probes.where((F.col("step") == 0) | (F.floor(F.exp(F.col("block") * width)) - 1 <= F.col("largest_a")))
    right = rest.select(*[F.col(c).alias(f"{c}_b") for c in ("node", "n", "largest", "component", "apart")], "token", "block")
    pairs = probes.join(right, ["token", "block"])
    total = F.col("n_a") + F.col("n_b")
    allowed = (like.den - like.num) * total  # of differing shingles, times num + den
    times = like.num + like.den
    larger = (F.col("n_b") > F.col("n_a")) | ((F.col("n_b") == F.col("n_a")) & (F.col("node_b") > F.col("node_a")))
    possible = larger & (F.col("component_a") != F.col("component_b")) & like.sizes(F.col("n_a"), F.col("n_b"))
    possible &= (F.col("n_b") <= F.col("largest_a")) & (F.col("n_a") <= F.col("largest_b"))
    possible &= F.coalesce(times * F.abs(F.col("apart_a") - F.col("apart_b")) <= allowed, F.lit(True))
    sure = F.coalesce(times * (F.col("apart_a") + F.col("apart_b")) <= allowed, F.lit(False))
    return save(
        pairs.where(possible).groupBy(F.col("node_a").alias("a"), F.col("node_b").alias("b")).agg(F.max(sure).alias("sure")), "undecided-pairs"
    )


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"), 3, 90, 100)


def op5_sql() -> str:
    """All pairs that share a shingle, and their reach: for tables of test size."""
    return r"""
    WITH RECURSIVE docs AS (
      SELECT row_number() OVER () AS node, doc_id,
        list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws
      FROM documents),
    sets AS (
      SELECT node, unnest(list_distinct(CASE WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])
                               WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END)) AS g
      FROM docs),
    sizes AS (SELECT node, count(*) AS n FROM sets GROUP BY node),
    coded AS (SELECT node, hash(g) AS g FROM sets),
    pairs AS (SELECT a.node AS a, b.node AS b, count(*) AS c FROM coded a JOIN coded b ON a.g = b.g AND a.node < b.node GROUP BY ALL),
    links AS (SELECT a, b FROM pairs JOIN sizes x ON x.node = a JOIN sizes y ON y.node = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
    edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reach AS (SELECT DISTINCT a AS node, a AS other FROM edges UNION SELECT r.node, e.b FROM reach r JOIN edges e ON e.a = r.other)
    SELECT d.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, least(d.doc_id, min(o.doc_id)) AS component_id
    FROM docs d LEFT JOIN sizes s ON s.node = d.node LEFT JOIN reach r ON r.node = d.node LEFT JOIN docs o ON o.node = r.other
    GROUP BY d.node, d.doc_id
    """
