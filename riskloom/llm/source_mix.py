"""Mixing sources to target weights by pivotal dependent rounding.

A source's target says how many copies each of its documents is due, as a number with a fraction. The fractions are
rounded in pairs: of two documents whose copies are not yet whole, a random amount of words moves from one to the
other until one of them is whole; the chance of either direction keeps every document's expectation, and the words
of both together do not change. So a source ends at its target, up to its last open document.

Pairs are made along (leaf, source), largest documents first. A leaf is a share of the documents by a hash of the
document, its number follows the number of documents. Every leaf leaves at most one open document a source; these
meet again in nodes of ``FAN_IN`` leaves, and so on up to one. About ``RESERVE`` documents a source, by hash, are kept
for that last node. There each document, the largest first, has all smaller ones as its partner: words move between
it and them until it is whole. So only the smallest is left over, and is rounded to the nearer side. Chance comes from
hashes, so neither partitions nor reruns change the result. Rows stream through a task in order; it holds one open
document at a time, in the last node one source's reserve and what the ``FAN_IN`` nodes before left open.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from decimal import Decimal
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import arrow_schema, batch_of, save, small_side, table
from riskloom.operators.running import running

WEIGHTS = (1, 2, 3)
# No document is taken more often.
MOST_COPIES = 3
LEAF_ROWS = 4096
FAN_IN = 64
# Documents of each source that are paired in the last node only, on average; a smaller source is there wholly.
RESERVE = 1024
# Equal rows (id, source, size and text) are one item with a number, up to this.
EQUAL_ROWS = 4096
SEED = 20_250_101

ROWS_AT_ONCE = 4096

# Fractions nearer to a whole number than this are whole.
WHOLE = 1e-9

_MASK = 2**64 - 1
_SPACES = " \t\n\x0b\x0c\r"
ITEMS = "place long, doc_id {id}, size long, text_hash long, block long, code long, n long, base long, ups long, x double, node long"


def n_words(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; of a null text 0."""
    rest = F.ltrim(F.coalesce(text, F.lit("")), F.lit(_SPACES))
    return F.length(F.regexp_replace(rest, r"[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+", "x")).cast("long")


# --- targets ---


def source_targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """(place, target) and the columns of ``sources``, written; it has source, each once, and source_size.

    Sources by code point, null last, weigh ``weights`` in turn and share the sum of all sizes; a target stops at
    ``most`` times its source's size and the excess is shared again by weight. Sizes of 0 get targets of 0.
    """
    ordered = sources.select(F.lit(0).alias("all"), F.col("source").isNull().alias("missing"), *sources.columns, F.lit(1).alias("one"))
    placed = running(ordered, ["all"], ["missing", "source"], {"place": ("sum", "one")}, "sources")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = save(placed.select(F.col("place").cast("long"), *sources.columns, weight.cast("long").alias("weight")), "source-weights")

    total, all_weights = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    total, left, open_weights, n_full = total or 0, total or 0, all_weights or 1, 0
    most_of = F.col("source_size").cast("decimal(20,0)") * most
    while True:
        # Full where weight * left / open_weights is above most * source_size; in whole numbers.
        full = F.col("weight").cast("decimal(10,0)") * _decimal(left) > most_of * _decimal(open_weights)
        seen = ranked.agg(
            F.count(F.when(full, 1)).alias("n"),
            F.sum(F.when(full, most_of)).alias("taken"),
            F.sum(F.when(~full, F.col("weight"))).alias("weights"),
        ).first()
        if seen["n"] == n_full:
            break
        n_full, left, open_weights = seen["n"], total - int(seen["taken"]), int(seen["weights"])
    shared = F.col("weight") * F.lit(float(left)) / F.lit(float(open_weights))
    target = F.when(full, most_of.cast("double")).otherwise(shared)
    return save(ranked.select("place", *sources.columns, target.alias("target")), "source-targets")


def _decimal(n: int) -> Column:
    return F.lit(Decimal(n)).cast("decimal(20,0)")


# --- rounding ---


def transfer(size_a: int, a: float, size_b: int, b: float, u: float) -> tuple[float, float]:
    """Move words between two open fractions until one is whole; ``u`` in [0, 1) decides the direction."""
    raise_a, lower_a = size_a * (1 - a), size_a * a
    raise_b, lower_b = size_b * (1 - b), size_b * b
    up, down = min(raise_a, lower_b), min(lower_a, raise_b)
    if u * (up + down) < down:
        return (1.0 if raise_a <= lower_b else a + up / size_a), (0.0 if lower_b <= raise_a else b - up / size_b)
    return (0.0 if lower_a <= raise_b else a - down / size_a), (1.0 if raise_b <= lower_a else b + down / size_b)


def _chance(a: int, b: int, level: int) -> float:
    """A number in [0, 1) that two items' hashes and the level decide."""
    h = (a + 3 * b + level * 0x9E3779B97F4A7C15) & _MASK
    h = ((h ^ h >> 31) * 0xD6E8FEB86659FD93) & _MASK
    h = ((h ^ h >> 32) * 0xD6E8FEB86659FD93) & _MASK
    return (h ^ h >> 32) / 2**64


def settle_against_smaller(sizes: Sequence[int], fractions: Sequence[float], chances: Sequence[float]) -> list[bool]:
    """Round fractions, sizes falling: each moves words to or from all smaller ones at once until it is whole.

    The smaller ones' fractions shrink towards 0, or their gaps towards 1, by one factor: kept as scale and offset.
    Chance decides the direction, but for a document so large that the smaller ones can make it whole in one only.
    """
    scale, offset = 1.0, 0.0
    words = sum(sizes)
    mass = sum(s * f for s, f in zip(sizes, fractions))
    out = []
    for s, f, u in zip(sizes, fractions, chances):
        x = min(1.0, max(0.0, scale * f + offset))
        words -= s
        mass = min(max(mass - s * x, 0.0), float(words))
        up, down = min(s * (1 - x), mass), min(s * x, words - mass)
        if WHOLE < x < 1 - WHOLE and up + down > 0:
            can_rise, can_fall = up >= s * (1 - x), down >= s * x
            if can_rise if can_rise != can_fall else u * (up + down) < down:
                keep = 1 - up / mass if mass else 0.0
                x, scale, offset, mass = x + up / s, scale * keep, offset * keep, mass - up
            else:
                keep = 1 - down / (words - mass) if words > mass else 0.0
                x, scale, offset, mass = x - down / s, scale * keep, 1 - keep + keep * offset, mass + down
        out.append(x > 0.5)
    return out


def _in_order(items: DataFrame) -> tuple[DataFrame, str, list[str]]:
    """Items along (node, place), largest first; their schema and names."""
    ddl = ITEMS.format(id=items.schema["doc_id"].dataType.simpleString())
    names = [c.split()[0] for c in ITEMS.split(", ")]
    ordered = items.repartition("node", "place").sortWithinPartitions("node", "place", F.desc("size"), "code", "doc_id", "text_hash", "block")
    return ordered.select(*names), ddl, names


def _rows(frames: Iterable[pa.RecordBatch], names: list[str]) -> Iterator[dict]:
    for frame in frames:
        for values in zip(*(frame.column(n).to_pylist() for n in names)):
            yield dict(zip(names, values))


def _frames(rows: Iterable[dict], names: list[str], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS_AT_ONCE:
            yield batch_of({n: [r[n] for r in held] for n in names}, schema)
            held = []
    yield batch_of({n: [r[n] for r in held] for n in names}, schema)


def _whole(row: dict, more: bool) -> dict:
    row["ups"] += more
    row["x"] = 0.0
    return row


def _is_whole(row: dict) -> bool:
    return row["x"] < WHOLE or row["x"] > 1 - WHOLE


def pair_up(items: DataFrame, level: int) -> DataFrame:
    """Rows of ``items`` with whole copies (x = 0), but for at most one of each (node, place)."""
    ordered, ddl, names = _in_order(items)
    schema = arrow_schema(items.sparkSession, ddl)

    def settled(rows: Iterator[dict]) -> Iterator[dict]:
        group, rest = None, None
        for row in rows:
            if (row["node"], row["place"]) != group:
                if rest is not None:
                    yield rest
                group, rest = (row["node"], row["place"]), None
            if row["size"] == 0:  # no words to move: rounded for itself
                yield _whole(row, _chance(row["code"], 1, level) < row["x"])
            elif _is_whole(row):
                yield _whole(row, row["x"] > 0.5)
            elif rest is None:
                rest = row
            else:
                u = _chance(rest["code"], row["code"], level)
                rest["x"], row["x"] = transfer(rest["size"], rest["x"], row["size"], row["x"], u)
                both, rest = (rest, row), None
                for r in both:
                    if _is_whole(r):
                        yield _whole(r, r["x"] > 0.5)
                    else:
                        rest = r
        if rest is not None:
            yield rest

    return ordered.mapInArrow(lambda frames: _frames(settled(_rows(frames, names)), names, schema), ddl)


def last_node(items: DataFrame, level: int) -> DataFrame:
    """All rows of ``items`` with whole copies."""
    ordered, ddl, names = _in_order(items)
    schema = arrow_schema(items.sparkSession, ddl)

    def settled(rows: Iterator[dict]) -> Iterator[dict]:
        for _, group in groupby(rows, key=lambda r: r["place"]):
            held = list(group)
            more = settle_against_smaller(
                [r["size"] for r in held], [r["x"] for r in held], [_chance(r["code"], 2, level) for r in held]
            )
            for row, m in zip(held, more):
                # Without words nothing can move: rounded for itself.
                yield _whole(row, m if row["size"] else _chance(row["code"], 1, level) < row["x"])

    return ordered.mapInArrow(lambda frames: _frames(settled(_rows(frames, names)), names, schema), ddl)


def rounded_copies(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """The items with their copies, and the sources with their targets (place, source, source_size, source_rows, target).

    An item is (place, doc_id, size, text_hash, block, n, base, ups): n equal rows, of which ``ups`` are taken
    base + 1 times and the others base times. ``docs`` has doc_id, source and text; columns of other names are not read.
    """
    measured = save(
        docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")),
        "sizes",
    )
    sources = measured.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
    targets = source_targets(sources, weights, most)
    leaves = 1 << max(0, -(-measured.count() // LEAF_ROWS) - 1).bit_length()

    due = F.least(F.col("target") / F.greatest(F.col("source_size"), F.lit(1)), F.lit(float(most)))
    share = small_side(targets).select(
        "place", F.col("source").alias("of_source"), "source_rows", F.floor(due).alias("base"), (due - F.floor(due)).alias("share")
    )
    equal = measured.groupBy("doc_id", "source", "size", "text_hash").agg(F.count(F.lit(1)).alias("rows"))
    blocks = equal.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("rows") - 1) / EQUAL_ROWS))))
    n = F.least(F.lit(EQUAL_ROWS), F.col("rows") - F.col("block") * EQUAL_ROWS)
    code = F.xxhash64(F.lit(seed), "place", F.col("doc_id").isNull(), "doc_id", "size", "text_hash", "block")
    reserved = F.pmod(F.xxhash64("code"), F.lit(1 << 30)) * F.col("source_rows") < F.lit(RESERVE << 30)
    items = (
        blocks.join(share, F.col("source").eqNullSafe(F.col("of_source")))
        .withColumn("n", n.cast("long"))
        .withColumn("ups", F.floor(F.col("n") * F.col("share")))
        .withColumn("x", F.col("n") * F.col("share") - F.col("ups"))
        .withColumn("code", code)
        .withColumn("node", F.when(reserved, F.lit(-1)).otherwise(F.pmod("code", F.lit(leaves))))
    )
    columns = [c.split()[0] for c in ITEMS.split(", ")]
    items = save(items.select(*columns), "items")

    nodes, level, rest, out = leaves, 0, items.where("node >= 0"), []
    while nodes > 1:
        settled = save(pair_up(rest, level), f"copies-{level}")
        out.append(settled.where("x = 0"))
        rest = settled.where("x > 0").withColumn("node", F.floor(F.col("node") / FAN_IN))
        nodes, level = -(-nodes // FAN_IN), level + 1
    found = save(last_node(rest.unionByName(items.where("node < 0")).withColumn("node", F.lit(0).cast("long")), level), "copies")
    for part in out:
        found = found.unionByName(part)
    return found.drop("x", "node", "code"), targets


def mixture(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES, seed: int = SEED) -> DataFrame:
    """The mix itself: (doc_id, source, text, copy), a row for every time a document is taken.

    Null and empty texts have size 0 and their fraction is rounded for itself; repeated rows, null ids and null
    sources are documents and sources like others; documents of one size are ordered by their hash. An empty table, or
    one without words, gives an empty mix.
    """
    copies, targets = rounded_copies(docs, weights, most, seed)
    taken = copies.join(small_side(targets).select("place", "source"), "place").select(
        F.col("doc_id").alias("of_id"), F.col("source").alias("of_source"), F.col("text_hash").alias("of_hash"),
        (F.col("n") * F.col("base") + F.col("ups")).alias("times"),
    ).where("times > 0")
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    once = docs.select("doc_id", "source", "text", key.alias("hash")).groupBy("doc_id", "source", "hash").agg(F.first("text").alias("text"))
    same = F.col("doc_id").eqNullSafe(F.col("of_id")) & F.col("source").eqNullSafe(F.col("of_source")) & (F.col("hash") == F.col("of_hash"))
    return once.join(taken, same).select("doc_id", "source", "text", F.explode(F.expr("sequence(1, times)")).alias("copy"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each row of ``documents`` the mix takes."""
    copies, targets = rounded_copies(table(spark, sf_dir, "documents"))
    each = copies.withColumn("i", F.explode(F.expr("sequence(1, n)")))
    times = F.col("base") + (F.col("i") <= F.col("ups")).cast("long")
    return each.join(small_side(targets), "place").select(
        "doc_id", "size", "source_size", "target", (F.col("size") * times).cast("long").alias("taken"), times.cast("long").alias("copies"), "source"
    )
