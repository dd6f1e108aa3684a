"""Suffix-array dedup: bytes covered by a string of ``LENGTH`` bytes, or of so many words, that starts elsewhere as well.

A string starts at every byte. It ends after ``LENGTH`` bytes or, if a number of words is given and they end earlier, with
the last of them; a word that the start cuts counts. So the ends ascend with the starts.

Suffixes are sorted only where a repeat is possible. Every string is represented by an *anchor*: the
place of the least hash among its ``LEAD``-byte parts. Equal strings have their anchors at the same offset, so a
string can repeat only if its anchor's leading bytes do; how often each anchor's lead occurs is counted exactly over
all batches. Neighbouring strings share an anchor; they form a *run*, and a run's bytes are its context.

The contexts of repeated anchors are range-partitioned by their leading bytes, by sampled splitters, so equal leads
never lie on both sides of a boundary. Within a partition the suffixes that begin at the anchors are sorted by multikey
quicksort, eight bytes a key, and so are the reversed bytes before the anchors. Neighbours' common prefixes tell down to
which depth two suffixes are equal; a string repeats if two contexts agree on enough bytes to both sides.

A lead with more than ``GROUP`` different contexts is not brought together in one task: its strings' hashes are
exchanged between batches, summed before they move.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import (
    BYTE_CODES, IS_SPACE, U64, answers, arrow_schema, batch_of, batches, exchange, map_rows, merged_spans, pack,
    partition_number, quoted, rolling, save, save_alone, shuffle_partitions, sliding_min, small_side, span_hashes, table, text_key,
    texts_of, unpack, varied_min,
)

LENGTH = 400
LEAD = 64
# Contexts of one lead that a task compares; more are compared by exchanged hashes.
GROUP = 20_000
# Contexts after which a task compares those it has read, once the lead changes.
TOGETHER = 2048
# Bytes of a batch that are hashed at a time.
SLICE = 1 << 20
PLACE_BITS = 24
# Strings of a group of contexts whose classes are told at a time.
STRINGS_AT_ONCE = 1 << 18

CONTEXT = "batch long, slot int, key long, lead binary, context binary, anchor int, strings int, copies int"


def string_ends(data: np.ndarray, length: int, words: int | None) -> np.ndarray:
    """Where the strings end that start at the first, second, ... byte; the last bytes start none."""
    ends = np.arange(len(data)) + length
    if words is not None:
        word = ~IS_SPACE[data]
        stops = np.flatnonzero(word & ~np.append(word[1:], False)) + 1
        last = np.cumsum(np.bincount(stops, minlength=len(data) + 1))[: len(data)] + words - 1
        some = np.flatnonzero(last < len(stops))
        ends[some] = np.minimum(ends[some], stops[last[some]])
    return ends[ends <= len(data)]


def shortest_string(length: int, words: int | None) -> int:
    return length if words is None else min(length, 2 * words - 1)


class Runs:
    """Anchors of a batch: each run of neighbouring strings that share one. Positions count within the document."""

    def __init__(self, texts: list[bytes], length: int, lead: int, words: int | None = None):
        doc, first, last, stop, anchor, key = [], [], [], [], [], []
        for d, text in enumerate(texts):
            step = max(SLICE, 4 * length)
            for at in range(0, len(text), step):  # strings that begin in this slice
                part = np.frombuffer(text, np.uint8)[at : at + step + length - 1]
                stops = string_ends(part, length, words)[:step]
                n = len(stops)
                if not n:
                    continue
                hashes = rolling(BYTE_CODES[part], lead)
                ranked = hashes >> U64(PLACE_BITS) << U64(PLACE_BITS) | np.arange(len(part), dtype=U64)
                ranked = ranked[: len(part) - lead + 1]
                least = sliding_min(ranked, length - lead + 1)[:n] if words is None else varied_min(ranked, stops - np.arange(n) - lead + 1)
                place = (least & U64((1 << PLACE_BITS) - 1)).astype(np.int64)
                starts = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
                ends = np.concatenate((starts[1:], [n])) - 1
                doc.append(np.full(len(starts), d))
                first.append(starts + at)
                last.append(ends + at)
                stop.append(stops[ends] + at)
                anchor.append(place[starts] + at)
                key.append(hashes[place[starts]])
        join = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.empty(0, kind)
        self.doc, self.first, self.last = join(doc, np.int64), join(first, np.int64), join(last, np.int64)
        self.stop = join(stop, np.int64)  # where the last string ends
        self.anchor, self.key = join(anchor, np.int64), join(key, U64)


def multikey_ranks(strings: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort byte strings (rows, zero-padded to the same width): (order, common prefix with the one before).

    Keys are eight bytes. All rows are split by their first key; only rows that are still tied are split by the next.
    """
    rows, width = strings.shape
    keys = np.zeros((rows, -(-width // 8) * 8), np.uint8)
    keys[:, :width] = strings
    keys = keys.view(">u8").astype(U64)
    order = np.argsort(lengths, kind="stable")  # of rows that differ in padding only, the shorter first
    group = np.zeros(rows, np.int64)  # by place in order: number of the group of tied rows
    open_places = np.arange(rows)
    for column in range(keys.shape[1]):
        if not len(open_places):
            break
        members = order[open_places]
        value = keys[members, column]
        by = np.lexsort((value, group[open_places]))
        order[open_places] = members[by]
        value, owner = value[by], group[open_places]
        fresh = np.concatenate(([True], (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])))
        group[open_places] = open_places[np.maximum.accumulate(np.where(fresh, np.arange(len(fresh)), 0))]
        sizes = np.diff(np.concatenate((np.flatnonzero(fresh), [len(fresh)])))
        open_places = open_places[np.repeat(sizes, sizes) > 1]
    ranked = strings[order]
    common = np.zeros(rows, np.int64)
    if rows > 1:
        for at in range(1, rows, 4096):
            stop = min(rows, at + 4096)
            differ = ranked[at:stop] != ranked[at - 1 : stop - 1]
            common[at:stop] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    # padding is not text
    common[1:] = np.minimum(common[1:], np.minimum(lengths[order][1:], lengths[order][:-1]))
    return order, common


def depth_classes(order: np.ndarray, common: np.ndarray, depth: int | np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
    """For each row, or each of ``rows``, its class of rows that agree on ``depth`` bytes: the first place, in order, of one that does."""
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    at = place if rows is None else place[rows]
    least = [common.copy()]  # of 1, 2, 4, ... places, by the last one
    least[0][:1] = -1
    while 1 << len(least) <= len(order):
        half, before = 1 << len(least) - 1, least[-1]
        least.append(np.concatenate((np.full(half, -1), np.minimum(before[half:], before[:-half]))))
    for k in reversed(range(len(least))):
        at = np.where(least[k][at] >= depth, at - (1 << k), at)
    return at


def repeated_strings(
    contexts: list[bytes], anchors: np.ndarray, strings: np.ndarray, copies: np.ndarray, length: int, words: int | None
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each context the spans, within it, of those of its ``strings`` first strings that occur in another context, or in a copy."""
    rows = len(contexts)
    sizes = np.array([len(c) for c in contexts], np.int64)
    widest_after, widest_before = int((sizes - anchors).max()), int(anchors.max())
    after = np.zeros((rows, widest_after), np.uint8)
    before = np.zeros((rows, max(1, widest_before)), np.uint8)
    ends = []
    for i, (c, a) in enumerate(zip(contexts, anchors.tolist())):
        data = np.frombuffer(c, np.uint8)
        after[i, : len(c) - a] = data[a:]
        before[i, :a] = data[:a][::-1]
        ends.append(string_ends(data, length, words)[: strings[i]].astype(np.int32))
    order_a, common_a = multikey_ranks(after, sizes - anchors)
    order_b, common_b = multikey_ranks(before, anchors)
    first = np.cumsum(strings) - strings
    of = np.repeat(np.arange(rows, dtype=np.int32), strings)
    start = (np.arange(len(of)) - np.repeat(first, strings)).astype(np.int32)
    end = np.concatenate(ends)
    ahead = anchors[of] - start  # bytes before the anchor
    found = copies[of] > 1
    # equal strings have their anchor at the same offset, are of one size, and agree on the bytes to both sides of it
    step = max(1, (widest_before + 1) * STRINGS_AT_ONCE // max(1, len(of)))
    for low in range(0, widest_before + 1, step):
        here = np.flatnonzero((ahead >= low) & (ahead < low + step))
        x, size, row = ahead[here], (end - start)[here], of[here]
        code = (x * (length + 1) + size) * rows + depth_classes(order_a, common_a, size - x, row)
        code = code * rows + depth_classes(order_b, common_b, x, row)
        _, which, times = np.unique(code, return_inverse=True, return_counts=True)
        found[here] |= times[which] > 1
    out = []
    for a, n in zip(first.tolist(), strings.tolist()):
        hits = np.flatnonzero(found[a : a + n]) + a
        out.append(merged_spans(start[hits], end[hits]))
    return out


def packed_spans(starts: np.ndarray, ends: np.ndarray) -> bytes:
    return np.concatenate((starts, ends)).astype(np.uint32).tobytes()


def _contexts(row: dict) -> tuple[list, dict, list]:
    """The contexts of repeated anchors: (runs kept, slot of each different context, slot of each run)."""
    doc, first, last, stop, anchor = (unpack(row[c], np.uint32).astype(np.int64) for c in ("doc", "first", "last", "stop", "anchor"))
    often = unpack(row["keys"], U64)[answers(row) >= 2]
    key = unpack(row["run_keys"], U64)
    kept = np.flatnonzero(np.isin(key, often))
    texts, slots, slot_of = texts_of(row), {}, []
    for i in kept.tolist():
        c = texts[doc[i]][first[i] : stop[i]]
        entry = slots.setdefault((c, int(anchor[i] - first[i]), int(last[i] - first[i]) + 1), [len(slots), 0, int(key[i].astype(np.int64))])
        entry[1] += 1
        slot_of.append(entry[0])
    return kept, slots, slot_of


def repeated_bytes(docs: DataFrame, length: int = LENGTH, words: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(batches of whole texts, spans): the second has for each batch the documents' maximal repeated spans."""
    spark = docs.sparkSession
    lead = min(LEAD, shortest_string(length, words))

    def anchors(ids: list, texts: list[bytes]) -> dict:
        runs = Runs(texts, length, lead, words)
        unique, counts = np.unique(runs.key, return_counts=True)
        packed = {n: pack(getattr(runs, n).astype(np.uint32)) for n in ("doc", "first", "last", "stop", "anchor")}
        return packed | {"run_keys": pack(runs.key), "keys": pack(unique), "payload": pack(counts.astype(np.int64))}

    held = batches(
        docs, "anchors", anchors,
        "doc binary, first binary, last binary, stop binary, anchor binary, run_keys binary, keys binary, payload binary",
    )

    def cut(row: dict) -> Iterator[dict]:
        kept, slots, slot_of = _contexts(row)
        doc, first = unpack(row["doc"], np.uint32)[kept], unpack(row["first"], np.uint32)[kept]
        empty = {"slot": None, "key": None, "lead": None, "context": None, "anchor": None, "strings": None, "copies": None}
        yield empty | {"batch": row["batch"], "runs": [int(x) for x in doc], "firsts": [int(x) for x in first], "slots": slot_of}
        for (c, a, n), (slot, copies, key) in slots.items():
            yield {"batch": row["batch"], "slot": slot, "key": key, "lead": c[a : a + lead], "context": c, "anchor": a, "strings": n, "copies": copies, "runs": None, "firsts": None, "slots": None}

    def spread(row: dict) -> Iterator[dict]:
        found = {v["slot"]: np.frombuffer(v["found"], np.uint32).reshape(2, -1).astype(np.int64) for v in row["verdicts"]}
        lost: dict[int, list] = {}
        for d, first, slot in zip(row["runs"], row["firsts"], row["slots"]):
            if slot in found:
                lost.setdefault(d, []).append(found[slot] + first)
        spans = {d: merged_spans(*np.concatenate(s, axis=1)) for d, s in lost.items()}
        yield {"batch": row["batch"], "lost": [{"doc": d, "starts": a.tolist(), "ends": b.tolist()} for d, (a, b) in spans.items()]}

    spans = "batch long, lost array<struct<doc: int, starts: array<int>, ends: array<int>>>"

    def contexts_cut() -> DataFrame:
        counted = exchange(held, "anchor-counts")
        joined = held.drop("doc_ids", "payload").join(small_side(counted), "batch")
        return map_rows(joined, cut, CONTEXT + ", runs array<int>, firsts array<int>, slots array<int>")

    def lost() -> DataFrame:
        cuts = save_alone(spark, "contexts", contexts_cut)
        contexts = cuts.where("slot is not null").select("batch", "slot", "key", "lead", "context", "anchor", "strings", "copies")
        # leads with too many different contexts for one task: at most contexts / GROUP
        hot = save(contexts.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > GROUP).select("key"), "hot-leads")
        verdicts = _in_ranges(contexts.join(small_side(hot), "key", "left_anti"), length, words)
        if not hot.isEmpty():
            verdicts = verdicts.unionByName(_by_hashes(contexts.join(small_side(hot), "key", "left_semi"), length, words))

        # rows: a batch's runs, and the verdicts on its contexts
        by_batch = save(verdicts.groupBy("batch").agg(F.collect_list(F.struct("slot", "found")).alias("verdicts")), "verdicts")
        runs = cuts.where("slot is null").select("batch", "runs", "firsts", "slots")
        return map_rows(runs.join(small_side(by_batch), "batch"), spread, spans)

    return held.select("batch", "doc_ids", "lens", "blob"), save_alone(spark, "repeated-bytes", lost)


def _in_ranges(contexts: DataFrame, length: int, words: int | None) -> DataFrame:
    """Range partitions by leading bytes, each lead's contexts sorted and compared in one task: batch, slot, found."""
    schema = arrow_schema(contexts.sparkSession, "batch long, slot int, found binary")

    def compare(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[dict] = []

        def settle() -> pa.RecordBatch:
            merged: dict[tuple, list] = {}  # equal contexts of several batches
            for g in group:
                entry = merged.setdefault((g["context"], g["anchor"], g["strings"]), [0, []])
                entry[0] += g["copies"]
                entry[1].append((g["batch"], g["slot"]))
            anchors, strings = (np.array(x, np.int64) for x in zip(*[m[1:] for m in merged]))
            copies = np.array([n for n, _ in merged.values()], np.int64)
            rows = {"batch": [], "slot": [], "found": []}
            found = repeated_strings([m[0] for m in merged], anchors, strings, copies, length, words)
            for (starts, ends), (_, owners) in zip(found, merged.values()):
                if len(starts):
                    spans = packed_spans(starts, ends)
                    for batch, slot in owners:
                        rows["batch"].append(batch)
                        rows["slot"].append(slot)
                        rows["found"].append(spans)
            return batch_of(rows, schema)

        for frame in frames:
            for row in frame.to_pylist():
                # a lead's contexts stay together: only where the lead changes a group may end
                if len(group) >= TOGETHER and row["lead"] != group[-1]["lead"]:
                    yield settle()
                    group = []
                group.append(row)
        if group:
            yield settle()

    ranges = contexts.repartitionByRange(shuffle_partitions(contexts.sparkSession), "lead").sortWithinPartitions("lead")
    return ranges.select("batch", "slot", "lead", "context", "anchor", "strings", "copies").mapInArrow(compare, "batch long, slot int, found binary")


def _by_hashes(contexts: DataFrame, length: int, words: int | None) -> DataFrame:
    """The same for leads of very many contexts: hashes of the strings, summed in each task, meet by exchange."""
    spark = contexts.sparkSession
    schema = arrow_schema(spark, "batch long, keys binary, payload binary, owners binary")

    def hashes(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for frame in frames:
            rows = frame.to_pylist()
            for at in range(0, len(rows), 2048):
                part = rows[at : at + 2048]
                data = [np.frombuffer(r["context"], np.uint8) for r in part]
                ends = [string_ends(d, length, words)[: r["strings"]] for d, r in zip(data, part)]
                each = [span_hashes(BYTE_CODES[d], np.arange(len(e)), e) for d, e in zip(data, ends)]
                copies = np.repeat([r["copies"] for r in part], [len(e) for e in each])
                unique, which = np.unique(np.concatenate(each), return_inverse=True)
                total = np.bincount(which, copies, len(unique)).astype(np.int64)
                index = {"batch": [r["batch"] for r in part], "slot": [r["slot"] for r in part], "ends": ends, "which": which}
                yield batch_of({"batch": [partition_number() << 32 | number], "keys": [pack(unique)], "payload": [pack(total)], "owners": [pickle.dumps(index)]}, schema)
                number += 1

    sent = save(contexts.select("batch", "slot", "context", "strings", "copies").mapInArrow(hashes, "batch long, keys binary, payload binary, owners binary"), "hot-strings")

    def verdict(row: dict) -> Iterator[dict]:
        index = pickle.loads(row["owners"])
        often = (answers(row) >= 2)[index["which"]]
        at = 0
        for batch, slot, ends in zip(index["batch"], index["slot"], index["ends"]):
            hits = np.flatnonzero(often[at : at + len(ends)])
            if len(hits):
                yield {"batch": batch, "slot": slot, "found": packed_spans(*merged_spans(hits, ends[hits]))}
            at += len(ends)

    return map_rows(sent.join(exchange(sent, "hot-counts"), "batch"), verdict, "batch long, slot int, found binary")


def kept_texts(row: dict) -> Iterator[tuple[int | None, bytes, bytes, int, int]]:
    """(doc_id, text, kept bytes, removed bytes, removed runs) of each document of a batch."""
    lost = {x["doc"]: (x["starts"], x["ends"]) for x in row["lost"] or []}
    for d, (doc_id, text) in enumerate(zip(row["doc_ids"], texts_of(row))):
        starts, ends = lost.get(d, ([], []))
        kept = b"".join(text[a:b] for a, b in zip([0, *ends], [*starts, len(text)]))
        yield doc_id, text, kept, len(text) - len(kept), len(starts)


def digest(docs: DataFrame, length: int = LENGTH, words: int | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row; a null text is empty.

    Texts shorter than ``length``, and of fewer ``words`` if given, keep all bytes. Rows that repeat a whole text lose all of it, whatever their ids. An
    empty table gives no rows.
    """
    held, lost = repeated_bytes(docs, length, words)

    def rows(row: dict) -> Iterator[dict]:
        for doc_id, text, kept, removed, spans in kept_texts(row):
            yield {"doc_id": doc_id, "n_bytes": len(text), "n_removed": removed, "n_spans": spans, "kept_sha256": hashlib.sha256(kept).hexdigest()}

    joined = held.join(small_side(lost), "batch", "left")
    return map_rows(joined, rows, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame, length: int = LENGTH, words: int | None = None) -> DataFrame:
    """The rows of ``docs``, with all columns, whose texts lose every repeated string; rows without a word left go.

    A code point that is cut in two goes as a whole. n_chars, if there is such a column, follows the text.
    """

    def changed(row: dict) -> Iterator[dict]:
        for doc_id, text, kept, removed, _ in kept_texts(row):
            if removed:
                rest = kept.decode("utf-8", "ignore")
                yield {"_id": doc_id, "_key": text_key(text), "_text": rest if rest.strip() else None}

    def changed_texts() -> DataFrame:
        held, lost = repeated_bytes(docs, length, words)
        return map_rows(held.join(small_side(lost), "batch"), changed, "_id long, _key long, _text string")

    new = save_alone(docs.sparkSession, "changed-texts", changed_texts)
    new = new.withColumn("_changed", F.lit(True)).dropDuplicates(["_id", "_key"]).alias("new")
    # Both sides have names of their own, whatever columns the documents have.
    own = docs.alias("own")
    same = F.col("own.doc_id").eqNullSafe(F.col("new._id")) & (F.xxhash64(F.coalesce("own.text", F.lit(""))) == F.col("new._key"))
    out = own.join(new, same, "left").where("new._changed is null or new._text is not null")
    text = F.when(F.col("new._changed"), F.col("new._text")).otherwise(F.col("own.text"))
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(text.alias("text"))
        elif c == "n_chars":
            n_chars = F.when(F.col("new._changed"), F.length("new._text")).otherwise(F.col("own.n_chars"))
            columns.append(n_chars.cast(docs.schema["n_chars"].dataType).alias("n_chars"))
        else:
            columns.append(F.col(f"own.{quoted(c)}"))
    return out.select(*columns)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "documents"))


def op7_sql() -> str:
    """Every string of 400 bytes by its digest: for tables of test size."""
    return """
    WITH docs AS (SELECT row_number() OVER () AS row, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    starts AS (SELECT row, hash(substr(h, 2 * i + 1, 800)) AS m, i FROM (SELECT row, h, unnest(range(0, length(h) // 2 - 399)) AS i FROM docs WHERE length(h) >= 800)),
    again AS (SELECT m FROM starts GROUP BY m HAVING count(*) > 1),
    hit AS (SELECT row, i FROM starts JOIN again USING (m)),
    marked AS (SELECT row, i, CASE WHEN i > lag(i) OVER w + 400 OR lag(i) OVER w IS NULL THEN 1 ELSE 0 END AS fresh FROM hit WINDOW w AS (PARTITION BY row ORDER BY i)),
    numbered AS (SELECT row, i, sum(fresh) OVER (PARTITION BY row ORDER BY i) AS span FROM marked),
    spans AS (SELECT row, span, min(i) AS a, max(i) + 400 AS b FROM numbered GROUP BY row, span),
    gaps AS (SELECT s.row, s.span, substr(d.h, 2 * s.b + 1, 2 * (coalesce(lead(s.a) OVER (PARTITION BY s.row ORDER BY s.span), length(d.h) // 2) - s.b)) AS part,
               CASE WHEN s.span = 1 THEN substr(d.h, 1, 2 * s.a) ELSE '' END AS head
             FROM spans s JOIN docs d ON d.row = s.row),
    kept AS (SELECT row, string_agg(head || part, '' ORDER BY span) AS rest, count(*) AS n FROM gaps GROUP BY row)
    SELECT d.doc_id, length(d.h) // 2 AS n_bytes, CASE WHEN k.row IS NULL THEN 0 ELSE (length(d.h) - length(k.rest)) // 2 END AS n_removed,
      coalesce(k.n, 0) AS n_spans, sha256(unhex(coalesce(k.rest, d.h))) AS kept_sha256
    FROM docs d LEFT JOIN kept k ON k.row = d.row
    """
