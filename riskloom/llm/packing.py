"""Packing: bounded-space online packing of token sequences.

Each partition keeps a fixed number of open windows. A document's full windows are cut off at once; the rest goes to
the open window that it fits best. When none fits and no more may be opened, the fullest is topped up with the
document's head and emitted, and what is left of the document is placed again. Windows that are still open at the
end are merged in rounds of ``FAN_IN`` partitions each; a round leaves one open window for each group, the
last round one for all. That last rest is cut into powers of two, which need no padding.

A task that runs again places the same documents in the same way, so pieces and numbers do not change.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import (
    U64, arrow_schema, batch_of, gather, kept_between_tasks, mix, partition_number, save, table, texts_as_bytes, trimmed,
)

WINDOW = 4096
OPEN_WINDOWS = 16
FAN_IN = 32
END_ID = 2
# Entries of a worker's caches of words and of pieces of words.
CACHE_ENTRIES = 400_000
# Longer words and pieces are not cached, and longer pieces not merged here.
LONGEST = 64
# Bytes of words that are looked up together.
GROUP_BYTES = 1 << 19
# ASCII white space, and what a byte counts in a string's hash at each of its places.
WHITE = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))
WEIGHTS = mix(np.arange(1, LONGEST + 1, dtype=np.uint64)) | U64(1)
NO_IDS = np.zeros(0, "<u4")

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary, home long"
)
OUT = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# --- tokens ---


def byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies use for each byte: itself, or the next one from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Merges:
    """The merges of a byte-level vocabulary with a word end, applied to many pieces at a time.

    The pieces' symbols lie one after the other. In every step each piece joins its leftmost pair of the lowest rank;
    a piece without such a pair is done.
    """

    NONE = np.int32(2**31 - 1)

    def __init__(self, model: dict):
        vocabulary, end = model["vocab"], model["end_of_word_suffix"]
        letters = byte_letters()
        self.inner = np.array([vocabulary[letters[b]] for b in range(256)], np.int64)
        self.final = np.array([vocabulary[letters[b] + end] for b in range(256)], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocabulary[x] << 32 | vocabulary[y] for x, y in pairs], np.int64)
        self.joined = np.array([vocabulary[x + y] for x, y in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        # ranks of two bytes, and of two of which the second ends the word
        self.first = np.stack([self.rank(self.inner[:, None], x[None, :]) for x in (self.inner, self.final)])

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], self.NONE)

    def encode(self, data: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each piece of ``lens`` bytes has, and the ids of all."""
        counts, (members, lens) = np.zeros(len(lens), np.int64), (np.arange(len(lens)), lens.astype(np.int64))
        begin = np.cumsum(lens) - lens
        last = begin + lens - 1
        symbols = self.inner[data]
        symbols[last] = self.final[data[last]]
        ends = np.zeros(len(data), np.int8)
        ends[last] = 1
        ranks = np.full(len(data), self.NONE)
        ranks[:-1] = self.first[ends[1:], data[:-1], data[1:]]
        ranks[last] = self.NONE
        ended = []
        while len(members):
            best = np.minimum.reduceat(ranks.astype(np.int64) << 32 | np.arange(len(ranks)), begin)
            done = best >> 32 == self.NONE
            if done.any():
                gone = np.repeat(done, lens)
                counts[members[done]] = lens[done]
                ended.append((members[done], symbols[gone]))
                best = (best - np.cumsum(lens * done))[~done]  # places move up
                members, lens, symbols, ranks = members[~done], lens[~done], symbols[~gone], ranks[~gone]
                if not len(members):
                    break
            at, rank = best & 0xFFFFFFFF, best >> 32
            symbols[at] = self.joined[rank]
            kept = np.ones(len(symbols), bool)
            kept[at + 1] = False
            symbols, ranks, lens = symbols[kept], ranks[kept], lens - 1
            at -= np.arange(len(at))  # each piece before has lost one
            begin = np.cumsum(lens) - lens
            ranks[at] = self.NONE
            for left in (at[at > begin] - 1, at[at < begin + lens - 1]):
                ranks[left] = self.rank(symbols[left], symbols[left + 1])
        out = np.empty(counts.sum(), "<u4")
        starts = np.cumsum(counts) - counts
        for pieces, ids in ended:
            out[spans(starts[pieces], counts[pieces])] = ids
        return counts, out


class WordTokens:
    """Ids of words without white space, as little-endian 32-bit numbers.

    The tokenizer drops white space and never joins over it, so a text's ids are those of its words. Words of plain
    characters are cut into the tokenizer's own pieces, which repeat far more often than whole words, and new pieces
    are merged many at a time; any other word goes to the tokenizer as it is. Tests compare both with the tokenizer.
    """

    # The pieces that the given tokenizer's pattern makes of lower-case text. Fixed values.
    PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+| ")
    # Composed characters that lower-case one by one and cannot hold a special token.
    PLAIN = regex.compile(r"[!-;=-~¡-¬®-ÿ]+")
    PLAIN_ASCII = np.array([0x21 <= b < 0x7F and b != 0x3C for b in range(256)])
    LETTERS = np.array([bytes([b]).isalpha() for b in range(256)])

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = Merges(json.loads(self.tokenizer.to_str())["model"])
        self.words = Generations()
        self.pieces = Generations()

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def merged(self, data: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each piece of ``lens`` bytes has, and the ids of all."""
        short = lens <= LONGEST
        if short.all():
            return self.merges.encode(data, lens)
        return in_order(
            (np.flatnonzero(short), *self.merges.encode(data[np.repeat(short, lens)], lens[short])),
            (np.flatnonzero(~short), *flat_ids([self.whole(x.decode()) for x in cut(data[np.repeat(~short, lens)], lens[~short])])),
        )

    def learn(self, data: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``merged`` of words: of letters only, a piece each; of plain characters, cut into pieces; or as the tokenizer has them."""
        words, begin = cut(data, lens), np.cumsum(lens) - lens
        alpha, plain = (np.logical_and.reduceat(kind[data], begin) for kind in (self.LETTERS, self.PLAIN_ASCII))
        for i in np.flatnonzero(~plain).tolist():
            plain[i] = self.PLAIN.fullmatch(words[i].decode()) is not None
        letters, mixed, other = (np.flatnonzero(x) for x in (alpha, plain & ~alpha, ~plain))
        lowered = b"".join([words[i] for i in letters.tolist()]).lower()
        text = b" ".join([words[i] for i in mixed.tolist()]).decode().lower()
        parts = self.PIECE.findall(text)  # all characters of the words, and the blanks between them
        pieces = np.frombuffer(lowered + text.encode(), np.uint8)
        sizes = np.fromiter(map(len, parts if text.isascii() else map(str.encode, parts)), np.int64, len(parts))
        sizes = np.concatenate([lens[letters], sizes])
        starts = np.cumsum(sizes) - sizes
        blank = pieces[starts] == 0x20
        owner = np.concatenate([np.arange(len(letters)), len(letters) + np.cumsum(blank[len(letters) :])])[~blank]
        counts, ids = self.pieces.ids_of(pieces, starts[~blank], sizes[~blank], self.merged)
        counts = np.bincount(owner, counts, len(letters) + len(mixed)).astype(np.int64)
        wholes = flat_ids([self.whole(words[i].decode()) for i in other.tolist()])
        return in_order((np.concatenate([letters, mixed]), counts, ids), (other, *wholes))

    def ids_of(self, texts: list[bytes]) -> list[np.ndarray]:
        """All ids of each text and the end id."""
        data = np.frombuffer(b"\n".join([b"", *texts, b""]), np.uint8)
        apart = WHITE[data]
        starts, stops = np.flatnonzero(apart[:-1] & ~apart[1:]) + 1, np.flatnonzero(~apart[:-1] & apart[1:]) + 1
        del apart
        lens = stops - starts
        words = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]))  # before the end of each text
        size = np.cumsum(np.minimum(lens, LONGEST))
        cuts = [0, *np.searchsorted(size, np.arange(GROUP_BYTES, size[-1], GROUP_BYTES)).tolist(), len(lens)] if len(lens) else []
        groups = [self.words.ids_of(data, starts[a:b], lens[a:b], self.learn) for a, b in zip(cuts, cuts[1:])]
        ids = np.concatenate([NO_IDS, *(g[1] for g in groups)])
        at = np.concatenate([[0], *(g[0] for g in groups)]).cumsum()[words].tolist()
        return [np.append(ids[a:b], NO_IDS.dtype.type(END_ID)) for a, b in zip([0, *at], at)]


def flat_ids(each: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.array([len(x) >> 2 for x in each], np.int64), np.frombuffer(b"".join(each), "<u4")


def in_order(*parts: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Of (places, counts, ids): counts by place, and the ids in this order."""
    places, counts, ids = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(places)
    return counts[order], ids[spans((np.cumsum(counts) - counts)[order], counts[order])]


def cut(data: np.ndarray, lens: np.ndarray) -> list[bytes]:
    blob, ends = data.tobytes(), np.cumsum(lens).tolist()
    return [blob[a:b] for a, b in zip([0, *ends], ends)]


def spans(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each span, one after the other."""
    return np.repeat(starts - (np.cumsum(lens) - lens), lens) + np.arange(lens.sum())


class Known:
    """Strings and their ids, in flat arrays in the order they came. The place of a string is found by its hash."""

    def __init__(self):
        self.hashes, self.place = np.zeros(0, U64), np.zeros(0, np.int32)  # by hash
        self.data, self.starts, self.lens = np.zeros(0, np.uint8), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.ids, self.id_starts, self.counts = NO_IDS, np.zeros(0, np.int32), np.zeros(0, np.int32)

    def __len__(self) -> int:
        return len(self.lens)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The place of what has each hash, or -1."""
        if not len(self):
            return np.full(len(hashes), -1, np.int32)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self) - 1)
        return np.where(self.hashes[at] == hashes, self.place[at], np.int32(-1))

    def add(self, hashes: np.ndarray, data: np.ndarray, lens: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """Strings with ascending hashes that are not here yet."""
        at = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, at, hashes)
        self.place = np.insert(self.place, at, np.arange(len(self), len(self) + len(lens)))
        for name, more in (
            ("starts", len(self.data) + np.cumsum(lens) - lens), ("lens", lens), ("data", data),
            ("id_starts", len(self.ids) + np.cumsum(counts) - counts), ("counts", counts), ("ids", ids),
        ):
            own = getattr(self, name)
            setattr(self, name, np.concatenate([own, more.astype(own.dtype)]))

    def take(self, place: np.ndarray) -> tuple:
        """What ``add`` wants besides the hashes."""
        lens, counts = self.lens[place], self.counts[place]
        return self.data[spans(self.starts[place], lens)], lens, self.ids[spans(self.id_starts[place], counts)], counts


class Generations:
    """A bounded cache: when the young entries are too many they become the old ones, and the old ones go.

    Whatever is met again while it is old becomes young, so frequent entries stay. Long strings are not kept, nor are
    those whose hash is that of another: what was found is compared byte by byte.
    """

    def __init__(self):
        self.young, self.old = Known(), Known()

    def ids_of(self, data: np.ndarray, starts: np.ndarray, lens: np.ndarray, learn: Callable) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each string data[start : start + len] has, and the ids of all; ``learn`` tells both of new strings."""
        place = np.full(len(lens), -1)
        short = lens <= LONGEST
        if short.all():
            place = self.meet(data, starts, lens, learn)
        elif short.any():
            place[short] = self.meet(data, starts[short], lens[short], learn)
        at, counts, pool = self.young.id_starts, self.young.counts, self.young.ids
        if (apart := np.flatnonzero(place < 0)).size:
            strings = [data[s : s + n].tobytes() for s, n in zip(starts[apart].tolist(), lens[apart].tolist())]
            distinct = {x: i for i, x in enumerate(dict.fromkeys(strings), len(counts))}
            place[apart] = [distinct[x] for x in strings]
            more, ids = learn(np.frombuffer(b"".join(distinct), np.uint8), np.array([*map(len, distinct)]))
            at = np.concatenate([at, len(pool) + np.cumsum(more) - more])
            counts, pool = np.concatenate([counts, more]), np.concatenate([pool, ids])
        counts = counts[place].astype(np.int64)
        ids = pool[spans(at[place], counts)]
        if len(self.young) > CACHE_ENTRIES:
            self.old, self.young = self.young, Known()
        return counts, ids

    def meet(self, data: np.ndarray, starts: np.ndarray, lens: np.ndarray, learn: Callable) -> np.ndarray:
        """The place of each string among the young, where unknown ones are put; -1 if another string has its hash."""
        lens = lens.astype(np.int32)
        begin = np.cumsum(lens) - lens
        inside = spans(np.zeros(len(lens), np.int32), lens).astype(np.int32)
        letters = data[np.repeat((starts - begin).astype(np.int64), lens) + np.arange(len(inside))]
        hashes = np.add.reduceat((letters.astype(U64) + U64(1)) * WEIGHTS[inside], begin)
        distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        new = np.flatnonzero(self.young.find(distinct) < 0)
        if len(new):
            old = self.old.find(distinct[new])
            again = old >= 0
            self.young.add(distinct[new[again]], *self.old.take(old[again]))
            new = new[~again]
            if len(new):
                size = lens[first[new]]
                strings = data[spans(starts[first[new]], size)]
                counts, ids = learn(strings, size)
                self.young.add(distinct[new], strings, size, ids, counts)
        place = self.young.find(distinct)[back]
        there = np.take(self.young.data, np.repeat(self.young.starts[place], lens) + inside, mode="clip")
        same = (there == letters).all() and (self.young.lens[place] == lens).all()
        return place if same else np.where(np.logical_and.reduceat(there == letters, begin) & (self.young.lens[place] == lens), place, np.int32(-1))


@lru_cache(maxsize=2)
def word_tokens(path: str) -> WordTokens:
    return WordTokens(path)


# Words stay known from one packing task to the next, but not while a worker does other work.
kept_between_tasks(word_tokens.cache_clear)


# --- placing ---


class Packer:
    """Open windows of one task; ``place`` returns the windows that got full."""

    def __init__(self, window: int, open_windows: int):
        self.window, self.most = window, open_windows
        self.open: list[tuple[int, list]] = []  # (ids so far, pieces)

    def place(self, doc: tuple, start: int, ids: np.ndarray) -> Iterator[list]:
        """``doc`` is (doc_id, doc_tokens); a piece is (doc, start, ids)."""
        while len(ids) >= self.window:
            yield [(doc, start, ids[: self.window])]
            start, ids = start + self.window, ids[self.window :]
        while len(ids):
            fitting = [i for i, (n, _) in enumerate(self.open) if n + len(ids) <= self.window]
            if fitting:
                best = max(fitting, key=lambda i: self.open[i][0])
                n, pieces = self.open[best]
                pieces.append((doc, start, ids))
                self.open[best] = (n + len(ids), pieces)
                if n + len(ids) == self.window:
                    yield self.open.pop(best)[1]
                return
            if len(self.open) < self.most:
                self.open.append((len(ids), [(doc, start, ids)]))
                return
            fullest = max(range(len(self.open)), key=lambda i: self.open[i][0])
            n, pieces = self.open.pop(fullest)
            head = self.window - n
            yield [*pieces, (doc, start, ids[:head])]
            start, ids = start + head, ids[head:]


def _rows(pieces: list, sequence: int | None, home: int | None) -> Iterator[dict]:
    """``sequence`` for a finished window; otherwise ``home`` tells where the open rest is merged."""
    offset = 0
    for (doc_id, tokens), start, ids in pieces:
        data = np.ascontiguousarray(ids).tobytes()
        yield {
            "doc_id": doc_id, "start": start, "length": len(ids), "ids_crc32": zlib.crc32(data), "doc_tokens": tokens,
            "sequence_id": sequence, "offset": offset if sequence is not None else None,
            "ids": data if sequence is None else None, "home": home,
        }
        offset += len(ids)


def _frame(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return batch_of({f.name: [r[f.name] for r in rows] for f in schema}, schema)


def powers_of_two(n: int) -> list[int]:
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, open_windows: int = OPEN_WINDOWS) -> DataFrame:
    """One row for each piece of a document: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``window`` is a power of two. A null or empty text has the end id only; texts of any length are cut; repeated rows
    and null ids are documents like others; an empty table gives no rows. ``tokenizer`` is a file that every
    executor reaches.
    """
    if window & (window - 1):
        raise ValueError("the window must be a power of two")
    spark = docs.sparkSession
    schema = arrow_schema(spark, PIECES)

    def first(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, packer, home, done, rows = word_tokens(tokenizer), Packer(window, open_windows), partition_number(), 0, []
        for doc_ids, texts in gather(frames):
            for doc_id, ids in zip(doc_ids, words.ids_of(texts)):
                for full in packer.place((doc_id, len(ids)), 0, ids):
                    rows.extend(_rows(full, home << 28 | done, None))
                    done += 1
            yield _frame(rows, schema)
            rows = []
        for _, pieces in packer.open:
            rows.extend(_rows(pieces, None, home))
        yield _frame(rows, schema)

    placed = save(texts_as_bytes(docs).mapInArrow(trimmed(first, keep=True), PIECES), "packed")
    finished = [placed.where("sequence_id is not null").select(*OUT)]
    homes = (placed.agg(F.max("home")).first()[0] or 0) + 1
    level = 1
    rest = placed.where("sequence_id is null")
    while True:
        groups = -(-homes // FAN_IN)
        merged = save(_merge(rest, level, groups == 1, window), f"merged-{level}")
        finished.append(merged.where("sequence_id is not null").select(*OUT))
        if groups == 1:
            break
        rest, homes, level = merged.where("sequence_id is null"), groups, level + 1
    out = finished[0]
    for part in finished[1:]:
        out = out.unionByName(part)
    return out


def _merge(rest: DataFrame, level: int, last: bool, window: int) -> DataFrame:
    """Join the open windows of ``FAN_IN`` homes end to end and cut full windows off."""
    schema = arrow_schema(rest.sparkSession, PIECES)

    def merge(group: pa.Table) -> pa.Table:
        pieces = sorted(
            group.to_pylist(), key=lambda r: (r["home"], r["doc_id"] is None, r["doc_id"] or 0, r["start"], r["ids_crc32"])
        )
        home, done, rows, packer = pieces[0]["home"] // FAN_IN, 0, [], Packer(window, 1)

        def finish(full: list) -> None:
            nonlocal done
            rows.extend(_rows(full, level << 56 | home << 28 | done, None))
            done += 1

        for p in pieces:
            for full in packer.place((p["doc_id"], p["doc_tokens"]), p["start"], np.frombuffer(p["ids"], "<u4")):
                finish(full)
        for size, left in packer.open:
            if not last:
                rows.extend(_rows(left, None, home))
                continue
            for part in powers_of_two(size):
                cut = []
                while part:
                    doc, start, ids = left.pop(0)
                    if len(ids) > part:
                        left.insert(0, (doc, start + part, ids[part:]))
                        ids = ids[:part]
                    cut.append((doc, start, ids))
                    part -= len(ids)
                finish(cut)
        return pa.Table.from_batches([_frame(rows, schema)])

    return rest.groupBy(F.floor(F.col("home") / FAN_IN).alias("group")).applyInArrow(merge, PIECES)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), default_tokenizer())
