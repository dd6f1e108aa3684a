"""Language ID: script ranges narrow the candidates, Viterbi with a switching penalty labels the spans of a text.

Each word is scored under every language whose training letters use the word's script. A word's score is the mean log
probability of its character n-grams (1 to 4 letters, with word ends) and of the whole word, all hashed
to ``BUCKETS``; the mean is weighted by the square root of the word's length. The best sequence of languages, where each change
costs ``SWITCH``, labels every word; spans are runs of one label.

Counts come from all distinct training texts of each language, read whole; prediction covers all rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import U64, arrow_schema, batch_of, limit_frames, mix, pack, rolling, table, trimmed, unpack

BUCKETS = 1 << 16
ORDERS = (1, 2, 3, 4)
SWITCH = 6.0
SMOOTHING = 0.5
# A script counts as one of a language's if it holds at least this share of its training letters.
SCRIPT_SHARE = 0.01
# Entries of a worker's cache of word scores.
CACHE_ENTRIES = 400_000
# Texts that are labelled, and new words that are scored, at a time.
TEXTS_AT_ONCE = 300
WORDS_AT_ONCE = 8192
# Distinct words of all languages that a task of the fit counts before it splits them into n-grams.
FIT_WORDS = 100_000

# First code points of script ranges; letters outside all of them are "other".
SCRIPTS = (
    ("latin", 0x41, 0x24F), ("latin", 0x1E00, 0x1EFF), ("greek", 0x370, 0x3FF), ("greek", 0x1F00, 0x1FFF), ("cyrillic", 0x400, 0x52F),
    ("armenian", 0x531, 0x58F), ("hebrew", 0x591, 0x5F4), ("arabic", 0x600, 0x77F), ("devanagari", 0x900, 0x97F), ("bengali", 0x980, 0x9FF),
    ("tamil", 0xB80, 0xBFF), ("thai", 0xE01, 0xE5B), ("georgian", 0x10A0, 0x10FF), ("hangul", 0x1100, 0x11FF), ("kana", 0x3041, 0x30FF),
    ("han", 0x3400, 0x9FFF), ("hangul", 0xAC00, 0xD7AF),
)
SCRIPT_NAMES = tuple(dict.fromkeys(name for name, _, _ in SCRIPTS)) + ("other",)
_STARTS = np.array([s for _, s, _ in sorted(SCRIPTS, key=lambda r: r[1])])
_STOPS = np.array([e for _, _, e in sorted(SCRIPTS, key=lambda r: r[1])])
_NUMBERS = np.array([SCRIPT_NAMES.index(n) for n, _, _ in sorted(SCRIPTS, key=lambda r: r[1])])

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """Runs of letters, lower-cased."""
    return _WORD.findall(text.lower())


def scripts_of(codes: np.ndarray) -> np.ndarray:
    at = np.searchsorted(_STARTS, codes, side="right") - 1
    inside = (at >= 0) & (codes <= _STOPS[np.maximum(at, 0)])
    return np.where(inside, _NUMBERS[np.maximum(at, 0)], len(SCRIPT_NAMES) - 1)


@dataclass
class Grams:
    """Hashed n-grams of distinct words, end to end."""

    buckets: np.ndarray
    word: np.ndarray
    letters: np.ndarray
    scripts: np.ndarray  # number of letters of each script, one row for each word


def grams_of(words: list[str]) -> Grams:
    codes = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    lengths = np.array([len(w) + 2 for w in words])
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(words)), lengths)
    hashed = mix(codes.astype(U64) + U64(1))
    buckets, word = [], []
    place = np.arange(len(codes))
    for n in ORDERS:
        if len(codes) < n:
            continue
        inside = np.flatnonzero(place + n <= ends[owner])
        if n == 1:  # word ends alone say nothing
            inside = inside[codes[inside] > 3]
        buckets.append((rolling(hashed, n)[inside] ^ U64(n)) % U64(BUCKETS))
        word.append(owner[inside])
    sums = np.concatenate((np.zeros(1, U64), np.cumsum(hashed * mix((place - (ends - lengths)[owner] + 7).astype(U64)))))
    buckets.append(mix(sums[ends] - sums[ends - lengths]) % U64(BUCKETS))
    word.append(np.arange(len(words)))
    letter = codes > 3
    scripts = np.zeros((len(words), len(SCRIPT_NAMES)), np.int64)
    np.add.at(scripts, (owner[letter], scripts_of(codes[letter])), 1)
    return Grams(np.concatenate(buckets).astype(np.int64), np.concatenate(word), lengths - 2, scripts)


class Model:
    """Log probabilities of buckets by language, and the scripts of each language."""

    def __init__(self, languages: list[str], counts: np.ndarray, scripts: np.ndarray):
        """``counts``: languages x buckets; ``scripts``: languages x letters of each script."""
        self.languages = languages
        smooth = counts + SMOOTHING
        self.log_p = np.log(smooth / smooth.sum(axis=1, keepdims=True)).T.astype(np.float32).copy() if languages else np.zeros((BUCKETS, 0), np.float32)
        total = np.maximum(scripts.sum(axis=1, keepdims=True), 1)
        self.uses = scripts >= SCRIPT_SHARE * total  # languages x scripts
        self.cache: dict[str, int] = {}
        self.scores = np.zeros((0, len(languages)), np.float32)
        self.letters = np.zeros(0, np.int64)

    def forget(self) -> None:
        """Drop the cached words: the model outlives a task in the worker that has read it."""
        self.cache.clear()
        self.scores, self.letters = self.scores[:0].copy(), self.letters[:0].copy()

    def rows(self, words: list[str]) -> np.ndarray:
        """Row of each word in ``scores`` and ``letters``."""
        get = self.cache.get
        found = list(map(get, words))
        if None in found:
            new = list({w for w, f in zip(words, found) if f is None})
            if len(self.cache) + len(new) > CACHE_ENTRIES:
                self.forget()
                new = list(set(words))
            base = len(self.letters)
            parts = [self.score(new[i : i + WORDS_AT_ONCE]) for i in range(0, len(new), WORDS_AT_ONCE)]
            self.cache.update(zip(new, range(base, base + len(new))))
            self.scores = np.concatenate((self.scores, *[scores for scores, _ in parts]))
            self.letters = np.concatenate((self.letters, *[letters for _, letters in parts]))
            found = list(map(self.cache.__getitem__, words))
        return np.array(found, np.int64)

    def score(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        grams = grams_of(words)
        order = np.argsort(grams.word, kind="stable")
        owner, values = grams.word[order], self.log_p[grams.buckets[order]]
        starts = np.searchsorted(owner, np.arange(len(words)))
        counts = np.bincount(owner, minlength=len(words))
        mean = np.add.reduceat(values, starts, axis=0) / counts[:, None]
        # candidates: languages that use the script of most of the word's letters; all, if none does
        allowed = self.uses.T[grams.scripts.argmax(axis=1)]
        allowed = allowed | ~allowed.any(axis=1, keepdims=True)
        mean -= np.where(allowed, mean, -np.inf).max(axis=1, keepdims=True)
        mean = np.where(allowed, mean, -20.0)
        letters = np.array([sum(c.isalpha() for c in w) for w in words], np.int64)
        return (mean * np.sqrt(np.maximum(letters, 1))[:, None]).astype(np.float32), letters


def best_paths(scores: np.ndarray, starts: np.ndarray, counts: np.ndarray, switch: float) -> np.ndarray:
    """Viterbi over every text at once: the language of each word. Texts lie end to end in ``scores``."""
    labels = np.zeros(len(scores), np.int64)
    if not len(scores):
        return labels
    order = np.argsort(-counts, kind="stable")
    starts, counts = starts[order], counts[order]
    width = scores.shape[1]
    stay = np.zeros((len(scores), width), bool)  # whether the best way into a language comes from itself
    jump = np.zeros(len(scores), np.int64)  # otherwise it comes from here
    alive = np.searchsorted(-counts, -np.arange(counts[0]), side="left")  # texts longer than t words
    state = np.zeros((len(counts), width), np.float32)
    for t in range(int(counts[0])):
        n = alive[t]
        at = starts[:n] + t
        s = state[:n]
        top = s.argmax(axis=1)
        reach = s[np.arange(n), top][:, None] - np.float32(switch)
        keep = s >= reach
        stay[at], jump[at] = keep, top
        s = np.where(keep, s, reach) + scores[at]
        state[:n] = s - s.max(axis=1, keepdims=True)
    last = state.argmax(axis=1)
    for t in range(int(counts[0]) - 1, -1, -1):
        n = alive[t]
        at = starts[:n] + t
        here = last[:n]
        labels[at] = here
        last[:n] = np.where(stay[at, here], here, jump[at])
    return labels


def predict(model: Model, texts: list[str]) -> list[tuple[str, float, list[tuple[int, int, str]]]]:
    """(language, score, spans) of each text; a span is (first word, last word, language).

    The language is that of most letters, of several the first by name; the score is its share of the letters. A text without a
    letter, or a model without languages, gives ``und`` and 0.
    """
    words = [words_of(t) for t in texts]
    counts = np.array([len(w) for w in words], np.int64)
    if not counts.sum() or not model.languages:
        return [("und", 0.0, [])] * len(texts)
    rows = model.rows([w for own in words for w in own])
    starts = np.cumsum(counts) - counts
    held = counts > 0
    labels = best_paths(model.scores[rows], starts[held], counts[held], SWITCH)
    letters = model.letters[rows]
    out = []
    for start, n in zip(starts.tolist(), counts.tolist()):
        own, weight = labels[start : start + n], letters[start : start + n]
        share = np.bincount(own, weight, len(model.languages)) if n else np.zeros(1)
        if not share.sum():
            out.append(("und", 0.0, []))
            continue
        cuts = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), n]
        spans = [(a, b - 1, model.languages[own[a]]) for a, b in zip(cuts, cuts[1:])]
        best = int(share.argmax())
        out.append((model.languages[best], float(share[best] / share.sum()), spans))
    return out


def fit(training: DataFrame, rows_per_language: int | None = None) -> Model:
    """Counts from the distinct (text, lang); rows without either are left out.

    All texts count, unless a caller gives a number of texts of each language, about, which are then chosen by a hash.
    """
    spark = training.sparkSession
    limit_frames(spark)
    known = training.where("text is not null and lang is not null").select("lang", "text")
    texts = known.select("lang", F.xxhash64("text").alias("h")).distinct()
    sizes = {r["lang"]: r["n"] for r in texts.groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").collect()}  # a row for each language
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((0, BUCKETS)), np.zeros((0, len(SCRIPT_NAMES))))
    if rows_per_language is not None:
        # the share of each language's texts, by the text's hash: the same texts whatever the partitions, and copies once
        share = F.element_at(F.create_map(*[x for lang in languages for x in (F.lit(lang), F.lit(min(1.0, rows_per_language / sizes[lang])))]), F.col("lang"))
        known = known.where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < share * 1_000_000)
    schema = arrow_schema(spark, "lang string, counts binary, scripts binary")

    def count(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, list[np.ndarray]] = {}
        met: dict[str, Counter] = {}

        def settle() -> None:
            for lang, found in met.items():
                own = sums.setdefault(lang, [np.zeros(BUCKETS, np.int64), np.zeros(len(SCRIPT_NAMES), np.int64)])
                words, times = list(found), np.fromiter(found.values(), np.int64, len(found))
                for at in range(0, len(words), WORDS_AT_ONCE):
                    grams, n = grams_of(words[at : at + WORDS_AT_ONCE]), times[at : at + WORDS_AT_ONCE]
                    own[0] += np.bincount(grams.buckets, n[grams.word], BUCKETS).astype(np.int64)
                    own[1] += n @ grams.scripts
            met.clear()

        for frame in frames:
            for lang, text in zip(frame.column("lang").to_pylist(), frame.column("text").to_pylist()):
                words = words_of(text)
                if words:
                    met.setdefault(lang, Counter()).update(words)
            if sum(map(len, met.values())) > FIT_WORDS:
                settle()
        settle()
        yield batch_of({"lang": list(sums), "counts": [pack(v[0]) for v in sums.values()], "scripts": [pack(v[1]) for v in sums.values()]}, schema)

    def add(group: pa.Table) -> pa.Table:
        total = [sum(unpack(x, np.int64) for x in group.column(c).to_pylist()) for c in ("counts", "scripts")]
        return pa.Table.from_batches([batch_of({"lang": [group.column("lang")[0].as_py()], "counts": [pack(total[0])], "scripts": [pack(total[1])]}, schema)])

    names = "lang string, counts binary, scripts binary"
    summed = known.distinct().mapInArrow(trimmed(count), names).groupBy("lang").applyInArrow(add, names).collect()  # languages x buckets numbers
    counts, scripts = np.zeros((len(languages), BUCKETS)), np.zeros((len(languages), len(SCRIPT_NAMES)))
    for r in summed:
        counts[languages.index(r["lang"])] = unpack(r["counts"], np.int64)
        scripts[languages.index(r["lang"])] = unpack(r["scripts"], np.int64)
    return Model(languages, counts, scripts)


def identify(docs: DataFrame, model: Model, text_column: str = "text", prefix: str = "llm_") -> DataFrame:
    """All columns of ``docs``, and ``llm_lang``, ``llm_score``, ``llm_spans`` (first and last word, language).

    Null and empty texts, and texts without letters, are ``und`` with score 0 and no spans; repeated rows are each labelled; an empty table
    gives no rows. Columns of any other name pass through; where ``docs`` has one of these three names, give another ``prefix``.
    """
    spark = docs.sparkSession
    limit_frames(spark)
    shared = spark.sparkContext.broadcast(model)  # languages x buckets numbers, whatever the corpus
    ddl = f"{prefix}lang string, {prefix}score double, {prefix}spans array<struct<first: int, last: int, lang: string>>"
    added = arrow_schema(spark, ddl)
    schema = spark.createDataFrame([], ddl).schema
    if {f.name for f in schema} & set(docs.columns):
        raise ValueError(f"the table has columns that begin with {prefix} already")
    for f in reversed(docs.schema.fields):
        schema.fields.insert(0, f)
        schema.names.insert(0, f.name)
    at = docs.columns.index(text_column)

    def run(frames: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            step = TEXTS_AT_ONCE
            for start in range(0, frame.num_rows, step):
                part = frame.slice(start, step)
                found = predict(shared.value, [t or "" for t in part.column(at).to_pylist()])
                new = batch_of(
                    {
                        f"{prefix}lang": [f[0] for f in found], f"{prefix}score": [f[1] for f in found],
                        f"{prefix}spans": [[{"first": a, "last": b, "lang": lang} for a, b, lang in f[2]] for f in found],
                    },
                    added,
                )
                yield pa.RecordBatch.from_arrays([*part.columns, *new.columns], names=schema.names)
        shared.value.forget()

    # Columns go to Python by their places, whatever they are called.
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]).mapInArrow(trimmed(run), schema)


def held_out(modulus: int, remainder: int):
    """Whether crc32 of the doc_id as text leaves the remainder; false for a null doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row; null and letterless texts are ``und`` with score 0."""
    docs = table(spark, sf_dir, "documents")
    tested = held_out(4, 2)
    model = fit(docs.where(~tested).select("text", "lang"))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", tested.alias("held_out"), F.col("llm_lang").alias("lang_pred"), F.col("llm_score").alias("score"))
