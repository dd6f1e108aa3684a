"""Documents to packed sequences: language ID, near duplicates, repeated passages, benchmark leaks, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the next one's
documents; the tables it made on the way are deleted then. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import language_id, latent_leaks, ngram_join, packing, suffix_dedup
from riskloom.llm.common import quoted, save_alone, table

# Near duplicates: five-word shingles, similarity of 0.8 or more.
SHINGLE_WORDS = 5
SIMILARITY = (8, 10)
# Words of a repeated passage, if they end within the 400 bytes that count else.
PASSAGE_WORDS = 50


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with letters, mixed ones too; the model learns from the labelled rows. Without any, all texts with letters stay.

    Null and empty texts go, repeated rows and null ids stay; an empty table stays empty; columns of any names pass through.
    """
    model = language_id.fit(docs.select("text", "lang"))
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    prefix = "llm_"
    while any(f"{prefix}{name}" in docs.columns for name in ("lang", "score", "spans")):
        prefix = "_" + prefix
    found = language_id.identify(docs, model, prefix=prefix)
    return found.where(F.col(f"{prefix}lang") != "und").select(*[F.col(quoted(c)) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of alike ones, that with the least doc_id.

    Rows without words stay, null texts among them; of rows that share doc_id and text one stays; an empty table stays
    empty; columns of any names pass through.
    """
    return ngram_join.one_of_each(docs, SHINGLE_WORDS, *SIMILARITY)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without strings of 50 words, or 400 bytes if shorter, that stand elsewhere too; n_chars follows; texts without a word left go.

    Null and short texts stay; repeated rows lose the same bytes; an empty table stays empty; columns of any names pass through.
    """
    return suffix_dedup.without_repeats(docs, words=PASSAGE_WORDS)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Null and empty texts and repeated clean rows stay; columns of any names pass through."""
    return latent_leaks.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 tokens. A null or empty text has its end id only; other columns are not read."""
    return packing.pack(docs, packing.default_tokenizer())


STAGES = [
    ("language ID", keep_known_languages),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("suffix-array dedup", drop_repeated_passages),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("packing", pack_sequences),
]

# SQL has neither the language model nor the tokenizer; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = save_alone(spark, name.replace(" ", "-"), partial(stage, spark, docs, sf_dir))
    return docs
