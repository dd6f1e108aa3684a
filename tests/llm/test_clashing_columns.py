"""Stages on documents whose extra columns have the names that the operators use inside."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskloom.llm import language_id

SF = "/root/testdata/sf0.001"
NAMES = [
    "_id", "_key", "_text", "_changed", "_stays", "_copies", "_hash", "hash", "stays", "llm_lang", "llm_score", "llm_spans", "_llm_lang",
    "component", "component_id", "node", "kept", "batch", "doc_ids", "lens", "blob", "data", "x", "found", "size", "key", "own", "new", "text_key", "a.b",
]


@pytest.fixture(scope="module")
def plain(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(9000, None, None, "x", 0), (9001, "", "en", None, None), (None, "some words of no one", "en", "x", 20)], docs.schema)
    return docs.unionByName(odd).unionByName(docs.where("doc_id % 9 = 0"))


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES[:4]])
def test_extra_columns_pass_through(spark, plain, stage):
    wide = plain.select("*", *[F.concat_ws("/", F.lit(n), F.col("doc_id")).alias(n) for n in NAMES])
    out = stage(spark, wide, SF)
    assert out.columns == wide.columns
    rows = out.collect()
    for r in rows:
        assert all(r[n] == "/".join(str(x) for x in (n, r["doc_id"]) if x is not None) for n in NAMES)
    expected = stage(spark, plain, SF).collect()
    own = sorted((tuple(r[c] for c in plain.columns) for r in rows), key=repr)
    assert own == sorted((tuple(r) for r in expected), key=repr)


def test_packing_reads_its_columns_only(spark, plain):
    wide = plain.limit(20).withColumns({n.replace(".", ""): F.lit(7) for n in [*NAMES, "start", "length", "home", "sequence_id", "offset"]})
    assert corpus_pipeline.pack_sequences(spark, wide, SF).count() > 0


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_empty_tables(spark, plain, stage):
    assert stage(spark, plain.limit(0), SF).count() == 0


def test_a_taken_prefix_is_an_error(spark, plain):
    model = language_id.fit(plain.select("text", "lang"))
    with pytest.raises(ValueError):
        language_id.identify(plain.withColumn("llm_score", F.lit(1)), model)
    assert "mine_lang" in language_id.identify(plain.withColumn("llm_score", F.lit(1)), model, prefix="mine_").columns
