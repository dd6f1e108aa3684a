"""The pipeline's language stage keeps mixed texts, and all texts with letters if no row has a language."""

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_mixed_and_unlabelled_texts_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    parts = [docs.where(f"lang = '{x['lang']}' and n_chars > 400").orderBy("doc_id").first()["text"][:400] for x in docs.select("lang").distinct().collect()]
    assert len(parts) >= 3
    mixed = spark.createDataFrame([(9000, " 1 ".join(parts), None, "x", 1600), (9001, "12 34 !!", None, "x", 8), (9002, None, None, "x", 0)], docs.schema)
    kept = corpus_pipeline.keep_known_languages(spark, docs.unionByName(mixed), SF)
    assert {r["doc_id"] for r in kept.collect() if r["doc_id"] >= 9000} == {9000}
    unlabelled = docs.unionByName(mixed).selectExpr("doc_id", "text", "cast(null as string) lang", "source", "n_chars")
    kept = corpus_pipeline.keep_known_languages(spark, unlabelled, SF)
    assert kept.count() == docs.count() + 1
