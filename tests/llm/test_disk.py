"""Tables that an operator writes on its way do not outlive the last one that reads them."""

import os

from riskloom.llm import ngram_join, suffix_dedup
from riskloom.llm.common import save, save_alone
from riskloom.sources.stored import shared_dir

SHARED = "".join(chr(97 + i * i % 23) + " " * (i % 5 == 0) for i in range(600))
ROWS = [(1, "first " + SHARED), (2, "second words " + SHARED + " and more"), (3, "none of it"), (4, None), (5, "none of it")]


def tables_left(spark, run):
    """Names of the tables in the shared folder that are there after ``run()`` and were not before, and its rows."""
    folder = f"{shared_dir(spark).removeprefix('file:')}/{spark.sparkContext.applicationId}"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    rows = run().collect()
    return sorted(name.rsplit("-", 1)[0] for name in set(os.listdir(folder)) - before), rows


def test_tables_on_the_way_are_deleted(spark):
    def build():
        return save(save(spark.range(5), "one"), "two").where("id > 2")

    left, rows = tables_left(spark, lambda: save_alone(spark, "alone", build))
    assert left == ["alone"] and sorted(r["id"] for r in rows) == [3, 4]


def test_suffix_dedup_leaves_its_last_tables(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    left, rows = tables_left(spark, lambda: suffix_dedup.without_repeats(docs))
    assert left == ["changed-texts"]
    assert {r["doc_id"]: len(r["text"] or "") < 40 for r in rows} == dict.fromkeys(range(1, 6), True)
    left, rows = tables_left(spark, lambda: suffix_dedup.digest(docs))
    assert left == ["anchors", "repeated-bytes"]
    assert {r["doc_id"] for r in rows if r["n_removed"]} == {1, 2}


def test_ngram_join_leaves_its_last_table(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    left, rows = tables_left(spark, lambda: ngram_join.one_of_each(docs, 5, 8, 10))
    assert left == ["dropped"] and sorted(r["doc_id"] for r in rows) == [1, 3, 4]  # 2 is like 1, 5 equals 3
    left, _ = tables_left(spark, lambda: ngram_join.join(docs, 3, 90, 100))
    assert left == ["members"]
