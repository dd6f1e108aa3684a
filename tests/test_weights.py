import gzip
import os
import random

import pytest
from pyspark.sql import functions as F

from riskloom.operators import intervals, weights
from riskloom.plans import score_models
from riskloom.schema import EmptyInputError, SchemaError
from riskloom.sources import readers, stored


def test_headings_have_an_order_of_preference():
    got = weights.resolve_headings(["chr", "hm_chr", "position", "hm_pos", "A1", "beta", "OR"])
    assert got == {"chr": "hm_chr", "bp": "hm_pos", "effect_allele": "A1", "weight": "beta"}
    with pytest.raises(SchemaError, match="weight"):
        weights.resolve_headings(["chr", "pos", "allele"])


def test_cleaning(spark):
    rows = [
        ("1", "100", "A", "0.5", "keeps"),
        ("chr1", "101.0", "A", "-1e-3", "keeps"),
        ("1.0", "102", "A", "1", "keeps"),
        ("X", "103", "AT", "1", "keeps"),
        ("M", "104", "A", "1", "keeps"),
        (" 1", "105", "A", "1", "not a known contig"),
        ("23", "106", "A", "1", "not a known contig"),
        ("CHR1", "107", "A", "1", "not a known contig"),
        (None, "108", "A", "1", "null"),
        ("1", "NA", "A", "1", "position"),
        ("1", None, "A", "1", "position"),
        ("1", "110", " ", "1", "blank allele"),
        ("1", "111", "nan", "1", "missing allele"),
        ("1", "112", "A", "x", "weight"),
        ("1", "113", "A", "inf", "weight"),
        ("1", "114", "A", "NaN", "weight"),
        ("1", "115", "A", "1d", "weight"),
        ("", "116", "A", "1", "blank contig"),
        ("1", "99999999999", "A", "1", "position out of range"),
    ]
    raw = spark.createDataFrame(rows, "chr string, pos string, allele string, beta string, why string")
    kept = weights.clean_weights(raw, ["why"]).orderBy("position").collect()
    assert [(r["contig"], r["position"], r["weight"]) for r in kept] == [
        ("chr1", 100, 0.5), ("chr1", 101, -0.001), ("chr1", 102, 1.0), ("chrX", 103, 1.0), ("chrM", 104, 1.0)
    ]
    assert {r["why"] for r in kept} == {"keeps"}
    report = {r["why"]: r for r in weights.cleaning_report(raw, ["why"]).collect()}
    assert report["not a known contig"]["n_unknown_contig"] == 3
    assert report["weight"]["n_incomplete"] == 4


def test_one_weight_per_locus(spark):
    rows = [("p", "chr1", 5, "A", 0.5, None), ("p", "chr1", 5, "C", -0.5, "T"), ("p", "chr1", 5, "A", -0.5, "T"),
            ("q", "chr1", 5, "G", 9.0, None)]
    df = spark.createDataFrame(
        rows, "prs_id string, contig string, position int, effect_allele string, weight double, other_allele string"
    )
    got = weights.one_weight_per_locus(df, ["prs_id"]).orderBy("prs_id").collect()
    assert [(r["prs_id"], r["effect_allele"], r["weight"], r["other_allele"]) for r in got] == [
        ("p", "A", -0.5, "T"), ("q", "G", 9.0, None)
    ]


def scoring_file(path, header, rows):
    with gzip.open(path, "wt") as f:
        f.write("###PGS SCORING FILE\n#genome_build=GRCh38\n")
        f.write("\t".join(header) + "\n")
        f.writelines("\t".join(r) + "\n" for r in rows)
    return str(path)


def test_manifest_survives_bad_models(spark, tmp_path):
    good = scoring_file(
        tmp_path / "a.txt.gz", ["hm_chr", "hm_pos", "effect_allele", "other_allele", "effect_weight"],
        [["1", "10", "A", "C", "0.5"], ["2", "11.0", "G", "T", "-2"], ["2", "NA", "G", "T", "-2"]],
    )
    other = scoring_file(tmp_path / "b.txt.gz", ["chromosome", "BP", "A1", "OR"], [["chr3", "7", "T", "1.25"]])
    lacking = scoring_file(tmp_path / "c.txt.gz", ["chr", "pos", "allele"], [["1", "2", "A"]])
    # Truncated in the middle, so that only reading all of it shows the damage.
    many = [["1", str(i), "ACGT"[i % 4], str(i * 7919 % 1000 / 64)] for i in range(1, 60000)]
    damaged = tmp_path / "e.txt.gz"
    scoring_file(damaged, ["chr", "pos", "allele", "beta"], many)
    damaged.write_bytes(damaged.read_bytes()[:-1000])
    rows = [("A", good, "x"), ("B", other, "x"), ("C", lacking, "x"), ("D", str(tmp_path / "absent.gz"), "x")]
    rows.append(("E", str(damaged), "x"))
    manifest = spark.createDataFrame(rows, "id string, url string, phenotype string")
    table, failed = score_models.load_weights(spark, manifest)
    got = sorted(tuple(r) for r in table.select("prs_id", "contig", "position", "effect_allele", "weight").collect())
    assert got == [("A", "chr1", 10, "A", 0.5), ("A", "chr2", 11, "G", -2.0), ("B", "chr3", 7, "T", 1.25)]
    assert sorted(r["prs_id"] for r in failed.collect()) == ["C", "D", "E"]
    with pytest.raises(EmptyInputError):
        score_models.load_weights(spark, manifest.where("id = 'D'"))


def test_weight_table_types_are_asserted(spark, tmp_path):
    df = spark.createDataFrame([("chr1", 5, "A", 1.0)], "contig string, position int, effect_allele string, weight double")
    df.write.parquet(str(tmp_path / "good"))
    assert readers.read_weights(spark, str(tmp_path / "good")).count() == 1
    df.withColumn("position", F.col("position").cast("long")).drop("weight").write.parquet(str(tmp_path / "bad"))
    with pytest.raises(SchemaError, match="position: bigint, expected int; weight: missing"):
        readers.read_weights(spark, str(tmp_path / "bad"))
    df.limit(0).write.parquet(str(tmp_path / "empty"))
    with pytest.raises(EmptyInputError):
        readers.read_weights(spark, str(tmp_path / "empty"))


def test_files_of_many_forms_in_one_scan(spark, tmp_path):
    head = "##format\n#author=x\n\n"
    (tmp_path / "a.txt").write_text(head + "hm_chr\thm_pos\teffect_allele\teffect_weight\tnote\n1\t10\tA\t0.5\tx\n2\t20\tC\tNA\ty\n")
    with gzip.open(tmp_path / "b.txt.gz", "wt") as f:
        f.write('# c\nbeta\tA1\t"chromosome"\tposition\tA2\n-0.25\tG\tchrX\t30.0\tT\n"1.5"\t"T"\t"3"\t"7"\t\n')
    folder = tmp_path / "c"
    folder.mkdir()
    (folder / "part-0").write_text("chr\tpos\tallele\tOR\n4\t1\tA\t1\n")
    (folder / "part-1").write_text("OR\tchr\tpos\tallele\n2\t4\t2\tC\n")
    (folder / "_SUCCESS").write_text("")
    (tmp_path / "d.txt.gz").write_bytes(b"not gzip")
    (tmp_path / "e.txt").write_text("chr\tpos\n1\t2\n")
    (tmp_path / "f.txt").write_text("# nothing\n")
    with gzip.open(tmp_path / "g.txt.gz", "wb") as f:
        f.write(b"chr\tpos\tallele\tOR\n" + b"4\t1\tA\t1\n" * 100_000)
    whole = (tmp_path / "g.txt.gz").read_bytes()
    (tmp_path / "g.txt.gz").write_bytes(whole[: len(whole) // 2])  # cut off
    rows = [(m, str(tmp_path / u), "x") for m, u in [
        ("A", "a.txt"), ("B", "b.txt.gz"), ("C", "c"), ("D", "d.txt.gz"), ("E", "e.txt"), ("F", "f.txt"), ("G", "g.txt.gz"), ("H", "absent"), ("I", "a.txt"),
    ]]
    manifest = spark.createDataFrame(rows, "id string, url string, phenotype string")
    table, failed = score_models.load_weights(spark, manifest)
    got = {(r["prs_id"], r["contig"], r["position"], r["effect_allele"], r["weight"], r["other_allele"]) for r in table.collect()}
    assert got == {
        ("A", "chr1", 10, "A", 0.5, None), ("I", "chr1", 10, "A", 0.5, None), ("B", "chrX", 30, "G", -0.25, "T"),
        ("B", "chr3", 7, "T", 1.5, None), ("C", "chr4", 1, "A", 1.0, None), ("C", "chr4", 2, "C", 2.0, None),
    }
    assert {r["prs_id"] for r in failed.collect()} == {"D", "E", "F", "G", "H"}


def test_temporary_tables_are_deleted(spark, tmp_path):
    def stored_names():
        folder = stored.new_path(spark, "x").rsplit("/", 1)[0].removeprefix("file://")
        return set(os.listdir(folder)) if os.path.isdir(folder) else set()

    outside = stored.store(spark.range(3), "outside")
    before = stored_names()
    with stored.temporary_tables(spark):
        inside = stored.store(spark.range(5), "inside")
        assert inside.df.count() == 5 and len(stored_names()) == len(before) + 1
    assert stored_names() == before and outside.df.count() == 3
    with pytest.raises(ZeroDivisionError), stored.temporary_tables(spark):
        stored.store(spark.range(5), "inside")
        1 / 0
    assert stored_names() == before


@pytest.mark.parametrize("row_limit", [0, 1000])
def test_interval_semi_join_equals_brute_force(spark, row_limit):
    rng = random.Random(3)
    # Long, nested, piled-up, inverted and single-base intervals; several variants at one position.
    spans = [("chr1", s, s + rng.choice([0, 0, 3, 40, 400, -5])) for s in (rng.randint(1, 5000) for _ in range(300))]
    spans += [("chr1", 2000, 2000 + i) for i in range(50)] + [("chr2", 100, 90), ("chr2", 0, 500), ("chr2", 3, 3)]
    spans += [(None, 1, 10000), ("chr3", 1, None)]
    variants = [(i, rng.choice(["chr1", "chr1", "chr2", "chr3"]), rng.randint(1, 6000)) for i in range(1500)]
    variants += [(1500 + i, "chr2", 3) for i in range(3)]
    got = intervals.interval_semi_join(
        spark.createDataFrame(variants, "variant_id int, contig string, position int"),
        spark.createDataFrame(spans, "contig string, start_pos int, end_pos int"),
        row_limit,
    )
    assert ("Exchange" in got._jdf.queryExecution().executedPlan().toString()) == (row_limit == 0)
    expected = {
        v for v, c, p in variants
        if any(c == k and e is not None and 1 <= s <= e and s <= p <= e for k, s, e in spans)
    }
    assert {r["variant_id"] for r in got.collect()} == expected
    assert got.count() == len(expected)


def test_invalid_interval_rows_are_skipped(spark, tmp_path):
    (tmp_path / "i.tsv").write_text("chr1\t5\t9\nchr1\tx\t9\nchr1\t9\t5\nchr2\t7\t7\n")
    read = readers.read_intervals(spark, str(tmp_path / "i.tsv"))
    assert sorted(tuple(r) for r in intervals.valid_intervals(read).collect()) == [("chr1", 5, 9), ("chr2", 7, 7)]
    variants = spark.createDataFrame([("chr1", 5)], "contig string, position int")
    assert intervals.interval_semi_join(variants, read.limit(0)).count() == 0
