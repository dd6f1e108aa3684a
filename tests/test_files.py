"""Readers, writers, reuse and guards."""

import pytest
from pyspark.sql import functions as F

from riskloom.plans import evaluate_models
from riskloom.schema import EmptyInputError, SchemaError
from riskloom.sources import readers, sinks
from riskloom.sources.stored import checkpoint_or_compute, fingerprint, shared_dir, store


def text(tmp_path, name, content):
    path = tmp_path / name
    path.write_text(content)
    return str(path)


def test_flagged_samples(spark, tmp_path):
    assert readers.read_flagged_samples(spark, str(tmp_path / "absent.tsv")) is None
    path = text(tmp_path, "f.tsv", "sample_id\treason\n12\tx\n013\ty\n")
    assert [r[0] for r in readers.read_flagged_samples(spark, path).collect()] == ["12", "013"]
    with pytest.raises(SchemaError):
        readers.read_flagged_samples(spark, text(tmp_path, "g.tsv", "id\n12\n"))


def test_case_lists(spark, tmp_path):
    path = text(tmp_path, "c.csv", "phenotype_status,s\n1,5\n0,6\n1,7\n")
    assert [tuple(r) for r in readers.read_cases(spark, path).collect()] == [("5", 1), ("7", 1)]
    bare = text(tmp_path, "d.csv", "s\n5\n")
    with pytest.raises(SchemaError, match="phenotype_status"):
        readers.read_cases(spark, bare)
    assert [tuple(r) for r in readers.read_case_labels(spark, bare).collect()] == [("5", 1)]
    empty = text(tmp_path, "e.csv", "")
    assert readers.read_case_labels(spark, empty).columns == ["s", "phenotype_status"]
    with pytest.raises(SchemaError):
        readers.read_case_labels(spark, text(tmp_path, "h.csv", "person\n5\n"))


def test_no_cases_leave_a_heading(spark, tmp_path):
    none = spark.createDataFrame([], "s string, phenotype_status int")
    sinks.write_cases(none, str(tmp_path / "cases"))
    assert readers.read_case_labels(spark, str(tmp_path / "cases")).columns == ["s", "phenotype_status"]
    assert readers.read_cases(spark, str(tmp_path / "cases")).count() == 0


def test_id_lists(spark, tmp_path):
    assert readers.read_cohort(spark, text(tmp_path, "i.csv", "person_id\n7\n")).first()["s"] == "7"
    with pytest.raises(EmptyInputError):
        readers.read_id_list(spark, text(tmp_path, "j.csv", "person_id\n"))
    with pytest.raises(EmptyInputError):
        sinks.write_sample_ids(spark.createDataFrame([], "s string"), str(tmp_path / "k"))


def test_scores_roundtrip_with_na(spark, tmp_path):
    scores = spark.createDataFrame(
        [("P", "1", 0.5, 2, 0.25), ("P", "2", 0.0, 0, None)],
        "prs_id string, s string, total_score double, variant_count long, normalized_score double",
    )
    sinks.write_scores(scores, str(tmp_path / "t"), str(tmp_path / "c"))
    assert sorted(map(tuple, readers.read_scores(spark, str(tmp_path / "c")).collect())) == sorted(map(tuple, scores.collect()))
    lines = [line for f in (tmp_path / "c").glob("part-*") for line in f.read_text().splitlines()]
    assert "P,2,0.0,0,NA" in lines
    assert lines[0] == "prs_id,person_id,prs_total_score,prs_variant_count,prs_normalized_score"
    with pytest.raises(EmptyInputError):
        sinks.write_scores(scores.limit(0), str(tmp_path / "t2"), str(tmp_path / "c2"))


def test_score_files_of_one_model(spark, tmp_path):
    path = text(tmp_path, "s.csv", "person_id,prs_total_score,prs_variant_count,prs_normalized_score\n9,1.5,3,NA\n")
    assert tuple(readers.read_scores(spark, path, "P").first()) == ("P", "9", 1.5, 3, None)
    with pytest.raises(SchemaError):
        readers.read_scores(spark, text(tmp_path, "t.csv", "prs_total_score,prs_variant_count,prs_normalized_score\n1,1,1\n"))


def test_manifest(spark, tmp_path):
    path = text(tmp_path, "m.csv", "phenotype,id,url\nStroke,P1,a.txt.gz\n")
    assert readers.read_manifest(spark, path).first().asDict() == {"id": "P1", "url": "a.txt.gz", "phenotype": "Stroke"}
    with pytest.raises(SchemaError, match="url"):
        readers.read_manifest(spark, text(tmp_path, "n.csv", "phenotype,id\nStroke,P1\n"))


def test_scan_inputs(spark, tmp_path):
    cohort = text(tmp_path, "co.csv", "person_id,SV_STATUS,SEX_CODE\n1,0,1\n2,NA,0\n")
    rows = readers.read_scan_cohort(spark, cohort, ["SV_STATUS", "SEX_CODE"]).collect()
    assert [tuple(r) for r in rows] == [(1, 0.0, 1.0), (2, None, 0.0)]
    with pytest.raises(SchemaError, match="PC1"):
        readers.read_scan_cohort(spark, cohort, ["SV_STATUS", "PC1"])
    counts = text(tmp_path, "pc.csv", "person_id,phecode,count\n1,CV_401,3\n")
    assert tuple(readers.read_phecode_counts(spark, counts).first()) == (1, "CV_401", 3)


def test_genotypes_need_samples_variants_and_types(spark, tmp_path):
    base = str(tmp_path / "g")
    spark.createDataFrame([("1",)], "s string").write.parquet(f"{base}/samples")
    variants = spark.createDataFrame([(1, "chr1", 5, ["A", "C"])], "variant_id long, contig string, position int, alleles array<string>")
    calls = spark.createDataFrame([("1", 1, 0, 1)], "s string, variant_id long, a1 int, a2 int")
    calls.write.parquet(f"{base}/calls")
    variants.limit(0).write.parquet(f"{base}/variants")
    with pytest.raises(EmptyInputError):
        readers.read_genotypes(spark, base)
    variants.write.mode("overwrite").parquet(f"{base}/variants")
    assert readers.read_genotypes(spark, base).calls.count() == 1
    calls.withColumn("a1", F.col("a1").cast("string")).write.mode("overwrite").parquet(f"{base}/calls")
    with pytest.raises(SchemaError, match="a1"):
        readers.read_genotypes(spark, base)


def test_calls_with_contig_are_partitioned_by_it(spark, tmp_path):
    from riskloom.operators.genotypes import Genotypes

    samples = spark.createDataFrame([("1",)], "s string")
    variants = spark.createDataFrame([(1, "chr1", 5, ["A", "C"]), (2, "chr2", 5, ["A", "C"])], "variant_id long, contig string, position int, alleles array<string>")
    calls = spark.createDataFrame([("1", 1, "chr1", 5, 0, 1), ("1", 2, "chr2", 5, 0, 1)], "s string, variant_id long, contig string, position int, a1 int, a2 int")
    sinks.write_genotypes(Genotypes(samples, variants, calls), str(tmp_path / "g"))
    assert sorted(p.name for p in (tmp_path / "g" / "calls").glob("contig=*")) == ["contig=chr1", "contig=chr2"]
    assert readers.read_genotypes(spark, str(tmp_path / "g")).calls.count() == 2


def test_reuse_depends_on_parameters_and_rows(spark, tmp_path):
    built = []

    def build(n):
        def run():
            built.append(n)
            return spark.range(n)
        return run

    base = str(tmp_path / "r")
    assert checkpoint_or_compute(spark, base, {"n": 3}, build(3)).count() == 3
    assert checkpoint_or_compute(spark, base, {"n": 3}, build(3)).count() == 3
    assert checkpoint_or_compute(spark, base, {"n": 4}, build(4)).count() == 4
    assert built == [3, 4]
    # An empty table is not kept.
    checkpoint_or_compute(spark, base, {"n": 0}, build(0))
    checkpoint_or_compute(spark, base, {"n": 0}, build(0))
    assert built == [3, 4, 0, 0]
    assert fingerprint(a=1, b=2) == fingerprint(b=2, a=1) != fingerprint(a=1, b=3)


def test_broken_artefacts_are_rebuilt(spark, tmp_path):
    base = str(tmp_path / "b")
    assert checkpoint_or_compute(spark, base, {"n": 1}, lambda: spark.range(5)).count() == 5
    (folder,) = (tmp_path / "b").iterdir()
    for part in (folder / "data").glob("part-*"):
        part.write_bytes(b"not parquet")
    for crc in (folder / "data").glob(".*.crc"):
        crc.unlink()
    assert checkpoint_or_compute(spark, base, {"n": 1}, lambda: spark.range(6)).count() == 6
    # Data without the final count was not completely written.
    for part in (folder / "complete").glob("*"):
        part.unlink()
    assert checkpoint_or_compute(spark, base, {"n": 1}, lambda: spark.range(7)).count() == 7


def test_store_measures_and_uses_the_named_folder(spark):
    kept = store(spark.range(7), "seven", top=F.max("id"))
    assert (kept.rows, kept.figures["top"]) == (7, 6)
    assert shared_dir(spark) in kept.df.inputFiles()[0]
    assert "broadcast" in kept.join_side(7)._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in kept.join_side(6)._jdf.queryExecution().analyzed().toString().lower()
    empty = store(spark.range(0), "none")
    assert empty.rows == 0 and empty.df.count() == 0


def test_evaluation_from_files(spark, tmp_path):
    rows = "".join(f"{i},{(i * 37 % 101) / 8},5,NA\n" for i in range(200))
    scores = text(tmp_path, "sc.csv", "person_id,prs_total_score,prs_variant_count,prs_normalized_score\n" + rows)
    ids = text(tmp_path, "ids.csv", "person_id\n" + "".join(f"{i}\n" for i in range(150)))
    cases = text(tmp_path, "ca.csv", "s,phenotype_status\n" + "".join(f"{i},1\n" for i in range(0, 200, 3)))
    scores_df = readers.read_scores(spark, scores, "P")
    summary = evaluate_models.evaluate(scores_df, readers.read_cohort(spark, ids), readers.read_case_labels(spark, cases))
    model = summary.models.df.first()
    assert (model["n"], model["n_cases"]) == (150, 50)
