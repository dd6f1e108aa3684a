import hashlib

import pytest
from pyspark.sql import functions as F

from riskloom.operators import cohort, phenotype
from riskloom.operators.blocks import split_reference_blocks
from riskloom.operators.genotypes import Genotypes, SparseGenotypes, to_blocks
from riskloom.plans import cohort_build
from riskloom.schema import EmptyInputError, SchemaError
from riskloom.sources import readers, sinks, stored


def ids(df, column="s"):
    return sorted(r[column] for r in df.select(column).collect())


def test_concept_parsing():
    assert phenotype.parse_concept_ids("432510, 374919") == [432510, 374919]
    with pytest.raises(ValueError):
        phenotype.parse_concept_ids("432510, x")
    assert phenotype.status_column("Ischemic Stroke") == "Ischemic_Stroke_status"


def test_cases_from_list_long_list_and_table(spark):
    conditions = spark.createDataFrame(
        [(1, 10), (1, 10), (2, 11), (3, 12), (4, None)], "person_id long, condition_concept_id long"
    )
    assert ids(phenotype.cases_by_concept(conditions, [10, 11])) == ["1", "2"]
    assert ids(phenotype.cases_by_concept(conditions, list(range(11, 2000)))) == ["2", "3"]
    table = spark.createDataFrame([(12,), (12,)], "c long")
    assert ids(phenotype.cases_by_concept(conditions, table)) == ["3"]
    assert ids(phenotype.cases_by_concept(conditions, [99])) == []
    with pytest.raises(ValueError):
        phenotype.cases_by_concept(conditions, [])


def test_label_keeps_every_member_once(spark):
    members = spark.createDataFrame([("1",), ("2",), ("3",)], "s string")
    cases = spark.createDataFrame([("2", 1), ("2", 1), ("9", 1)], "s string, phenotype_status int")
    got = phenotype.label_cohort(members, cases).orderBy("s").collect()
    assert [tuple(r) for r in got] == [("1", 0), ("2", 1), ("3", 0)]
    without_status = phenotype.label_cohort(members, cases.select("s")).where("phenotype_status = 1")
    assert ids(without_status) == ["2"]


def test_exclusion_compares_text_and_tolerates_none(spark):
    samples = spark.createDataFrame([("1",), ("2",), ("3",)], "s string")
    flagged = spark.createDataFrame([(2,), (2,), (None,)], "sample_id long")
    assert ids(cohort.exclude_flagged(samples, flagged)) == ["1", "3"]
    assert ids(cohort.exclude_flagged(samples, None)) == ["1", "2", "3"]
    assert ids(cohort.exclude_flagged(samples, flagged.limit(0))) == ["1", "2", "3"]
    with pytest.raises(SchemaError):
        cohort.exclude_flagged(samples, flagged, "person")


@pytest.mark.parametrize("n", [0, 1, 7, 300, 5000])
def test_sample_equals_sorting_everybody(spark, n):
    people = [(str(i), int(i % 3 == 0)) for i in range(2000)]
    labelled = spark.createDataFrame(people, "s string, phenotype_status long")
    got = {tuple(r) for r in cohort.stratified_sample(labelled, n, n, seed=7).collect()}
    expected = set()
    for status in (0, 1):
        stratum = sorted((hashlib.md5(f"7:{s}".encode()).hexdigest(), s) for s, y in people if y == status)
        expected |= {(s, status) for _, s in stratum[:n]}
    assert got == expected


def genotypes(spark):
    samples = spark.createDataFrame([(str(i),) for i in range(10)], "s string")
    variants = spark.createDataFrame(
        [(1, "chr1", 100, ["A", "C"]), (2, "chr2", 200, ["G", "T"])],
        "variant_id long, contig string, position int, alleles array<string>",
    )
    calls = spark.createDataFrame(
        [(v, str(i), i % 2, 1) for v in (1, 2) for i in range(10)], "variant_id long, s string, a1 int, a2 int"
    )
    return Genotypes(samples, variants, calls)


def test_restrict_and_id_list(spark):
    kept = cohort.restrict_calls(genotypes(spark), spark.createDataFrame([("3",), ("3",), ("77",)], "s string"))
    assert ids(kept.samples) == ["3"]
    assert kept.calls.count() == 2
    nobody = spark.createDataFrame([("77",)], "person_id string")
    with pytest.raises(EmptyInputError):
        cohort.restrict_to_id_list(genotypes(spark), nobody)


def test_sparse_components_agree_on_samples(spark):
    dense = genotypes(spark)
    blocks = spark.createDataFrame(
        [(str(i), "chr1", 1, 100) for i in range(10)], "s string, contig string, start_pos int, end_pos int"
    )
    flagged = spark.createDataFrame([("4",)], "sample_id string")
    kept = cohort.exclude_from_sparse(SparseGenotypes(dense.samples, dense.variants, dense.calls, blocks), flagged)
    assert ids(kept.samples) == ids(kept.reference_blocks) == ids(kept.calls.select("s").distinct())
    assert "4" not in ids(kept.samples)


def test_blocks_keep_every_call(spark):
    blocked = to_blocks(genotypes(spark), block_size=3)
    sizes = blocked.members.groupBy("block").count().collect()
    assert sorted(r["count"] for r in sizes) == [1, 3, 3, 3]
    assert blocked.calls.select(F.max(F.size("calls"))).first()[0] <= 3
    back = blocked.calls.select("variant_id", "block", F.inline("calls")).join(blocked.members, ["block", "slot"])
    assert {tuple(r) for r in back.select("variant_id", "s", "a1", "a2").collect()} == {
        tuple(r) for r in genotypes(spark).calls.collect()
    }


@pytest.mark.parametrize("length, pieces", [(1, 1), (9999, 1), (10000, 1), (10001, 2), (20000, 2), (20001, 3)])
def test_block_split_covers_the_same_bases(spark, length, pieces):
    block = spark.createDataFrame([("x", "chr1", 501, 500 + length)], "s string, contig string, start_pos int, end_pos int")
    out = [(r["start_pos"], r["end_pos"]) for r in split_reference_blocks(block).orderBy("start_pos").collect()]
    assert len(out) == pieces
    assert out[0][0] == 501 and out[-1][1] == 500 + length
    assert all(a[1] + 1 == b[0] for a, b in zip(out, out[1:]))
    assert all(e - s + 1 <= 10000 for s, e in out)


def test_cohort_is_reused_only_for_the_same_parameters(spark, tmp_path):
    person = spark.createDataFrame([(i,) for i in range(10)], "person_id long")
    search = person.selectExpr("person_id", "1 as has_ehr_data", "1 as has_whole_genome_variant")
    cases = spark.createDataFrame([("1", 1), ("2", 1), ("3", 1)], "s string, phenotype_status int")

    def build(n, flagged=None):
        p = cohort_build.CohortParameters(source="test", concept_ids=(1,), n_cases=n, n_controls=n)
        return cohort_build.build_cohort(spark, str(tmp_path), p, genotypes(spark), person, search, flagged, cases)

    two, three = build(2), build(3)
    assert two != three and build(2) == two
    assert len(ids(readers.read_cohort(spark, f"{two}/ids"))) == 4
    assert readers.read_genotypes(spark, three).samples.count() == 6
    labels = cohort_build.read_members(spark, three).groupBy("phenotype_status").count().collect()
    assert {tuple(r) for r in labels} == {(0, 3), (1, 3)}
    report = sinks.verify_counts(spark, three, {"n_samples": 6, "n_variants": 2, "n_calls": 12}).first()
    assert report["verified"]
    assert not sinks.verify_counts(spark, three, {"n_samples": 7}).first()["verified"]


def test_nobody_eligible_is_an_error(spark, tmp_path):
    person = spark.createDataFrame([(1,)], "person_id long")
    search = person.selectExpr("person_id", "0 as has_ehr_data", "1 as has_whole_genome_variant")
    cases = spark.createDataFrame([], "s string, phenotype_status int")
    p = cohort_build.CohortParameters(source="none", concept_ids=(1,))
    with pytest.raises(EmptyInputError):
        cohort_build.build_cohort(spark, str(tmp_path), p, genotypes(spark), person, search, None, cases)


def reuse_case(spark, tmp_path):
    person = spark.createDataFrame([(i,) for i in range(10)], "person_id long")
    search = person.selectExpr("person_id", "1 as has_ehr_data", "1 as has_whole_genome_variant")
    p = cohort_build.CohortParameters(source="reuse", concept_ids=(1,), sample=False)

    def build(cases=("1", "2"), flagged=(), source=None):
        listed = spark.createDataFrame([(s, 1) for s in cases], "s string, phenotype_status int")
        out = spark.createDataFrame([(s,) for s in flagged], "sample_id string")
        return cohort_build.build_cohort(spark, str(tmp_path), p, source or genotypes(spark), person, search, out, listed)

    return build


def test_other_lists_are_another_cohort(spark, tmp_path):
    build = reuse_case(spark, tmp_path)
    first = build()
    assert build(cases=("2", "1", "1")) == first  # the same people in another order
    assert build(flagged=("77",)) == first  # excludes nobody
    fewer, other = build(flagged=("3",)), build(cases=("1",))
    assert len({first, fewer, other}) == 3
    assert "3" not in ids(cohort_build.read_members(spark, fewer))
    dense = genotypes(spark)
    blocks = spark.createDataFrame([("1", "chr1", 1, 100)], "s string, contig string, start_pos int, end_pos int")
    sparse = build(source=SparseGenotypes(dense.samples, dense.variants, dense.calls, blocks))
    assert sparse != first
    assert cohort_build.read_sparse_cohort(spark, sparse).reference_blocks.count() == 1


def test_a_cohort_whose_parts_changed_is_rebuilt(spark, tmp_path):
    build = reuse_case(spark, tmp_path)
    path = build()
    assert cohort_build.is_intact(spark, path, "dense")
    assert not cohort_build.is_intact(spark, path, "sparse")
    spark.read.parquet(f"{path}/samples").limit(3).write.mode("overwrite").parquet(f"{tmp_path}/few")
    spark.read.parquet(f"{tmp_path}/few").write.mode("overwrite").parquet(f"{path}/samples")
    assert not cohort_build.is_intact(spark, path, "dense")
    assert build() == path
    assert cohort_build.is_intact(spark, path, "dense")
    assert spark.read.parquet(f"{path}/samples").count() == 10


def test_a_record_of_other_counts_is_stale(spark, tmp_path):
    build = reuse_case(spark, tmp_path)
    path = build()
    record = spark.read.parquet(f"{path}/complete").first().asDict()
    assert record == {"n_samples": 10, "n_variants": 2, "n_calls": 20, "n_members": 10}
    stored.write_record(spark, path, record | {"n_calls": 21})
    assert not cohort_build.is_intact(spark, path, "dense")
    stored.drop_record(spark, path)
    assert not cohort_build.is_intact(spark, path, "dense")
    build()
    assert cohort_build.is_intact(spark, path, "dense")


def test_artefact_with_another_count_is_rebuilt(spark, tmp_path):
    built = []

    def make():
        built.append(1)
        return spark.range(5).select(F.col("id").alias("x"))

    for _ in range(2):
        assert stored.checkpoint_or_compute(spark, str(tmp_path), {"a": 1}, make).count() == 5
    assert len(built) == 1
    path = f"{tmp_path}/{stored.fingerprint(a=1)}"
    spark.range(3).select(F.col("id").alias("x")).write.mode("overwrite").parquet(f"{path}/data")
    assert stored.checkpoint_or_compute(spark, str(tmp_path), {"a": 1}, make).count() == 5
    assert len(built) == 2


def test_content_digest(spark):
    def digest(rows, schema="a string, b long"):
        return stored.content_digest(spark.createDataFrame(rows, schema))

    base = digest([("x", 1), ("y", None)])
    assert base == digest([("y", None), ("x", 1)])
    assert len({base, digest([("x", 1)]), digest([("x", 1), ("y", None), ("y", None)]), digest([("x", None), ("y", 1)]), digest([("x", 1), (None, None)])}) == 5
