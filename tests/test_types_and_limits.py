"""Types through files, models that do not settle, and scores of a report list."""

from riskloom.operators import logistic, scoring
from riskloom.operators.distribution import scored_cohort
from riskloom.operators.genotypes import Genotypes
from riskloom.sources import readers
from riskloom.sources.stored import store


def test_whole_numbers_written_as_fractions(spark, tmp_path):
    (tmp_path / "cases.csv").write_text("s,phenotype_status\n1,1.0\n2,0.0\n3,1\n4,what\n5,NA\n")
    assert sorted(r["s"] for r in readers.read_cases(spark, str(tmp_path / "cases.csv")).collect()) == ["1", "3"]
    big = spark.createDataFrame([("9007199254740993",), ("3.0",), ("x",), (None,)], "n string")
    assert [r[0] for r in big.select(readers._read_as("n", "long")).collect()] == [9007199254740993, 3, None, None]


def test_ids_and_contigs_stay_text(spark, tmp_path):
    weights = spark.createDataFrame([("00012", "chr1", 5, "A", 0.5)], "prs_id string, contig string, position int, effect_allele string, weight double")
    weights.write.partitionBy("prs_id").parquet(str(tmp_path / "w"))
    assert readers.read_weights(spark, str(tmp_path / "w")).select("prs_id").first()[0] == "00012"


def test_a_model_that_does_not_settle_is_null(spark, monkeypatch):
    joined = spark.range(60).selectExpr(
        "'m' as prs_id", "cast(id as string) as s", "id / 10D as score", "id / 10D as normalized_score", "1L as variant_count",
        "cast(id % 3 = 0 or id > 40 as long) as status",
    )
    monkeypatch.setattr(logistic, "MAX_ROUNDS", 1)
    monkeypatch.setattr(logistic, "STEPS_PER_ROUND", 1)
    assert [r["or_per_sd"] for r in logistic.odds_ratio_per_sd(scored_cohort(joined)).collect()] == [None]


def test_only_members_are_summed(spark):
    calls = spark.createDataFrame([(1, "a", 0, 1), (1, "b", 1, 1), (2, "c", 0, 1)], "variant_id long, s string, a1 int, a2 int")
    samples = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "s string")
    variants = spark.createDataFrame([(1, "chr1", 5, ["A", "G"]), (2, "chr1", 9, ["A", "T"])], "variant_id long, contig string, position int, alleles array<string>")
    loci = store(spark.createDataFrame([("m", 1, 0.5, False, 1), ("m", 2, 2.0, False, 1)], "prs_id string, variant_id long, weight double, effect_is_ref boolean, alternate_index int"), "loci")
    listed = spark.createDataFrame([("b",), ("d",), ("b",)], "s string")
    got = {r["s"]: (r["total_score"], r["variant_count"]) for r in scoring.score_models(Genotypes(samples, variants, calls), loci, listed).collect()}
    assert got == {"b": (1.0, 1), "d": (0.0, 0)}
