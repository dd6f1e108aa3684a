import pytest
from pyspark.sql import functions as F

from riskloom.operators.genotypes import Genotypes, to_blocks
from riskloom.operators.scoring import score_blocked, score_models, scoring_loci, scoring_status
from riskloom.schema import SchemaError

WEIGHTS = "prs_id string, contig string, position int, effect_allele string, weight double, other_allele string"


@pytest.fixture(scope="module")
def study(spark):
    variants = spark.createDataFrame(
        [
            (1, "chr1", 10, ["A", "C"]),
            (2, "chr1", 10, ["A", "G"]),  # a second row at the locus
            (3, "chr2", 20, ["G", "T", "C"]),
            (4, "chrX", 30, ["T", "C"]),
        ],
        "variant_id long, contig string, position int, alleles array<string>",
    )
    samples = spark.createDataFrame([("u",), ("v",), ("w",)], "s string")
    calls = spark.createDataFrame(
        [
            ("u", 1, 0, 1), ("u", 2, 1, 1), ("u", 3, 1, 2), ("u", 4, 0, 0),
            ("v", 1, None, None), ("v", 3, 2, 2), ("v", 4, 1, None),
            ("x", 1, 1, 1),  # not a member
        ],
        "s string, variant_id long, a1 int, a2 int",
    )
    weights = spark.createDataFrame(
        [
            ("P", "chr1", 10, "C", 0.5, None),
            ("P", "chr2", 20, "C", 2.0, None),
            ("P", "chrX", 30, "C", 1.0, None),
            ("Q", "chr1", 10, "N", 3.0, None),  # allele seen nowhere: dosage 0, still counted
            ("R", "chr9", 99, "A", 1.0, None),  # no overlap
        ],
        WEIGHTS,
    )
    return Genotypes(samples, variants, calls), weights


EXPECTED = {
    # u: 1 x 0.5 (C at variant 1), 0 at variant 2, 1 x 2.0 (1/2 holds C), 0 at X
    ("P", "u"): (2.5, 4, 2.5 / 4),
    # v: missing at 1, 2 x 2.0, haploid X counts as 0 copies
    ("P", "v"): (4.0, 2, 2.0),
    ("P", "w"): (0.0, 0, None),
    ("Q", "u"): (0.0, 2, 0.0),
    ("Q", "v"): (0.0, 0, None),
    ("Q", "w"): (0.0, 0, None),
}


def as_dict(scores):
    return {
        (r["prs_id"], r["s"]): (r["total_score"], r["variant_count"], r["normalized_score"]) for r in scores.collect()
    }


@pytest.mark.parametrize("row_limit", [0, 1000])
def test_scores(study, row_limit):
    genotypes, weights = study
    loci = scoring_loci(weights, genotypes.variants)
    assert as_dict(score_models(genotypes, loci, row_limit=row_limit)) == EXPECTED


def test_scores_from_blocks(study):
    genotypes, weights = study
    members = Genotypes(
        genotypes.samples, genotypes.variants, genotypes.calls.join(genotypes.samples, "s", "left_semi")
    )
    loci = scoring_loci(weights, genotypes.variants)
    assert as_dict(score_blocked(to_blocks(members, 2), loci)) == EXPECTED


def test_status(spark, study):
    genotypes, weights = study
    manifest = spark.createDataFrame([(m, "", "") for m in "PQRS"], "id string, url string, phenotype string")
    loci = scoring_loci(weights, genotypes.variants)
    got = {r["prs_id"]: (r["n_weights"], r["n_loci"], r["status"]) for r in scoring_status(manifest, weights, loci).collect()}
    assert got == {
        "P": (3, 4, "scored"), "Q": (1, 2, "scored"), "R": (1, 0, "no overlap"), "S": (0, 0, "no valid weights")
    }


def test_order_of_rows_does_not_matter(study):
    genotypes, weights = study
    shuffled = Genotypes(
        genotypes.samples, genotypes.variants.orderBy(F.desc("variant_id")), genotypes.calls.orderBy(F.rand(3))
    )
    assert as_dict(score_models(shuffled, scoring_loci(weights.orderBy(F.rand(4)), shuffled.variants))) == EXPECTED


def test_weights_need_a_model(study):
    genotypes, weights = study
    with pytest.raises(SchemaError):
        scoring_loci(weights.drop("prs_id"), genotypes.variants)
