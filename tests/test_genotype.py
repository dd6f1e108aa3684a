"""Truth table of calls x effect alleles."""

import pytest
from pyspark.sql import functions as F

from riskloom.functions import genotype as gt

ALLELES = ["A", "C", "G"]

# (a1, a2, effect allele, copies)
TABLE = [
    (None, None, "A", None),
    (None, None, "C", None),
    (0, 0, "A", 2),
    (0, 0, "C", 0),
    (0, 0, "T", 0),
    (0, 1, "A", 1),
    (0, 1, "C", 1),
    (0, 1, "G", 0),
    (1, 0, "C", 1),
    (0, 2, "G", 1),
    (0, 2, "C", 0),
    (1, 2, "C", 1),
    (1, 2, "G", 1),
    (1, 2, "A", 1),  # a heterozygote always earns the reference copy
    (1, 2, "T", 0),
    (1, 1, "C", 2),
    (1, 1, "A", 0),
    (1, 1, "G", 0),
    (2, 2, "G", 2),
    (2, 2, "C", 0),
    (0, None, "A", 0),  # haploid
    (1, None, "C", 0),
    (0, 1, "c", 0),  # case matters
]


@pytest.fixture(scope="module")
def dosages(spark):
    rows = [(i, ALLELES, a1, a2, e) for i, (a1, a2, e, _) in enumerate(TABLE)]
    df = spark.createDataFrame(rows, "i int, alleles array<string>, a1 int, a2 int, e string")
    ref = gt.effect_is_reference(F.col("alleles"), F.col("e"))
    alt = gt.effect_alternate_index(F.col("alleles"), F.col("e"))
    out = df.select("i", gt.dosage(F.col("a1"), F.col("a2"), ref, alt).alias("d")).collect()
    return {r["i"]: r["d"] for r in out}


@pytest.mark.parametrize("i", range(len(TABLE)))
def test_dosage(dosages, i):
    assert dosages[i] == TABLE[i][3], TABLE[i]


def test_effect_allele_index(spark):
    rows = [(["A"], "A"), (["A"], "C"), (["A", "C", "C"], "C"), ([], "A"), (["A", "C"], None), (["A", "C"], "C")]
    df = spark.createDataFrame(rows, "alleles array<string>, e string")
    got = df.select(
        gt.effect_is_reference(F.col("alleles"), F.col("e")), gt.effect_alternate_index(F.col("alleles"), F.col("e"))
    ).collect()
    assert [tuple(r) for r in got] == [(True, 0), (False, 0), (False, 1), (False, 0), (False, 0), (False, 1)]


def test_predicates(spark):
    rows = [(None, None), (0, 0), (0, 1), (1, 1), (1, 2), (1, None)]
    a1, a2 = F.col("a1"), F.col("a2")
    df = spark.createDataFrame(rows, "a1 int, a2 int").select(
        gt.is_missing(a1, a2), gt.is_hom_ref(a1, a2), gt.is_het(a1, a2), gt.is_hom_var(a1, a2), gt.ploidy(a1, a2),
        gt.contains_allele(a1, a2, F.lit(2)),
    )
    assert [tuple(bool(x) for x in r[:4]) + (r[4], r[5]) for r in df.collect()] == [
        (True, False, False, False, None, False),
        (False, True, False, False, 2, False),
        (False, False, True, False, 2, False),
        (False, False, False, True, 2, False),
        (False, False, True, False, 2, True),
        (False, False, False, False, 1, False),
    ]
