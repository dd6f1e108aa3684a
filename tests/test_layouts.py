"""Pruned scans, tiles and buckets: same scores, and the plans they are for."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import scoring, tiles
from riskloom.operators.genotypes import Genotypes, SparseGenotypes
from riskloom.operators.pruning import calls_in_ranges, joined_ranges, locus_ranges
from riskloom.schema import EmptyInputError
from riskloom.sources import layouts, readers, sinks

WEIGHTS = "prs_id string, contig string, position int, effect_allele string, weight double, other_allele string"
VARIANTS = "variant_id long, contig string, position int, alleles array<string>"
CALLS = "variant_id long, s string, a1 int, a2 int"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def study(spark):
    rnd = random.Random(4)
    bases = ["A", "C", "G", "T"]
    variants = [(i, f"chr{1 + i % 3}", 1000 * (i // 3) + i % 2, bases[i % 4 :] + bases[: i % 4][: 1 + i % 2]) for i in range(90)]
    people = [f"p{i}" for i in range(23)]
    kinds = [(0, 0), (0, 1), (1, 1), (1, 2), (2, 2), (None, None), (1, None), (0, None), (0, 2)]
    calls = [(v[0], s, *rnd.choice(kinds)) for v in variants for s in people if rnd.random() < 0.8 and s != "p7"]
    weights = [
        (m, v[1], v[2], rnd.choice([*v[3], "N"]), rnd.randint(-64, 64) / 64, None)
        for m in ("P", "Q") for v in variants if rnd.random() < 0.5 and v[1] != "chr3"
    ]
    genotypes = Genotypes(
        spark.createDataFrame([(s,) for s in people], "s string"),
        spark.createDataFrame(variants, VARIANTS),
        spark.createDataFrame(calls, CALLS),
    )
    return genotypes, spark.createDataFrame(weights, WEIGHTS)


def as_dict(scores):
    return {(r["prs_id"], r["s"]): (r["total_score"], r["variant_count"], r["normalized_score"]) for r in scores.collect()}


@pytest.fixture(scope="module")
def expected(study):
    genotypes, weights = study
    return as_dict(scoring.score_models(genotypes, scoring.scoring_loci(weights, genotypes.variants)))


def test_joined_ranges():
    assert joined_ranges([(1, 3), (4, 9), (20, 20), (25, 30)], 9) == [(1, 9), (20, 20), (25, 30)]
    assert joined_ranges([(1, 3), (5, 9), (20, 20), (25, 30)], 2) == [(1, 9), (20, 30)]
    assert joined_ranges([(1, 3), (5, 9)], 1) == [(1, 9)]
    assert joined_ranges([(7, 7)], 5) == [(7, 7)]


def test_ranges_hold_all_loci(spark):
    rnd = random.Random(1)
    loci = [(f"c{rnd.randint(1, 3)}", rnd.randint(0, 2**31 - 1)) for _ in range(500)] + [(None, 5), ("c1", None)]
    found = locus_ranges(spark.createDataFrame(loci, "contig string, position int"), most=7)
    assert set(found) == {"c1", "c2", "c3"}
    assert all(len(r) <= 7 for r in found.values())
    assert all(any(a <= p <= b for a, b in found[c]) for c, p in loci if c and p is not None)


def test_written_calls_are_pruned(spark, study, expected, tmp_path, monkeypatch):
    genotypes, weights = study
    monkeypatch.setattr(sinks, "ROWS_PER_TASK", 100)
    counts = sinks.write_genotypes(genotypes, str(tmp_path))
    assert counts == {"n_samples": 23, "n_variants": 90, "n_calls": genotypes.calls.count()}
    kept = readers.read_genotypes(spark, str(tmp_path))
    loci = scoring.scoring_loci(weights, kept.variants)
    called = scoring.contributions(kept.calls, loci)
    text = plan(called)
    assert "contig" in text.split("PartitionFilters: ")[1].split("]")[0]
    assert "GreaterThanOrEqual(position" in text and "LessThanOrEqual(position" in text
    assert "hashpartitioning" not in text and "rangepartitioning" not in text
    assert "chr3" not in text
    assert as_dict(scoring.score_models(kept, loci)) == expected


def test_calls_of_unknown_variants_are_written(spark, study, tmp_path):
    genotypes, _ = study
    stray = spark.createDataFrame([(999, "p1", 0, 1)], CALLS)
    more = Genotypes(genotypes.samples, genotypes.variants, genotypes.calls.unionByName(stray))
    counts = sinks.write_genotypes(more, str(tmp_path))
    kept = readers.read_genotypes(spark, str(tmp_path))
    assert kept.calls.count() == counts["n_calls"] == genotypes.calls.count() + 1
    assert kept.calls.where("contig is null").count() == 1


def test_sparse_blocks_are_counted(spark, study, tmp_path):
    genotypes, _ = study
    blocks = spark.createDataFrame([("p1", "chr1", i * 300_000, i * 300_000 + 9) for i in range(20)], "s string, contig string, start_pos int, end_pos int")
    sparse = SparseGenotypes(genotypes.samples, genotypes.variants, genotypes.calls, blocks)
    counts = sinks.write_genotypes(sparse, str(tmp_path))
    assert counts["n_blocks"] == 20
    assert sinks.verify_counts(spark, str(tmp_path), counts).first()["verified"]
    assert not sinks.verify_counts(spark, str(tmp_path), counts | {"n_blocks": 19}).first()["verified"]


def test_no_loci_no_calls(spark, study):
    genotypes, _ = study
    located = genotypes.calls.join(genotypes.variants.select("variant_id", "contig", "position"), "variant_id")
    assert calls_in_ranges(located, {}).count() == 0


@pytest.mark.parametrize("block, run", [(5, 4), (23, 64), (1, 1), (4096, 64)])
def test_tiles(spark, study, expected, tmp_path, block, run):
    genotypes, weights = study
    tiled = layouts.write_tiles(tiles.to_tiles(genotypes, block, run), str(tmp_path))
    assert {tuple(r) for r in tiles.from_tiles(tiled).collect()} == {tuple(r) for r in genotypes.calls.collect()}
    loci = scoring.scoring_loci(weights, genotypes.variants)
    assert as_dict(tiles.score_tiled(tiled, loci)) == expected


def test_tiles_report_the_listed_samples(spark, study, expected, tmp_path):
    genotypes, weights = study
    tiled = layouts.write_tiles(tiles.to_tiles(genotypes, 7, 8), str(tmp_path))
    listed = spark.createDataFrame([("p1",), ("p7",), ("stranger",), ("p1",)], "s string")
    loci = scoring.scoring_loci(weights, genotypes.variants)
    assert as_dict(tiles.score_tiled(tiled, loci, listed)) == as_dict(scoring.score_models(genotypes, loci, listed))


def test_few_calls_make_small_tiles(spark, study, expected, tmp_path):
    # 30 variants by 400 samples with 23 people's calls spread among them: no tile holds half of its cells
    genotypes, weights = study
    strangers = spark.range(377).select(F.concat(F.lit("p"), F.col("id") + 1000).alias("s"))
    wide = Genotypes(genotypes.samples.union(strangers), genotypes.variants, genotypes.calls.union(genotypes.calls))
    tiled = layouts.write_tiles(tiles.to_tiles(wide, 400, 30), str(tmp_path))
    sizes = tiled.tiles.select(F.length("cells").alias("n"), (F.length("cells") + F.length("a1") + F.length("a2")).alias("bytes")).collect()
    assert sum(r["n"] for r in sizes) == 4 * genotypes.calls.count()
    assert all(r["bytes"] < 30 * 400 for r in sizes)
    loci = scoring.scoring_loci(weights, genotypes.variants)
    got = as_dict(tiles.score_tiled(tiled, loci))
    assert {k: v for k, v in got.items() if int(k[1][1:]) < 1000} == expected
    assert {v for k, v in got.items() if int(k[1][1:]) >= 1000} == {(0.0, 0, None)}
    assert sorted(map(tuple, tiles.from_tiles(tiled).collect()), key=repr) == sorted(map(tuple, genotypes.calls.collect()), key=repr)


def test_tiles_are_dealt_and_read_once(spark, study, tmp_path):
    genotypes, weights = study
    cut = tiles.to_tiles(genotypes, 7, 8)
    assert plan(cut.tiles).count("hashpartitioning") == 1
    tiled = layouts.write_tiles(cut, str(tmp_path))
    loci = scoring.scoring_loci(weights.where("contig = 'chr2'"), genotypes.variants)
    text = plan(tiles.score_tiled(tiled, loci))
    scan = next(x for x in text.splitlines() if "FileScan" in x and "/tiles" in x)
    assert "chr2" in scan and "chr1" not in scan.split("PartitionFilters")[1]


def test_unfinished_tiles_are_an_error(spark, tmp_path):
    with pytest.raises(EmptyInputError):
        layouts.read_tiles(spark, str(tmp_path / "absent"))
    with pytest.raises(EmptyInputError):
        layouts.read_bucketed(spark, str(tmp_path / "absent"))


def test_dosages_equal_the_column_expression(spark):
    from riskloom.functions.genotype import dosage

    values = [None, 0, 1, 2, 3]
    rows = [(a, b, ref, alt) for a in values for b in values for ref in (True, False) for alt in (0, 1, 2) if not (a is None and b is not None)]
    frame = spark.createDataFrame(rows, "a1 int, a2 int, ref boolean, alt int")
    exact = frame.select("*", dosage(F.col("a1"), F.col("a2"), F.col("ref"), F.col("alt")).alias("d")).collect()
    for r in exact:
        a1 = np.array([[tiles.MISSING if r["a1"] is None else r["a1"]]], np.int16)
        a2 = np.array([[tiles.HAPLOID if r["a2"] is None else r["a2"]]], np.int16)
        assert tiles.dosages(a1, a2, np.array([r["ref"]]), np.array([r["alt"]]))[0, 0] == (r["d"] or 0)


def test_bucketed_calls_stay_where_they_are(spark, study, expected, tmp_path):
    genotypes, weights = study
    kept = layouts.write_bucketed(genotypes, str(tmp_path), 4)
    loci = scoring.scoring_loci(weights, kept.variants)
    text = plan(scoring.contributions(kept.calls, loci, 0, kept.buckets))
    assert "SortMergeJoin" in text and "Exchange" not in text
    assert as_dict(scoring.score_models(kept, loci, row_limit=0)) == expected
    again = layouts.read_bucketed(spark, str(tmp_path))
    assert "Exchange" not in plan(scoring.contributions(again.calls, loci, 0, again.buckets))
    assert as_dict(scoring.score_models(again, loci, row_limit=1000)) == expected
