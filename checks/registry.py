"""Every registered query: an operator run over whole derived tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.fixtures import CONCEPTS, SAMPLE_SIZE, SEED, Study
from riskloom.functions import genotype as gt
from riskloom.operators import blocks, cohort, distribution, evaluation, intervals, logistic, phenotype, phewas
from riskloom.operators import genotypes as geno
from riskloom.operators import scoring, tiles, weights
from riskloom.plans import cohort_build, evaluate_models, score_models, study
from riskloom.sources import layouts, readers, sinks
from riskloom.sources.stored import checkpoint_or_compute, new_path, store

TARGET = "Ischemic Stroke"
COVARIATES = ["pc1", "age_at_last_event"]

QUERIES: dict[str, Callable[[Study], DataFrame]] = {}


def query(build: Callable[[Study], DataFrame]) -> Callable[[Study], DataFrame]:
    QUERIES[build.__name__] = build
    return build


# One division of exact numbers: the same bits everywhere, but often a tie at the sixth digit.
EXACT = ("normalized_score", "prs_normalized_score")
# Interpolated between multiples of 1/64 in twentieths: eight decimals, so nine digits have no ties.
QUANTILES = ("value", "score_p5", "score_p95")


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six digits, where both engines agree whatever the order of summation."""
    digits = {n: 9 if n in QUANTILES else 6 for n, kind in df.dtypes if kind == "double" and n not in EXACT}
    return df.withColumns({n: F.round(n, d) for n, d in digits.items()}) if digits else df


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(build):
        return lambda spark, sf_dir: rounded(build(Study(spark, sf_dir)))

    return {name: bound(build) for name, build in QUERIES.items()}


# --- shared steps ---


def cases(st: Study) -> DataFrame:
    return phenotype.cases_by_concept(st.table("condition_occurrence"), CONCEPTS)


def eligible(st: Study) -> DataFrame:
    return cohort.eligible_persons(st.table("person"), st.table("cb_search_person"))


def members(st: Study) -> DataFrame:
    return cohort.exclude_flagged(eligible(st), st.table("flagged_samples"))


def labelled(st: Study) -> DataFrame:
    return phenotype.label_cohort(members(st), cases(st))


def sampled(st: Study) -> DataFrame:
    return cohort.stratified_sample(labelled(st), SAMPLE_SIZE, SAMPLE_SIZE, SEED)


def clean(st: Study) -> DataFrame:
    return weights.clean_weights(st.table("raw_weights"), ["prs_id"])


def locus_weights(st: Study) -> DataFrame:
    return weights.one_weight_per_locus(clean(st), ["prs_id"])


def loci(st: Study):
    return scoring.scoring_loci(locus_weights(st), st.variants())


def scores(st: Study) -> DataFrame:
    return scoring.score_models(st.genotypes(), loci(st), members(st))


def evaluated(st: Study) -> distribution.ScoredCohort:
    return evaluate_models.evaluate(scores(st), members(st), cases(st))


def parameters(st: Study, path: str) -> cohort_build.CohortParameters:
    return cohort_build.CohortParameters(
        source=f"{st.sf_dir}#{path}", concept_ids=tuple(CONCEPTS), n_cases=SAMPLE_SIZE, n_controls=SAMPLE_SIZE, seed=SEED
    )


def build_base(st: Study, genotypes, path: str | None = None, flagged: DataFrame | None = None, sample: bool = True) -> str:
    path = path or new_path(st.spark, "base")
    return cohort_build.build_cohort(
        st.spark, path, replace(parameters(st, path), sample=sample), genotypes, st.table("person"), st.table("cb_search_person"),
        st.table("flagged_samples") if flagged is None else flagged, cases(st),
    )


# --- phenotype and cohort ---


@query
def cases_by_concept(st: Study) -> DataFrame:
    return cases(st)


@query
def eligible_persons(st: Study) -> DataFrame:
    return eligible(st)


@query
def exclude_flagged_from_tsv(st: Study) -> DataFrame:
    path = new_path(st.spark, "flagged")
    sinks.write_csv(st.table("flagged_samples"), path, sep="\t")
    return cohort.exclude_flagged(eligible(st), readers.read_flagged_samples(st.spark, path))


@query
def label_cohort(st: Study) -> DataFrame:
    path = new_path(st.spark, "cases")
    sinks.write_cases(cases(st), path)
    known = readers.read_cases(st.spark, path)
    return phenotype.label_cohort(members(st), known, phenotype.status_column(TARGET))


@query
def status_frequency(st: Study) -> DataFrame:
    return phenotype.status_frequency(labelled(st))


@query
def split_by_status(st: Study) -> DataFrame:
    known, others = phenotype.split_by_status(labelled(st))
    return known.select("s", F.lit("case").alias("side")).unionByName(others.select("s", F.lit("control").alias("side")))


@query
def stratified_sample(st: Study) -> DataFrame:
    return sampled(st)


@query
def restrict_calls(st: Study) -> DataFrame:
    return cohort.restrict_calls(st.genotypes(), sampled(st)).calls


@query
def restrict_to_id_list(st: Study) -> DataFrame:
    path = new_path(st.spark, "ids")
    sinks.write_sample_ids(cases(st), path)
    return cohort.restrict_to_id_list(st.genotypes(), readers.read_id_list(st.spark, path)).calls


@query
def dataset_counts(st: Study) -> DataFrame:
    return geno.dataset_counts(st.genotypes())


@query
def base_cohort(st: Study) -> DataFrame:
    path = build_base(st, st.genotypes())
    n_samples = readers.read_cohort(st.spark, f"{path}/ids").count()
    return sinks.verify_counts(
        st.spark, path, {"n_samples": n_samples, "n_variants": st.variants().count()}
    )


@query
def exclude_from_sparse(st: Study) -> DataFrame:
    kept = cohort.exclude_from_sparse(st.sparse_genotypes(), st.table("flagged_samples"))
    return _sparse_counts(kept, kept.samples)


@query
def split_reference_blocks(st: Study) -> DataFrame:
    return blocks.split_reference_blocks(st.table("reference_blocks"))


@query
def cohort_rebuilt_for_new_exclusions(st: Study) -> DataFrame:
    """A second cohort of the same parameters and folder, but with a longer exclusion list."""
    base = new_path(st.spark, "excluded")
    build_base(st, st.genotypes(), base, sample=False)
    path = build_base(st, st.genotypes(), base, st.table("more_flagged_samples"), sample=False)
    kept = readers.read_genotypes(st.spark, path)
    calls = kept.calls.groupBy("s").agg(F.count(F.lit(1)).alias("n_calls"))
    return cohort_build.read_members(st.spark, path).join(calls, "s", "left").na.fill(0, ["n_calls"])


@query
def dense_then_sparse(st: Study) -> DataFrame:
    """A sparse cohort of the parameters and folder of a dense one."""
    base = new_path(st.spark, "both_kinds")
    build_base(st, st.genotypes(), base)
    return _sparse_cohort(st, build_base(st, st.sparse_genotypes(), base))


@query
def sparse_base_cohort(st: Study) -> DataFrame:
    return _sparse_cohort(st, build_base(st, st.sparse_genotypes()))


def _sparse_cohort(st: Study, path: str) -> DataFrame:
    kept = cohort_build.read_sparse_cohort(st.spark, path)
    bases = kept.reference_blocks.groupBy("s").agg(F.sum(F.col("end_pos") - F.col("start_pos") + 1).alias("n_bases"))
    return (
        _sparse_counts(kept, cohort_build.read_members(st.spark, path))
        .join(bases, "s", "left")
        .na.fill(0, ["n_bases"])
    )


def _sparse_counts(genotypes: geno.SparseGenotypes, people: DataFrame) -> DataFrame:
    calls = genotypes.calls.groupBy("s").agg(F.count(F.lit(1)).alias("n_calls"))
    refs = genotypes.reference_blocks.groupBy("s").agg(F.count(F.lit(1)).alias("n_blocks"))
    return people.join(calls, "s", "left").join(refs, "s", "left").na.fill(0, ["n_calls", "n_blocks"])


# --- weights and intervals ---


@query
def clean_weights(st: Study) -> DataFrame:
    return clean(st).drop("other_allele")


@query
def weight_cleaning_report(st: Study) -> DataFrame:
    return weights.cleaning_report(st.table("raw_weights"), ["prs_id"])


@query
def one_weight_per_locus(st: Study) -> DataFrame:
    return locus_weights(st).drop("other_allele")


def _written_manifest(st: Study) -> DataFrame:
    """Gzipped scoring files, one per model, and a model whose file is absent."""
    base = new_path(st.spark, "scoring_files")
    raw = st.table("raw_weights")
    rows = []
    for (model,) in raw.select("prs_id").distinct().orderBy("prs_id").collect():
        path = f"{base}/{model}"
        raw.where(F.col("prs_id") == model).drop("prs_id").write.csv(path, sep="\t", header=True, compression="gzip")
        rows.append((model, path, TARGET))
    rows.append(("PGSX", f"{base}/absent.txt.gz", TARGET))
    return st.spark.createDataFrame(rows, "id string, url string, phenotype string")


@query
def scoring_files(st: Study) -> DataFrame:
    return score_models.load_weights(st.spark, _written_manifest(st))[0].drop("other_allele")


@query
def prepared_intervals(st: Study) -> DataFrame:
    """The second artefact is made from the first, which the second call reuses."""
    base, manifest = new_path(st.spark, "prepared"), _written_manifest(st)
    score_models.prepared_weights(st.spark, base, manifest)
    return score_models.prepared_weights(st.spark, base, manifest)[1]


@query
def weight_table_roundtrip(st: Study) -> DataFrame:
    path = new_path(st.spark, "weights")
    sinks.write_weights(locus_weights(st), path)
    return readers.read_weights(st.spark, path).drop("other_allele")


@query
def extract_intervals(st: Study) -> DataFrame:
    path = new_path(st.spark, "intervals")
    sinks.write_intervals(intervals.extract_intervals(locus_weights(st)), path)
    return readers.read_intervals(st.spark, path)


@query
def point_semi_join(st: Study) -> DataFrame:
    model = locus_weights(st).where("prs_id = 'PGSA'")
    return intervals.point_semi_join(st.variants(), model).drop("alleles")


def wide_intervals(st: Study) -> DataFrame:
    position = F.col("position")
    return locus_weights(st).select(
        "contig", (position - 40).alias("start_pos"), (position - 60 + (position % 5) * 40).alias("end_pos")
    )


@query
def interval_semi_join(st: Study) -> DataFrame:
    return intervals.interval_semi_join(st.variants(), wide_intervals(st)).drop("alleles")


@query
def interval_walk(st: Study) -> DataFrame:
    """The way taken for intervals too many for an index."""
    return intervals.interval_semi_join(st.variants(), wide_intervals(st), row_limit=0).drop("alleles")


# --- scoring ---


@query
def call_kinds(st: Study) -> DataFrame:
    a1, a2 = F.col("a1"), F.col("a2")
    kinds = {
        "missing": gt.is_missing(a1, a2),
        "hom_ref": gt.is_hom_ref(a1, a2),
        "het": gt.is_het(a1, a2),
        "hom_var": gt.is_hom_var(a1, a2),
        "has_alternate": gt.contains_allele(a1, a2, F.lit(1)),
        "ploidy": gt.ploidy(a1, a2),
    }
    return (
        st.table("calls").select(*[c.alias(n) for n, c in kinds.items()]).groupBy(*kinds).agg(F.count(F.lit(1)).alias("n"))
    )


@query
def effect_allele_index(st: Study) -> DataFrame:
    return loci(st).df.drop("weight", "contig", "position")


@query
def dosage_contributions(st: Study) -> DataFrame:
    return scoring.contributions(st.table("calls"), loci(st))


@query
def score_one_model(st: Study) -> DataFrame:
    one = scoring.scoring_loci(locus_weights(st).where("prs_id = 'PGSA'"), st.variants())
    return scoring.score_models(st.genotypes(), one, members(st))


@query
def score_all_models(st: Study) -> DataFrame:
    return scores(st)


@query
def score_shuffled_loci(st: Study) -> DataFrame:
    """The way taken when the loci are too many to broadcast."""
    return scoring.score_models(st.genotypes(), loci(st), members(st), row_limit=0)


@query
def score_blocked(st: Study) -> DataFrame:
    kept = cohort.restrict_calls(st.genotypes(), members(st))
    return scoring.score_blocked(geno.to_blocks(kept), loci(st))


@query
def score_pruned(st: Study) -> DataFrame:
    """Models with loci on three contigs, scored on a written cohort of everybody eligible."""
    path = build_base(st, st.genotypes(), sample=False)
    kept = cohort_build.read_cohort_genotypes(st.spark, path)
    some = locus_weights(st).where(F.col("contig").isin("chr2", "chr5", "chr11"))
    return scoring.score_models(kept, scoring.scoring_loci(some, kept.variants), cohort_build.read_members(st.spark, path))


@query
def score_tiled(st: Study) -> DataFrame:
    return tiles.score_tiled(written_tiles(st), loci(st), members(st))


def written_tiles(st: Study) -> tiles.TiledGenotypes:
    return layouts.write_tiles(tiles.to_tiles(st.genotypes()), new_path(st.spark, "tiles"))


@query
def calls_from_tiles(st: Study) -> DataFrame:
    """The calls that the written tiles hold."""
    return tiles.from_tiles(written_tiles(st))


@query
def score_many_loci(st: Study) -> DataFrame:
    """Loci beyond the broadcast limit meet bucketed calls."""
    kept = layouts.write_bucketed(st.genotypes(), new_path(st.spark, "bucketed"), 8)
    return scoring.score_models(kept, loci(st), members(st), row_limit=0)


@query
def scoring_status(st: Study) -> DataFrame:
    return score_models.score_manifest(st.genotypes(), st.manifest(), _with_unmatched(st), members(st))[1]


def _with_unmatched(st: Study) -> DataFrame:
    """The weights plus a model whose loci lie one base beside the variants."""
    known = locus_weights(st)
    beside = known.where("prs_id = 'PGSB'").withColumns(
        {"prs_id": F.lit("PGSY"), "position": (F.col("position") + 1).cast("int")}
    )
    return known.unionByName(beside)


@query
def score_export(st: Study) -> DataFrame:
    table, csv = new_path(st.spark, "score_table"), new_path(st.spark, "score_csv")
    sinks.write_scores(scores(st), table, csv)
    return sinks.score_columns(readers.read_scores(st.spark, csv))


# --- distribution ---


@query
def unusable_scores(st: Study) -> DataFrame:
    kind = F.col("variant_count") % 5
    spoilt = (
        F.when(kind == 0, float("nan")).when(kind == 1, float("inf")).when(kind == 2, float("-inf")).otherwise(F.col("total_score"))
    )
    return distribution.dropped_rows(
        distribution.join_status(scores(st).withColumn("total_score", spoilt), labelled(st))
    )


@query
def model_statistics(st: Study) -> DataFrame:
    return evaluated(st).models.df.drop("q")


@query
def exact_quantiles(st: Study) -> DataFrame:
    return evaluated(st).models.df.select("prs_id", F.posexplode("q").alias("k", "value"))


@query
def zscore_and_bins(st: Study) -> DataFrame:
    return distribution.binned_people(evaluated(st)).select("prs_id", "s", "prs_zscore", "risk_category", "prs_decile")


@query
def percentile_rank(st: Study) -> DataFrame:
    return distribution.standardised_scores(evaluated(st)).select("prs_id", "s", "prs_percentile")


@query
def hot_score_ranks(st: Study) -> DataFrame:
    """The way taken for scores that very many people share."""
    return distribution.standardised_scores(evaluated(st), rows_per_key=10).select("prs_id", "s", "prs_percentile")


@query
def standardised_scores(st: Study) -> DataFrame:
    return sinks.standardised_columns(distribution.standardised_scores(evaluated(st)), TARGET)


def _degenerate(st: Study) -> distribution.ScoredCohort:
    signs = scores(st).withColumn("total_score", F.signum("total_score"))
    return evaluate_models.evaluate(signs, members(st), cases(st))


@query
def degenerate_scores(st: Study) -> DataFrame:
    return distribution.standardised_scores(_degenerate(st)).select(
        "prs_id", "s", "prs_zscore", "prs_percentile", "risk_category", "prs_decile"
    )


@query
def degenerate_summary(st: Study) -> DataFrame:
    return evaluation.model_summary(_degenerate(st))


@query
def describe_scores(st: Study) -> DataFrame:
    return distribution.describe_scores(evaluated(st))


@query
def histogram(st: Study) -> DataFrame:
    return distribution.histogram(evaluated(st))


@query
def kernel_density(st: Study) -> DataFrame:
    return distribution.kernel_density(evaluated(st))


# --- evaluation ---


@query
def decile_prevalence(st: Study) -> DataFrame:
    return evaluation.decile_prevalence(evaluated(st))


@query
def roc_curve(st: Study) -> DataFrame:
    return evaluation.roc_curve(evaluated(st))


@query
def roc_auc(st: Study) -> DataFrame:
    return evaluation.roc_auc(evaluated(st))


@query
def tail_thresholds(st: Study) -> DataFrame:
    return evaluation.tail_thresholds(evaluated(st))


@query
def tail_comparison(st: Study) -> DataFrame:
    return evaluation.tail_comparison(evaluated(st))


@query
def contingency(st: Study) -> DataFrame:
    return evaluation.contingency(evaluation.tail_comparison(evaluated(st)))


@query
def fisher_tails(st: Study) -> DataFrame:
    return evaluation.tail_odds(evaluated(st))


@query
def odds_ratio_per_sd(st: Study) -> DataFrame:
    return logistic.odds_ratio_per_sd(evaluated(st))


@query
def model_summary(st: Study) -> DataFrame:
    return evaluation.model_summary(evaluated(st))


@query
def summary_text(st: Study) -> DataFrame:
    return evaluation.summary_text(evaluation.model_summary(evaluated(st)))


@query
def evaluate_files(st: Study) -> DataFrame:
    base = new_path(st.spark, "evaluation")
    sinks.write_scores(scores(st), f"{base}/scores", f"{base}/scores_csv")
    sinks.write_sample_ids(members(st), f"{base}/cohort_csv")
    sinks.write_cases(cases(st), f"{base}/cases_csv")
    return evaluate_models.evaluate_files(
        st.spark, f"{base}/scores_csv", f"{base}/cohort_csv", f"{base}/cases_csv", TARGET, base
    )


# --- whole study and reuse ---


@query
def whole_study(st: Study) -> DataFrame:
    base = new_path(st.spark, "study")
    summary = study.run_study(
        st.spark, base, parameters(st, base), TARGET, st.genotypes(), st.table("condition_occurrence"),
        st.table("person"), st.table("cb_search_person"), st.table("flagged_samples"), st.manifest(), _with_unmatched(st),
    )
    return summary.select("prs_id", "n_weights", "n_loci", "status", "n_analysed")


def _damaged_file(st: Study) -> str:
    """A file that calls itself gzip and is not."""
    path = f"{new_path(st.spark, 'damaged')}/damaged.txt.gz"
    there = st.spark._jvm.org.apache.hadoop.fs.Path(path)
    out = there.getFileSystem(st.spark._jsc.hadoopConfiguration()).create(there)
    out.write(bytearray(b"hm_chr\thm_pos\teffect_allele\teffect_weight\n1\t2\tA\t0.5\n"))
    out.close()
    return path


@query
def study_from_manifest(st: Study) -> DataFrame:
    """The whole study of everybody eligible from scoring files, of which one is absent and one damaged."""
    base = new_path(st.spark, "study_files")
    more = st.spark.createDataFrame([("PGSZ", _damaged_file(st), TARGET)], "id string, url string, phenotype string")
    sinks.write_csv(_written_manifest(st).unionByName(more), f"{base}/manifest")
    return study.run_study(
        st.spark, base, replace(parameters(st, base), sample=False), TARGET, st.genotypes(), st.table("condition_occurrence"),
        st.table("person"), st.table("cb_search_person"), st.table("flagged_samples"), readers.read_manifest(st.spark, f"{base}/manifest"),
    )


@query
def checkpoint_reuse(st: Study) -> DataFrame:
    """The second call finds what the first one wrote and never builds."""
    base = new_path(st.spark, "reuse")
    settings = {"source": st.sf_dir, "step": "weights"}

    def must_not_build() -> DataFrame:
        raise AssertionError("the written table was not reused")

    checkpoint_or_compute(st.spark, base, settings, lambda: locus_weights(st))
    again = checkpoint_or_compute(st.spark, base, settings, must_not_build)
    return again.groupBy("prs_id").agg(F.count(F.lit(1)).alias("n"))


# --- association scan ---


@query
def phecode_case_counts(st: Study) -> DataFrame:
    return phewas.phecode_case_counts(st.table("phewas_cohort"), st.table("phecode_counts"))


def _scan(people: DataFrame, counts: DataFrame) -> DataFrame:
    return phewas.association_scan(people, counts, "sv_status", COVARIATES, "sex_code")


@query
def association_scan(st: Study) -> DataFrame:
    return _scan(st.table("phewas_cohort"), st.table("phecode_counts"))


def _ruled_scan(st: Study, male_as_one: bool, use_exclusions: bool) -> DataFrame:
    rules = phewas.RiskRules(st.table("phecode_definitions"), "sex_code", male_as_one, use_exclusions)
    return phewas.association_scan(
        st.table("phewas_cohort"), st.table("numbered_counts"), "sv_status", COVARIATES, "sex_code", rules=rules
    )


@query
def association_scan_by_sex(st: Study) -> DataFrame:
    """Phecodes of one sex are tested in it; women are coded 1."""
    return _ruled_scan(st, male_as_one=False, use_exclusions=False)


@query
def association_scan_exclusions(st: Study) -> DataFrame:
    """Controls have no phecode of the excluded range."""
    return _ruled_scan(st, male_as_one=True, use_exclusions=True)


@query
def association_scan_files(st: Study) -> DataFrame:
    base = new_path(st.spark, "scan")
    sinks.write_csv(st.table("phewas_cohort"), f"{base}/cohort")
    sinks.write_csv(st.table("phecode_counts").withColumnRenamed("n", "count"), f"{base}/counts")
    people = readers.read_scan_cohort(st.spark, f"{base}/cohort", ["sv_status", *COVARIATES, "sex_code"])
    results = _scan(people, readers.read_phecode_counts(st.spark, f"{base}/counts"))
    sinks.write_csv(results, f"{base}/results")
    types = dict(results.dtypes)
    return readers.read_text_columns(st.spark, f"{base}/results", types)


@query
def bonferroni(st: Study) -> DataFrame:
    return phewas.scan_summary(association_scan(st))
