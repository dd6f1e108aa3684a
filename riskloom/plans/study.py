"""The whole study: cases, base cohort, scores, evaluation, collated summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.operators.distribution import standardised_scores
from riskloom.operators.evaluation import model_summary
from riskloom.operators.genotypes import Genotypes
from riskloom.operators.phenotype import cases_by_concept
from riskloom.plans.cohort_build import CohortParameters, build_cohort, read_cohort_genotypes, read_members
from riskloom.plans.evaluate_models import collate, evaluate
from riskloom.plans.score_models import load_weights, score_manifest
from riskloom.sources.sinks import write_cases, write_csv, write_scores, write_standardised
from riskloom.sources.stored import store, temporary_tables


def run_study(
    spark: SparkSession,
    output_path: str,
    parameters: CohortParameters,
    target_name: str,
    genotypes: Genotypes,
    conditions: DataFrame,
    person: DataFrame,
    search_person: DataFrame,
    flagged: DataFrame | None,
    manifest: DataFrame,
    weights: DataFrame | None = None,
) -> DataFrame:
    """Run every step, write its artefacts below ``output_path``, return one row per model.

    Without ``weights`` the scoring files that the manifest names are read; a model whose file cannot be read has
    the status ``unreadable`` and its reason below ``output_path``. Only the artefacts stay: intermediate tables are deleted.
    """
    with temporary_tables(spark):
        cases = store(cases_by_concept(conditions, list(parameters.concept_ids)), "cases").df
        write_cases(cases, f"{output_path}/cases")
        path = build_cohort(spark, output_path, parameters, genotypes, person, search_person, flagged, cases)

        failed = None
        if weights is None:
            weights, failed = load_weights(spark, manifest)
            write_csv(failed, f"{output_path}/unreadable")
        members = read_members(spark, path)
        scores, status = score_manifest(read_cohort_genotypes(spark, path), manifest, weights, members, failed)
        write_scores(scores.df, f"{output_path}/scores/table", f"{output_path}/scores/csv")

        evaluated = evaluate(scores.df, members, cases)
        write_standardised(standardised_scores(evaluated), target_name, f"{output_path}/standardised_scores")
        summary = collate(model_summary(evaluated), status)
        summary.write.mode("overwrite").parquet(f"{output_path}/summary/table")
        written = spark.read.schema(summary.schema).parquet(f"{output_path}/summary/table")
        write_csv(written, f"{output_path}/summary/csv")
    return written
