"""Evaluation of all scored models against one phenotype."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.distribution import ScoredCohort, join_status, scored_cohort, standardised_scores
from riskloom.operators.evaluation import model_summary
from riskloom.operators.phenotype import label_cohort
from riskloom.sources.readers import read_case_labels, read_cohort, read_scores
from riskloom.sources.sinks import write_csv, write_standardised


def evaluate(scores: DataFrame, cohort: DataFrame, cases: DataFrame) -> ScoredCohort:
    """Label the cohort, keep people with scores, and prepare every evaluation table."""
    return scored_cohort(join_status(scores, label_cohort(cohort, cases)))


def evaluate_files(
    spark: SparkSession, scores_path: str, cohort_path: str, cases_path: str, target_name: str, output_path: str
) -> DataFrame:
    """Evaluate exported scores; writes standardised scores and the summary, returns the latter."""
    evaluated = evaluate(
        read_scores(spark, scores_path), read_cohort(spark, cohort_path), read_case_labels(spark, cases_path)
    )
    write_standardised(standardised_scores(evaluated), target_name, f"{output_path}/standardised_scores")
    summary = model_summary(evaluated)
    write_csv(summary, f"{output_path}/summary")
    return summary


def collate(summary: DataFrame, status: DataFrame) -> DataFrame:
    """One row per model of the manifest: its status and, if scored, its figures."""
    return status.join(summary, "prs_id", "left").orderBy(F.col("prs_id"))
