"""Case definition and case/control labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.schema import require_schema

# Beyond this many concepts an IN list is worse than a join.
IN_LIST_LIMIT = 1000


def parse_concept_ids(text: str) -> list[int]:
    """'432510, 374919' -> [432510, 374919]; anything else raises ValueError."""
    try:
        return [int(part) for part in text.split(",")]
    except ValueError as e:
        raise ValueError(f"concept ids must be comma-separated integers: {text!r}") from e


def cases_by_concept(conditions: DataFrame, concepts: list[int] | DataFrame) -> DataFrame:
    """Distinct persons with any of the concepts: ``s``, ``phenotype_status`` = 1.

    ``concepts`` is a list, or a one-column DataFrame for a large concept set.
    """
    require_schema(conditions, {"person_id": None, "condition_concept_id": None}, "condition_occurrence")
    if isinstance(concepts, list) and not concepts:
        raise ValueError("no concept ids given")
    if isinstance(concepts, list) and len(concepts) > IN_LIST_LIMIT:
        concepts = conditions.sparkSession.createDataFrame([(c,) for c in concepts], "condition_concept_id long")
    if isinstance(concepts, list):
        hits = conditions.where(F.col("condition_concept_id").isin(concepts))
    else:
        wanted = concepts.toDF("condition_concept_id")
        hits = conditions.join(wanted, "condition_concept_id", "left_semi")
    return (
        hits.select(F.col("person_id").cast("string").alias("s"))
        .distinct()
        .select("s", F.lit(1).cast("long").alias("phenotype_status"))
    )


def label_cohort(cohort: DataFrame, cases: DataFrame, column: str = "phenotype_status") -> DataFrame:
    """Every cohort member once, with status 1 for cases and 0 for everybody else."""
    if "phenotype_status" not in cases.columns:
        cases = cases.withColumn("phenotype_status", F.lit(1))
    known = cases.groupBy(F.col("s").cast("string").alias("s")).agg(
        F.max("phenotype_status").cast("long").alias("_status")
    )
    members = cohort.select(F.col("s").cast("string").alias("s"))
    return members.join(known, "s", "left").select(
        "s", F.coalesce("_status", F.lit(0)).cast("long").alias(column)
    )


def status_column(target_name: str) -> str:
    """'Ischemic Stroke' -> 'Ischemic_Stroke_status'."""
    return target_name.replace(" ", "_") + "_status"


def split_by_status(labelled: DataFrame, column: str = "phenotype_status") -> tuple[DataFrame, DataFrame]:
    """(cases, controls)."""
    return labelled.where(F.col(column) == 1), labelled.where(F.col(column) == 0)


def status_frequency(labelled: DataFrame, column: str = "phenotype_status") -> DataFrame:
    return labelled.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
