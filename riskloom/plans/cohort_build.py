"""Base cohort: exclude, select, label, sample, restrict, write, verify."""

from __future__ import annotations

import logging
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.blocks import MAX_BLOCK_LENGTH, split_reference_blocks
from riskloom.operators.cohort import (
    eligible_persons,
    exclude_flagged,
    restrict_calls,
    stratified_sample,
)
from riskloom.operators.genotypes import Genotypes, SparseGenotypes
from riskloom.operators.phenotype import label_cohort
from riskloom.schema import EmptyInputError
from riskloom.sources.readers import read_genotypes, read_sparse_genotypes
from riskloom.sources.sinks import verify_counts, write_genotypes, write_sample_ids
from riskloom.sources.stored import READ_ERRORS, content_digest, drop_record, fingerprint, read_if_present, store, write_record

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class CohortParameters:
    """What determines a base cohort beside the people; part of its path, so a change never reuses old data.

    ``source`` names the input genotypes (path or version).
    """

    source: str
    concept_ids: tuple[int, ...]
    sample: bool = True
    n_cases: int = 500
    n_controls: int = 500
    seed: int = 2025


def cohort_members(
    person: DataFrame, search_person: DataFrame, flagged: DataFrame | None, cases: DataFrame, parameters: CohortParameters
) -> DataFrame:
    """Labelled members: eligible, not flagged, and sampled if asked for.

    Flagged people leave before sampling, so the sample has its full size.
    """
    labelled = label_cohort(exclude_flagged(eligible_persons(person, search_person), flagged), cases)
    return sampled_members(labelled, parameters)


def sampled_members(labelled: DataFrame, parameters: CohortParameters) -> DataFrame:
    if not parameters.sample:
        return labelled
    return stratified_sample(labelled, parameters.n_cases, parameters.n_controls, parameters.seed)


def build_cohort(
    spark: SparkSession,
    base_path: str,
    parameters: CohortParameters,
    genotypes: Genotypes | SparseGenotypes,
    person: DataFrame,
    search_person: DataFrame,
    flagged: DataFrame | None,
    cases: DataFrame,
) -> str:
    """Write the base cohort and return its path; an intact earlier one is reused.

    Reference blocks of sparse genotypes are cut to the usual length.

    The path follows the parameters, the kind of genotypes, and the people with their labels as the lists given
    make them: with another exclusion or case list, or other eligible people, the cohort is built anew. ``complete``
    holds the counts and is written last, after the cohort was read back; an earlier cohort is used only while
    all its parts still have these counts.
    """
    kind = "sparse" if isinstance(genotypes, SparseGenotypes) else "dense"
    everyone = store(label_cohort(exclude_flagged(eligible_persons(person, search_person), flagged), cases), "labelled").df
    key = fingerprint(kind=kind, people=content_digest(everyone), **asdict(parameters))
    path = f"{base_path.rstrip('/')}/cohort-{key}"
    if is_intact(spark, path, kind):
        return path
    drop_record(spark, path)
    members = store(sampled_members(everyone, parameters), "cohort_members")
    if members.rows == 0:
        raise EmptyInputError("nobody is eligible for the cohort")
    kept = restrict_calls(genotypes, members.df)
    if isinstance(kept, SparseGenotypes):
        kept = replace(kept, reference_blocks=split_reference_blocks(kept.reference_blocks, MAX_BLOCK_LENGTH))
    if kept.samples.isEmpty():
        raise EmptyInputError("no cohort member is genotyped")
    expected = write_genotypes(kept, path)
    # Ids of the samples really present, with their labels.
    present = members.df.join(kept.samples, "s", "left_semi")
    write_sample_ids(present, f"{path}/ids")
    present.write.mode("overwrite").parquet(f"{path}/members")
    found = verify_counts(spark, path, expected).first()
    if found["verified"]:
        write_record(spark, path, expected | {"n_members": spark.read.parquet(f"{path}/members").count()})
    else:
        log.warning("cohort at %s holds %s, expected %s", path, found.asDict(), expected)
    return path


def is_intact(spark: SparkSession, path: str, kind: str) -> bool:
    """Whether the completion record is there and every part still has the recorded number of rows."""
    parts = {"n_samples": "samples", "n_variants": "variants", "n_calls": "calls", "n_members": "members"}
    if kind == "sparse":
        parts["n_blocks"] = "reference_blocks"
    try:
        record = read_if_present(spark, f"{path}/complete")
        recorded = record.first().asDict() if record is not None else {}
        if set(recorded) != set(parts):
            return False
        # Counting without columns reads the files' footers only.
        tables = {name: read_if_present(spark, f"{path}/{part}") for name, part in parts.items()}
        return all(t is not None and t.count() == recorded[name] for name, t in tables.items())
    except READ_ERRORS:
        return False


def read_cohort_genotypes(spark: SparkSession, path: str) -> Genotypes:
    return read_genotypes(spark, path)


def read_sparse_cohort(spark: SparkSession, path: str) -> SparseGenotypes:
    return read_sparse_genotypes(spark, path)


def read_members(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/members").select("s", F.col("phenotype_status").cast("long").alias("phenotype_status"))
