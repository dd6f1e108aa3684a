"""Who is in the study: eligibility, exclusion, sampling, restriction."""

from __future__ import annotations

from typing import TypeVar

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.genotypes import Genotypes, SparseGenotypes
from riskloom.schema import EmptyInputError, require_schema
from riskloom.sources.stored import store

AnyGenotypes = TypeVar("AnyGenotypes", Genotypes, SparseGenotypes)


def eligible_persons(person: DataFrame, search_person: DataFrame) -> DataFrame:
    """Persons flagged as having both health records and whole-genome data, as ``s``."""
    has_both = search_person.where(
        (F.col("has_ehr_data") == 1) & (F.col("has_whole_genome_variant") == 1)
    ).select("person_id").distinct()
    return person.join(has_both, "person_id", "left_semi").select(
        F.col("person_id").cast("string").alias("s")
    )


def exclude_flagged(
    samples: DataFrame, flagged: DataFrame | None, id_column: str = "sample_id"
) -> DataFrame:
    """Samples not on the exclusion list; ids compare as text. No list excludes nobody."""
    if flagged is None:
        return samples
    require_schema(flagged, {id_column: None}, "exclusion list")
    ids = flagged.select(F.col(id_column).cast("string").alias("s")).distinct()
    return samples.join(ids, "s", "left_anti")


def stratified_sample(
    labelled: DataFrame, n_cases: int = 500, n_controls: int = 500, seed: int = 2025
) -> DataFrame:
    """Exactly min(n, available) cases and controls, reproducible for a seed.

    People are taken in order of md5('seed:s'). Counting the 4,096 three-digit
    prefixes of that hash shows which of them lie wholly inside the sample, so
    only the chosen people and those sharing the last prefix are ever sorted.
    Who is listed twice is one person, with the greatest status; any status but
    1 is a control's.
    """
    others = [c for c in labelled.columns if c not in ("s", "phenotype_status")]
    once = labelled.groupBy("s").agg(F.max(F.struct("phenotype_status", *others)).alias("_row")).select("s", "_row.*")
    is_case = F.coalesce(F.col("phenotype_status") == 1, F.lit(False))
    people = once.select(*labelled.columns, is_case.alias("_is_case"), F.md5(F.concat(F.lit(f"{seed}:"), "s")).alias("_key"))
    # Both readers below, the counts and the choice, see the labels as they were written here.
    keyed = store(people.withColumn("_prefix", F.substring("_key", 1, 3)), "sampling_order").df
    wanted = F.when(F.col("_is_case"), n_cases).otherwise(n_controls)
    stratum = ["_is_case", "_prefix"]
    sizes = keyed.groupBy(*stratum).agg(F.count(F.lit(1)).alias("_size"))
    # At most 4,096 rows per stratum, here and in the broadcast.
    earlier = Window.partitionBy("_is_case").orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    reached = sizes.select(*stratum, F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before")).where(
        F.col("_before") < wanted
    )
    place = F.row_number().over(Window.partitionBy(*stratum).orderBy("_key", "s"))
    return (
        keyed.join(F.broadcast(reached), stratum)
        .withColumn("_place", place)
        .where(F.col("_before") + F.col("_place") <= wanted)
        .select(*labelled.columns)
    )


def restrict_calls(genotypes: AnyGenotypes, members: DataFrame) -> AnyGenotypes:
    """Genotypes of the given samples only, in every component; variants are kept."""
    kept = genotypes.samples.join(members.select("s").distinct(), "s", "left_semi")
    return genotypes.with_samples(store(kept, "kept_samples"))


def restrict_to_id_list(genotypes: AnyGenotypes, ids: DataFrame) -> AnyGenotypes:
    """As ``restrict_calls`` for a ``person_id`` list; nobody left is an error."""
    members = ids.select(F.col("person_id").cast("string").alias("s")).distinct()
    kept = restrict_calls(genotypes, members)
    if kept.samples.isEmpty():
        raise EmptyInputError("no genotyped sample is on the id list")
    return kept


def exclude_from_sparse(genotypes: SparseGenotypes, flagged: DataFrame | None) -> SparseGenotypes:
    """Drop flagged samples from both components, through one kept-sample list."""
    return genotypes.with_samples(store(exclude_flagged(genotypes.samples, flagged), "kept_samples"))
