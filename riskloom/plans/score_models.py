"""Scores of every model of a manifest in one pass over the genotypes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.genotypes import Genotypes
from riskloom.operators.intervals import extract_intervals
from riskloom.operators.scoring import score_models, scoring_loci, scoring_status
from riskloom.operators.weights import clean_weights, one_weight_per_locus
from riskloom.schema import EmptyInputError
from riskloom.sources.readers import list_files, read_scoring_files
from riskloom.sources.stored import READ_ERRORS, Stored, checkpoint_or_compute, store


# Models whose scoring files are read by one job.
MODELS_PER_JOB = 500


def load_weights(spark: SparkSession, manifest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean weights of all readable models, one row per model that could not be read).

    The manifest is the run's configuration: a short list, read on the driver.
    Files of any accepted headings are read by one scan; a model whose file is
    missing, damaged or lacks a field does not stop the others.
    """
    models = {m["id"]: m["url"] for m in manifest.select("id", "url").collect()}
    failed: list[tuple[str, str]] = []
    files: dict[str, list[str]] = {}
    for model, url in models.items():
        files[model] = list_files(spark, url)
        if not files[model]:
            failed.append((model, f"no file at {url}"))
    present = [m for m in models if files[m]]
    written = []
    for start in range(0, len(present), MODELS_PER_JOB):
        written += _write_readable(spark, {m: files[m] for m in present[start : start + MODELS_PER_JOB]}, failed)
    if not written:
        raise EmptyInputError(f"no scoring file could be read: {failed}")
    weights = one_weight_per_locus(reduce(DataFrame.unionByName, written), ["prs_id"])
    return weights, spark.createDataFrame(failed, "prs_id string, error string")


def _write_readable(spark: SparkSession, files: dict[str, list[str]], failed: list[tuple[str, str]]) -> list[DataFrame]:
    """Write the models' weights in one job; if a file turns out damaged, each half of the models in its own."""
    if not files:
        return []
    try:
        raw, without = read_scoring_files(spark, files)
        weights = [store(clean_weights(raw, ["prs_id"]), "weights").df] if raw is not None else []
        failed += without
        return weights
    except READ_ERRORS as e:
        if len(files) == 1:
            failed.append((next(iter(files)), str(e).splitlines()[0]))
            return []
        models = list(files)
        halves = models[: len(models) // 2], models[len(models) // 2 :]
        return [table for half in halves for table in _write_readable(spark, {m: files[m] for m in half}, failed)]


def prepared_weights(spark: SparkSession, base_path: str, manifest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean weights, their intervals per model), each built only if not written before."""
    models = {m["id"]: m["url"] for m in manifest.select("id", "url").collect()}
    weights = checkpoint_or_compute(
        spark, base_path, {"artefact": "weights", "models": models}, lambda: load_weights(spark, manifest)[0]
    )
    intervals = checkpoint_or_compute(
        spark, base_path, {"artefact": "intervals", "models": models}, lambda: extract_intervals(weights, ["prs_id"])
    )
    return weights, intervals


def score_manifest(
    genotypes: Genotypes, manifest: DataFrame, weights: DataFrame, members: DataFrame | None = None, failed: DataFrame | None = None
) -> tuple[Stored, DataFrame]:
    """(scores, status per model); models without usable loci have a status but no scores.

    ``failed`` lists models whose files could not be read (prs_id, error).
    """
    clean = store(weights, "weights")
    loci = scoring_loci(clean, genotypes.variants)
    scores = store(score_models(genotypes, loci, members), "scores")
    status = scoring_status(manifest, clean.df, loci)
    if failed is not None:
        unread = failed.select("prs_id").distinct().withColumn("_unread", F.lit(True))
        status = status.join(unread, "prs_id", "left").withColumn("status", F.when(F.col("_unread"), "unreadable").otherwise(F.col("status")))
        status = status.drop("_unread")
    return scores, status
