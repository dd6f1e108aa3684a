"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR  data folder (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default: all)
BENCH_RUNS    runs of each query, of which the median counts (default 1)

The queries named ``stored_...`` score all models on a cohort that was written before the clock started, in each of
its layouts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import registry  # noqa: E402
from checks.fixtures import Study  # noqa: E402
from riskloom.operators import scoring, tiles  # noqa: E402
from riskloom.plans import cohort_build  # noqa: E402
from riskloom.sources import layouts  # noqa: E402
from riskloom.sources.stored import new_path, store  # noqa: E402

HEADLINE = [
    "stratified_sample",
    "base_cohort",
    "sparse_base_cohort",
    "split_reference_blocks",
    "scoring_files",
    "interval_semi_join",
    "score_one_model",
    "score_all_models",
    "score_blocked",
    "score_pruned",
    "score_tiled",
    "score_many_loci",
    "standardised_scores",
    "decile_prevalence",
    "roc_curve",
    "kernel_density",
    "odds_ratio_per_sd",
    "model_summary",
    "association_scan",
    "association_scan_exclusions",
    "whole_study",
    "study_from_manifest",
]


def one_pass_per_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What scoring costs when every model reads the genotypes for itself."""
    st = Study(spark, sf_dir)
    parts = []
    for model in ("PGSA", "PGSB", "PGSC"):
        loci = scoring.scoring_loci(registry.locus_weights(st).where(F.col("prs_id") == model), st.variants())
        parts.append(scoring.score_models(st.genotypes(), loci, registry.members(st)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def stored_layouts(spark: SparkSession, sf_dir: str) -> dict:
    """Scoring of all models on each written layout of everybody's genotypes."""
    st = Study(spark, sf_dir)
    located = cohort_build.read_cohort_genotypes(spark, registry.build_base(st, st.genotypes(), sample=False))
    tiled = registry.written_tiles(st)
    bucketed = layouts.write_bucketed(st.genotypes(), new_path(spark, "bench-buckets"))
    loci, members = registry.loci(st), store(registry.members(st), "bench-members").df
    some = scoring.scoring_loci(registry.locus_weights(st).where(F.col("contig") == "chr2"), st.variants())
    return {
        "stored_long": lambda spark, sf_dir: scoring.score_models(located, loci, members),
        "stored_long_one_contig": lambda spark, sf_dir: scoring.score_models(located, some, members),
        "stored_tiled": lambda spark, sf_dir: tiles.score_tiled(tiled, loci, members),
        "stored_bucketed": lambda spark, sf_dir: scoring.score_models(bucketed, loci, members, row_limit=0),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "*")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", os.environ.get("BENCH_CPUS", str(os.cpu_count())))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    runs = {name: queries[name] for name in HEADLINE}
    runs["score_one_pass_per_model"] = one_pass_per_model
    runs |= stored_layouts(spark, sf_dir)

    # Start the JVM's compilers and the Python workers before the clock.
    runs["score_all_models"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spent = {}
    for name, run in runs.items():
        times = []
        for _ in range(int(os.environ.get("BENCH_RUNS", "1"))):
            start = time.perf_counter()
            run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        spent[name] = round(statistics.median(times), 3)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(spent.values()), 3),
                "unit": "sec",
                "queries": spent,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
                "cpus": spark.sparkContext.defaultParallelism,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
