"""Time the headline queries: one JSON line with seconds per query.

Every query writes all its rows to the ``noop`` sink. One small warm-up run per query keeps class loading
and code generation out of the measured time. The tables are first stored in one file per core, as they would
be on a cluster: a single small file is a single task, however many cores there are.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from sft_tables.plans import registry
from sft_tables.plans.fixtures import TABLES

HEADLINE = (
    "validate_turns", "expand_turns", "expand_messages", "row_model", "detect_dataset_format", "convert_dataset",
    "conversion_violations", "convert_rag_pages", "train_benchmark_overlap", "dataset_digest", "strip_text", "redact_text",
    "redact_pages", "split_records", "classify_records", "throttle_progress", "filter_verbosity_concise", "run_log_summary",
    "resolve_compatibility", "validate_job", "estimate_training", "admit_gpus", "assign_run_ids", "training_metrics",
    "validate_lora_artifacts", "storage_by_run", "owned_resources", "reconcile_registrations",
)


def in_files(spark: SparkSession, sf_dir: str, files: int) -> str:
    """The tables of a folder with so many files each."""
    folder = tempfile.mkdtemp(prefix="bench-")
    for table in TABLES:
        spark.read.parquet(f"{sf_dir}/{table}.parquet").repartition(files).write.parquet(f"{folder}/{table}.parquet")
    return folder


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("sft-tables-bench")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    seconds: dict[str, float] = {}
    tables = in_files(spark, sf_dir, int(cpus))
    for name in HEADLINE:
        if os.path.isdir(warm_dir):
            queries[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
        started = time.time()
        queries[name](spark, tables).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - started, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
