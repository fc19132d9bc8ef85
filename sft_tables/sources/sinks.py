"""Writers, manifests and provenance tables."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sft_tables.operators.convert import Conversion
from sft_tables.sources.files import chunks, list_files, open_bytes

# Column roles of a normalized dataset, default split.
COLUMN_ROLES = {"prompt": "instruction", "query": "input", "response": "output"}
DEFAULT_SPLIT = "train"


def write_normalized(sft: DataFrame, path: str, fmt: str = "json") -> None:
    """SFT rows in row order, one folder per dataset. Ranges over (dataset, row) split a dominating dataset among
    tasks and keep its files in order."""
    order = [c for c in ("dataset_id", "row_index", "turn") if c in sft.columns]
    ranged = sft.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.select("dataset_id", "instruction", "input", "output").write.partitionBy("dataset_id").mode("overwrite").format(fmt).save(path)


def conversion_table(done: Conversion, refused: DataFrame | None = None) -> DataFrame:
    """Rows and violations of a conversion as one table with a column ``outcome``: 'row' or 'violation'.

    Refused datasets are violations without a row, so every input row is in a row, a row violation or a refused
    dataset. ``refused`` replaces the conversion's own list.
    """
    clean = F.col("fault").isNull()
    kept = done.checked.filter(~clean | ~F.col("gated"))
    flat = kept.select("dataset_id", "row_index", "fault", F.explode_outer(F.when(clean, F.col("sft"))).alias("r"))
    rows = flat.select(
        "dataset_id", "row_index", F.coalesce("r.turn", "fault.turn").alias("turn"), "fault.code", "fault.detail",
        "r.instruction", "r.input", "r.output", F.when(clean, "row").otherwise("violation").alias("outcome"))
    whole = (done.dataset_violations if refused is None else refused).select("dataset_id", "code", F.lit("violation").alias("outcome"))
    return rows.unionByName(whole, allowMissingColumns=True)


def write_conversion(done: Conversion, path: str, file_errors: DataFrame | None = None) -> None:
    """Rows and violations from one scan of the rows, partitioned by ``outcome``; ``file_errors`` (dataset_id, code,
    detail) are the files that a reader refused."""
    table = conversion_table(done)
    if file_errors is not None:
        table = table.unionByName(file_errors.withColumn("outcome", F.lit("violation")), allowMissingColumns=True)
    table.write.partitionBy("outcome").mode("overwrite").parquet(path)


def write_violations(violations: DataFrame, path: str, run_id: str) -> None:
    """Violations of one run; writing a run again replaces what it wrote before."""
    violations.write.partitionBy("dataset_id").mode("overwrite").parquet(f"{path}/run_id={run_id}")


def source_snapshot(config: DataFrame) -> DataFrame:
    """Descriptor of each source (dataset_id, source, source_format, subset, split)."""
    return config.select(
        "dataset_id", "source", F.coalesce("source_format", F.lit("auto")).alias("source_format"), "subset",
        F.coalesce("split", F.lit(DEFAULT_SPLIT)).alias("split"))


def dataset_manifest(sft: DataFrame, selection: DataFrame, snapshots: DataFrame, digests: DataFrame, base_path: str) -> DataFrame:
    """One row per normalized dataset: source, formats, sample count, location, digest and column roles."""
    counts = sft.groupBy("dataset_id").agg(F.count(F.lit(1)).alias("num_samples"))
    roles = F.create_map(*[F.lit(x) for kv in COLUMN_ROLES.items() for x in kv])
    return (
        counts.join(selection.select("dataset_id", "format", "confidence"), "dataset_id")
        .join(snapshots.select("dataset_id", "source", "source_format"), "dataset_id", "left")
        .join(digests, "dataset_id", "left")
        .select("dataset_id", "source", "source_format", "format", "confidence", "num_samples",
                F.concat(F.lit(f"{base_path}/dataset_id="), "dataset_id").alias("normalized_path"), "sha256", roles.alias("columns"))
    )


def _hash_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for uri, length in zip(batch["path"], batch["length"]):
            digest = hashlib.sha256()
            with open_bytes(uri) as stream:
                for piece in chunks(stream):
                    digest.update(piece)
            rows.append((uri, length, digest.hexdigest()))
        yield pd.DataFrame(rows, columns=["path", "size", "sha256"])


def file_digest(spark: SparkSession, path: str | list[str], partitions: int | None = None) -> DataFrame:
    """(path, size, sha256) of the exact bytes of every file, read in 1 MiB pieces inside tasks."""
    files = list_files(spark, path)
    if partitions:
        files = files.repartition(partitions)
    return files.mapInPandas(_hash_files, "path string, size bigint, sha256 string")
