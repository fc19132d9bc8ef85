"""Session settings the operators rely on, and the one place that cuts lineage."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # JSON objects with a repeated key keep the last value instead of being refused
    "spark.sql.variant.allowDuplicateKeys": "true",
    # rows hold whole texts: batches for Python are bounded by bytes, so that off-heap buffers stay small
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    # folders are listed by this many tasks at most, not by one task a folder
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256",
}


def ship_package(spark: SparkSession) -> None:
    """Give executors this package (as ``--py-files`` would), once per Spark context."""
    context = spark.sparkContext
    if getattr(context, "_sft_tables_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="sft-tables-")) / "sft_tables.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent).as_posix())
    context.addPyFile(str(archive))
    context._sft_tables_shipped = True


def configure(spark: SparkSession) -> SparkSession:
    ship_package(spark)
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Where it is unset, only a session whose
    tasks run in the driver's own process (tests) gets a folder of its own; a cluster is refused."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context = spark.sparkContext
    if getattr(context, "_sft_tables_folder", None) is None:
        context._sft_tables_folder = tempfile.mkdtemp(prefix="sft-tables-shared-")
    return context._sft_tables_folder


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Checkpoints go to the shared folder."""
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared_folder(spark))


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new place for files derived by a query, in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """A table as written to the shared folder: its lineage is cut, and the planner knows its size."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
