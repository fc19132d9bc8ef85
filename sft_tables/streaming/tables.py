"""Streams that keep tables up to date: normalized rows, run status, redacted logs."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from sft_tables.operators.convert import convert_with
from sft_tables.operators.detect import rank_candidates, score_formats, select_format
from sft_tables.operators.formats import SAMPLE_ROWS
from sft_tables.operators.redact import redact_columns
from sft_tables.operators.rows import first_rows, to_row_model
from sft_tables.session import written
from sft_tables.sources.sinks import conversion_table

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_to_end(writer) -> None:
    """Process what is there and stop."""
    query: StreamingQuery = writer.trigger(availableNow=True).start()
    query.awaitTermination()


class Normalization:
    """Raw rows (dataset_id, row_index, raw), as they come, to rows and violations below ``out/batches``.

    The format of a dataset is chosen once and then frozen. Choices that are known beforehand are given as ``selection``;
    any other dataset is detected when ``rows`` of its rows have come, or ``patience`` batches after its first one. Until
    then its rows wait, fewer than ``rows`` per dataset. So every row that came in is in a row, a row violation, a refused
    dataset, or waiting; refused datasets are one violation each, in the batch of their choice.

    A batch writes only folders of its own (its results, its choices, and the rows that wait, in one of two places by
    turns), and reads those of earlier batches, so one that is repeated after a failure leaves no duplicates. Rows of known
    datasets are not shuffled.
    """

    WAITING = "dataset_id string, row_index bigint, raw string, since bigint"
    CHOICES = "dataset_id string, format string, confidence decimal(4,3), code string"
    RESULTS = ("dataset_id string, row_index bigint, turn bigint, code string, detail string, instruction string, input string, output string, "
               "batch_id bigint, outcome string")

    def __init__(self, spark, out: str, selection: DataFrame | None = None, require: str | None = "sft", rows: int = SAMPLE_ROWS,
                 patience: int | None = None):
        self.spark, self.out, self.require, self.rows, self.patience = spark, out, require, rows, patience
        self.last: int | None = None
        none = spark.createDataFrame([], self.CHOICES)
        given = none if selection is None else selection.select("dataset_id", "format", F.col("confidence").cast("decimal(4,3)"), "code")
        given.filter("dataset_id IS NOT NULL").write.mode("ignore").parquet(f"{out}/formats/batch_id=-1")
        for turn in (0, 1):
            spark.createDataFrame([], self.WAITING).write.mode("ignore").parquet(self.place(turn))

    def place(self, batch_id: int) -> str:
        return f"{self.out}/waiting/turn={batch_id % 2}"

    def formats(self) -> DataFrame:
        return self.spark.read.schema(f"{self.CHOICES}, batch_id bigint").parquet(f"{self.out}/formats")

    def waiting(self, batch_id: int) -> DataFrame:
        """The rows that wait after a batch."""
        return self.spark.read.schema(self.WAITING).parquet(self.place(batch_id))

    def results(self) -> DataFrame:
        """Rows and violations so far."""
        return self.spark.read.schema(self.RESULTS).parquet(f"{self.out}/batches")

    def choose(self, sample: DataFrame, batch_id: int) -> None:
        """Write down the formats of datasets by their first rows."""
        choices = select_format(rank_candidates(score_formats(to_row_model(sample))))
        choices.select("dataset_id", "format", F.col("confidence").cast("decimal(4,3)"), "code").write.mode("overwrite").parquet(
            f"{self.out}/formats/batch_id={batch_id}")

    def write(self, batch: DataFrame, batch_id: int, finish: bool = False) -> None:
        batch = batch.select("dataset_id", "row_index", "raw").persist()
        before = self.formats().filter(F.col("batch_id") < batch_id)
        known = before.select("dataset_id")
        new = batch.filter("dataset_id IS NOT NULL").join(known, "dataset_id", "left_anti").withColumn("since", F.lit(batch_id).cast("bigint"))
        unknown = new.unionByName(self.waiting(batch_id - 1)).persist()
        enough = F.count(F.lit(1)) >= self.rows
        if self.patience is not None:
            enough = enough | (F.min("since") <= batch_id - self.patience)
        ready = unknown.groupBy("dataset_id").agg((F.lit(finish) | enough).alias("_ready")).filter("_ready").select("dataset_id")
        ready = written(ready, "ready")
        if not ready.isEmpty():
            self.choose(first_rows(unknown.join(ready, "dataset_id").select("dataset_id", "row_index", "raw"), "row_index", self.rows), batch_id)
        here = self.formats().filter(F.col("batch_id") <= batch_id)
        unknown.join(ready, "dataset_id", "left_anti").select("dataset_id", "row_index", "raw", "since").write.mode("overwrite").parquet(self.place(batch_id))
        rows = batch.join(unknown.select("dataset_id").distinct(), "dataset_id", "left_anti").unionByName(
            unknown.join(ready, "dataset_id", "left_semi").drop("since"))
        done = convert_with(to_row_model(rows), here.drop("batch_id"), self.require)
        # given choices are refused in the first batch, others in the batch that made them
        made = here.filter(F.col("batch_id") == batch_id) if batch_id else here
        conversion_table(done, done.dataset_violations.join(made.select("dataset_id"), "dataset_id", "left_semi")).write.partitionBy(
            "outcome").mode("overwrite").parquet(f"{self.out}/batches/batch_id={batch_id}")
        unknown.unpersist()
        batch.unpersist()
        self.last = batch_id

    def finish(self, batch_id: int | None = None) -> None:
        """Choose formats for the datasets that still wait, with the rows there are, as a batch after the last one."""
        if batch_id is None:
            if self.last is None:
                return
            batch_id = self.last + 1
        self.write(self.spark.createDataFrame([], "dataset_id string, row_index bigint, raw string"), batch_id, finish=True)


def normalize_stream(raw_rows: DataFrame, normalization: Normalization, checkpoint: str):
    """Writer of a stream of raw rows by a ``Normalization``."""
    return raw_rows.writeStream.foreachBatch(normalization.write).option("checkpointLocation", checkpoint)


STATUS = "run_id {key}, status string, updated_at timestamp, seq bigint"
LAST = "ts timestamp, seq bigint, status string"


class LatestStatus(StatefulProcessor):
    """Keeps the latest status of a run until it has ended, or has been silent, for long enough."""

    def __init__(self, terminal: tuple[str, ...], grace: int, silence: int):
        self.terminal, self.grace, self.silence = terminal, grace, silence

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", LAST)

    def handleInputRows(self, key, rows, timerValues):
        known = self.last.get()
        best = known
        for batch in rows:
            for at, seq, status in zip(batch["ts"], batch["seq"], batch["status"]):
                now = (at.to_pydatetime(), int(seq), status)
                if best is None or now[:2] > tuple(best[:2]):
                    best = now
        if best is known:
            yield self.rows([], [], [], [])
            return
        self.last.update(best)
        if known is not None:  # a new run has no timer
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
        wait = self.grace if best[2] in self.terminal else self.silence
        self.handle.registerTimer(int(pd.Timestamp(best[0]).timestamp() * 1000) + wait)
        yield self.rows([key[0]], [best[2]], [best[0]], [best[1]])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.last.clear()
        yield self.rows([], [], [], [])

    def rows(self, run_id: list, status: list, at: list, seq: list) -> pd.DataFrame:
        return pd.DataFrame({"run_id": run_id, "status": pd.Series(status, dtype="object"), "updated_at": pd.Series(at, dtype="datetime64[ns]"),
                             "seq": pd.Series(seq, dtype="int64")})

    def close(self) -> None:
        pass


def run_status_stream(events: DataFrame, terminal: tuple[str, ...] = ("success", "failed"), delay: str = "1 hour", grace_minutes: int = 60,
                      silence_minutes: int = 60 * 24 * 7) -> DataFrame:
    """Latest status per run (run_id, status, updated_at, seq), by (ts, seq), to be written in update mode.

    Events may be late by ``delay``; later ones are dropped. The state of a run goes ``grace_minutes`` of event time after its
    terminal status, or ``silence_minutes`` after its last event if it never ends, so state does not grow with the runs there
    have been. An event after that starts the run's state anew. State is kept by Spark (RocksDB provider).
    """
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    key = events.schema["run_id"].dataType.simpleString()
    rows = events.select("run_id", F.col("ts").cast("timestamp").alias("ts"), "seq", "status").filter("run_id IS NOT NULL AND ts IS NOT NULL AND seq IS NOT NULL").withWatermark("ts", delay)
    latest = LatestStatus(terminal, grace_minutes * 60_000, silence_minutes * 60_000)
    return rows.groupBy("run_id").transformWithStateInPandas(latest, STATUS.format(key=key), "Update", "EventTime")


def redact_stream(records: DataFrame, columns: list[str], secrets: tuple[str, ...] = ()) -> DataFrame:
    """Whole records are redacted, so a secret cannot slip through between two chunks."""
    return redact_columns(records, columns, secrets)


def write_updates(stream: DataFrame, out: str, checkpoint: str):
    """Writer that keeps every update with the batch it came from."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return stream.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)


def write_rows(stream: DataFrame, out: str, checkpoint: str):
    return stream.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", checkpoint)
