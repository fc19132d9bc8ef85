"""Readers that give raw rows (dataset_id, row_index, raw): one dataset per file, 1-based positions in file order."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sft_tables.functions.text import nonblank
from sft_tables.operators.formats import SAMPLE_ROWS
from sft_tables.operators.rows import json_value
from sft_tables.session import written
from sft_tables.sources.arrays import json_array_errors, read_json_array, read_json_table, refused_of, rows_of  # noqa: F401
from sft_tables.sources.files import list_files, open_text
from sft_tables.sources.tables import csv_errors, read_csv, read_csv_table  # noqa: F401

BOM = "\ufeff"
RAW = "dataset_id string, row_index bigint, raw string"


def number_rows(df: DataFrame, name: str = "row_index") -> DataFrame:
    """Add the 1-based position of each row within its file; ``df`` is a file scan.

    A scan task reads the blocks it was given in order, so the position is the offset inside the block plus the rows of
    the earlier blocks of that file. A first pass, which is run here, counts the rows of every block; its result is
    written down, so that the planner knows its size, broadcasts it where it is small, and moves rows only beyond that.
    """
    block = ["_file", "_start"]
    marked = df.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
    ).withColumn("_id", F.monotonically_increasing_id())
    counts = marked.groupBy(*block).agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*block, "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    position = F.col("_id") - F.col("_first") + F.col("_offset") + 1
    return marked.join(written(offsets, "blocks"), block).select(F.col("_file").alias("dataset_id"), position.cast("bigint").alias(name), *df.columns)


def order_rows(df: DataFrame, name: str = "row_index") -> DataFrame:
    """The same in one pass, for readers that need the order only: numbers that grow along each file, with gaps.

    A block starts at a multiple of the split size and a task reads at most a split, so the start of the block plus the
    row's number within its task grows from block to block; every line has at least one byte.
    """
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return df.select(F.col("_metadata.file_path").alias("dataset_id"), (F.col("_metadata.file_block_start") + within + 1).alias(name), *df.columns)


def _without_bom(text: Column, first: Column) -> Column:
    return F.when(first & F.startswith(text, F.lit(BOM)), F.substr(text, F.lit(2))).otherwise(text)


def read_jsonl(spark: SparkSession, path: str | list[str], positions: bool = False) -> DataFrame:
    """One row per non-blank line; files are split among tasks. Broken lines stay as they are and become rows of kind
    'corrupt' (see ``jsonl_errors``). ``row_index`` grows along the file, with gaps, and the files are read once
    (detection then reads ``read_jsonl_head``); with ``positions`` it is the position among these lines, which takes a
    first pass over the files that is run here."""
    lines = spark.read.text(path).filter(nonblank("value"))
    rows = number_rows(lines) if positions else order_rows(lines)
    mark = F.col("row_index") == 1 if positions else F.lit(True)
    return rows.select("dataset_id", "row_index", _without_bom(F.col("value"), mark).alias("raw"))


def jsonl_errors(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Non-blank lines that are no JSON, with their line number in the file."""
    lines = number_rows(spark.read.text(path), "line")
    text = _without_bom(F.col("value"), F.col("line") == 1)
    broken = nonblank("value") & json_value(text).isNull()
    return lines.filter(broken).select("dataset_id", "line", F.lit("BAD_JSON").alias("code"))


def read_jsonl_head(spark: SparkSession, path: str | list[str], n: int = SAMPLE_ROWS) -> DataFrame:
    """The first n non-blank lines of every file, for detection: the rest of the files is not read."""
    def head(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri in batch["path"]:
                with open_text(uri) as stream:
                    lines = ((uri, i, line.rstrip("\r\n")) for i, line in enumerate(stream, 1) if line.strip())
                    yield pd.DataFrame(list(islice(lines, n)), columns=["dataset_id", "row_index", "raw"])

    found = list_files(spark, path).select("path").mapInPandas(head, RAW)
    order = Window.partitionBy("dataset_id").orderBy("row_index")
    return found.withColumn("row_index", F.row_number().over(order).cast("bigint"))


def read_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Typed rows with dataset_id and row_index; columns nobody asks for are not read."""
    df = spark.read.parquet(path)
    return df.select(F.col("_metadata.file_path").alias("dataset_id"), (F.col("_metadata.row_index") + 1).alias("row_index"), *df.columns)


def read_chatml_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Every text file is one conversation in ChatML."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(
        F.col("_metadata.file_path").alias("dataset_id"), F.lit(1).cast("bigint").alias("row_index"),
        F.to_json(F.array(_without_bom(F.col("value"), F.lit(True)))).alias("raw"),
    ).withColumn("raw", F.expr("substring(raw, 2, length(raw) - 2)"))


SLICE = re.compile(r"(?P<split>[^\[\]]+)(?:\[(?P<start>\d*):(?P<stop>\d*)\])?")


def select_split(df: DataFrame, subset: str | None = None, split: str = "train", load_options: dict | None = None) -> DataFrame:
    """Rows of one subset and split of a table with columns subset, split and row_index (0-based within the split);
    ``train[4:5]`` takes a slice."""
    if {"split", "name"} & set(load_options or {}):
        raise ValueError("give split and subset directly, not among the load options")
    wanted = SLICE.fullmatch(split)
    if wanted is None:
        raise ValueError(f"not a split: {split!r}")
    rows = df.filter(F.col("split") == wanted["split"])
    if subset is not None:
        rows = rows.filter(F.col("subset") == subset)
    if wanted["start"]:
        rows = rows.filter(F.col("row_index") >= int(wanted["start"]))
    if wanted["stop"]:
        rows = rows.filter(F.col("row_index") < int(wanted["stop"]))
    return rows
