"""Which source format is each file? Scores from the extension and a look at the start of the file.

Files are listed by Spark; the start of each is read once, inside a task, and scored for all formats by expressions.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sft_tables.functions.text import nonblank
from sft_tables.operators.detect import SCORE, rank_candidates, select_format
from sft_tables.operators.formats import SOURCE_PRIORITY
from sft_tables.operators.rows import json_value
from sft_tables.sources.files import list_files, open_bytes, open_text

# Extensions, scores and sample sizes per source format.
EXTENSIONS = {
    "json": (".json",), "jsonl": (".jsonl", ".ndjson"), "csv": (".csv",), "parquet": (".parquet", ".pq"),
    "chatml_text": (".txt", ".chatml"),
}
MISSING_FILE_SCORE = {"json": "0.650", "jsonl": "0.700", "csv": "0.700", "parquet": "0.750", "chatml_text": "0.600"}
LOCAL_SUFFIXES = (".json", ".jsonl", ".ndjson", ".csv", ".parquet", ".pq", ".txt")
HUB_SCORE = "0.880"
CSV_SAMPLE, CHATML_SAMPLE, JSONL_LINES = 8192, 16384, 5
MARKERS = ("<|im_start|>", "<|im_end|>")
PARQUET_MAGIC = b"PAR1"
HEAD = "path string, magic binary, text string, separator string, header boolean, problem string"


def csv_dialect(uri: str) -> type[csv.Dialect]:
    with open_text(uri, newline="") as text:
        return csv.Sniffer().sniff(text.read(CSV_SAMPLE))


def _heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The start of every file, read once: its first bytes, enough text for all formats, and what a CSV sniffer says."""
    for batch in batches:
        rows = []
        for uri in batch["path"]:
            with open_bytes(uri) as data:
                magic = data.read(len(PARQUET_MAGIC))
            text = separator = header = problem = None
            try:
                with open_text(uri, newline="") as stream:
                    text = stream.read(CHATML_SAMPLE)
                    # whole lines as far as the line probe looks
                    while sum(map(bool, map(str.strip, text.splitlines()))) <= JSONL_LINES and (more := stream.readline()):
                        text += more
                sniffer, sample = csv.Sniffer(), text[:CSV_SAMPLE]
                separator, header = sniffer.sniff(sample).delimiter, sniffer.has_header(sample)
            except (OSError, UnicodeError, csv.Error) as error:
                problem = str(error)
            rows.append((uri, magic, text, separator, header, problem))
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in HEAD.split(", ")])


def _candidates() -> Column:
    """One struct per format from the start of a file: (adapter, confidence, matched, reason)."""
    text, lower = F.col("text"), F.lower("path")

    def named(name: str) -> Column:
        return lower.rlike("(?:" + "|".join(e.replace(".", "[.]") for e in EXTENSIONS[name]) + r")\z")

    def candidate(name: str, found: Column, score: Column, other: Column, yes: Column, no: Column) -> Column:
        found = F.coalesce(found, F.lit(False))
        return F.struct(F.lit(name).alias("adapter"), F.when(found, score).otherwise(other).cast(SCORE).alias("confidence"), found.alias("matched"),
                        F.when(found, yes).otherwise(no).alias("reason"))

    def by_name(name: str, yes: str, no: str) -> Column:
        return F.when(named(name), yes).otherwise(no)

    unread = F.concat(F.lit("cannot inspect file: "), F.coalesce("problem", F.lit("")))
    lines = F.slice(F.filter(F.split(text, "\n"), nonblank), 1, JSONL_LINES)
    parsed = F.forall(lines, lambda line: json_value(line).isNotNull())
    bracket = F.regexp_extract(text, r"(?U)\A[\s\x1c-\x1f]*(\S)", 1) == "["
    marked = F.lit(True)
    for m in MARKERS:
        marked = marked & F.contains(F.substring("text", 1, CHATML_SAMPLE), F.lit(m))
    return F.array(
        candidate("json", bracket, by_name("json", "0.990", "0.900"), F.when(text.isNull(), "0").otherwise(by_name("json", "0.450", "0")),
                  F.lit("top-level JSON array marker"), F.when(text.isNull(), unread).otherwise("no JSON array")),
        candidate("jsonl", (F.size(lines) > 0) & parsed, by_name("jsonl", "0.990", "0.900"),
                  F.when(F.size(lines) == 0, by_name("jsonl", "0.300", "0")).otherwise(by_name("jsonl", "0.350", "0")),
                  F.concat(F.size(lines).cast("string"), F.lit(" JSON line(s) parsed")),
                  F.when(F.size(lines) == 0, "file contains no JSON records").otherwise("a line is no JSON")),
        candidate("csv", F.col("separator").isNotNull() & (text != "") & (named("csv") | F.col("header")), by_name("csv", "0.980", "0.820"),
                  F.when(F.col("separator").isNull(), by_name("csv", "0.450", "0")).otherwise("0"),
                  F.concat(F.lit("delimited rows, separator "), "separator"), F.coalesce("problem", F.lit("not recognized as CSV"))),
        candidate("parquet", F.col("magic") == F.lit(PARQUET_MAGIC), F.lit("1"), by_name("parquet", "0.400", "0"), F.lit("Parquet magic bytes"),
                  F.lit("Parquet magic bytes are missing")),
        candidate("chatml_text", marked, F.lit("0.990"), F.lit("0"), F.lit("ChatML start/end markers"),
                  F.when(text.isNull(), unread).otherwise("ChatML markers not found")),
        candidate("huggingface", F.lit(False), F.lit("0"), F.lit("0"), F.lit(""), F.lit("source looks like a local file path")),
    )


def probe_sources(spark: SparkSession, path: str | list[str], partitions: int | None = None) -> DataFrame:
    """Ranked source candidates of every file below ``path``."""
    files = list_files(spark, path).select("path")
    if partitions:
        files = files.repartition(partitions)
    scores = files.mapInPandas(_heads, HEAD).select("path", F.inline(_candidates()))
    return rank_candidates(scores, "path", "adapter", SOURCE_PRIORITY)


def probe_names(names: DataFrame) -> DataFrame:
    """Ranked candidates for names (path) that are no existing files: extensions, else possibly a hub id."""
    path = F.col("path")
    lower = F.lower(path)

    def candidate(name: str, score: str, matched, reason: str):
        return F.struct(F.lit(name).alias("adapter"), F.when(matched, score).otherwise("0").cast(SCORE).alias("confidence"),
                        matched.alias("matched"), F.when(matched, reason).otherwise("no match").alias("reason"))

    def ends(suffixes):
        condition = F.lit(False)
        for suffix in suffixes:
            condition = condition | F.endswith(lower, F.lit(suffix))
        return condition

    local = path.rlike(r"\A[./\\]") | ends(LOCAL_SUFFIXES)
    hub = nonblank(path) & ~local
    candidates = [candidate(n, MISSING_FILE_SCORE[n], ends(EXTENSIONS[n]), "file extension") for n in EXTENSIONS]
    candidates.append(candidate("huggingface", HUB_SCORE, hub, "possible dataset identifier"))
    return rank_candidates(names.select("path", F.inline(F.array(*candidates))), "path", "adapter", SOURCE_PRIORITY)


def select_source(ranked: DataFrame, requests: DataFrame | None = None) -> DataFrame:
    """Chosen source adapter per path, or NOT_RECOGNIZED, AMBIGUOUS, UNKNOWN_FORMAT. requests: (path, requested)."""
    return select_format(ranked, requests, "path", "adapter", "source")
