"""Exact dedup: group by 128-bit content hash, compare bytes inside groups, keep one row (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sft_tables.llm.common import lower_ascii


def exact_groups(docs: DataFrame, keep: str = "smallest", text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: (doc_id, keep_id, group_size, kept, text_sha256).

    Rows are equal when their texts are identical after lower-casing A-Z; null counts as empty text, so null and empty
    texts form one group. ``keep`` says whether the smallest or the largest id stays; a null id stays only where the
    group has no other. Repeated rows (same id and text) all count in ``group_size`` and share ``kept``. An empty table
    gives no rows; further columns are ignored.

    The 128-bit MD5 and the bytes themselves are the grouping key: bytes are compared wherever hashes agree, copies
    collapse before the shuffle, so a group may hold any share of all rows. Rows find their group by MD5, SHA-256 and
    length without moving texts again; both sides of that join are plain exchanges, so a hot group is split by
    adaptive execution.
    """
    best = F.max if keep == "largest" else F.min
    norm = lower_ascii(F.coalesce(F.col(text), F.lit("")))
    rows = docs.select(F.col(doc_id).alias("doc_id"), norm.alias("_norm")).withColumn("_h", F.unhex(F.md5("_norm")))
    groups = rows.groupBy("_h", "_norm").agg(best("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = groups.select("_h", *_digest(F.col("_norm")), "keep_id", "group_size")
    keyed = rows.select("doc_id", "_h", *_digest(F.col("_norm")))
    return keyed.join(groups, ["_h", "_sha", "_n"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


def _digest(norm: Column) -> tuple[Column, Column]:
    return F.unhex(F.sha2(norm, 256)).alias("_sha"), F.octet_length(norm).alias("_n")


def drop_exact_copies(docs: DataFrame, keep: str = "smallest", text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay, whole: one per group of equal texts.

    Among repeated rows with the kept id any one stays. Rows are taken by partial aggregation over (hash, bytes, ids),
    not by a window, so no group is gathered in one task.
    """
    norm = lower_ascii(F.coalesce(F.col(text), F.lit("")))
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    pick = F.max_by if keep == "largest" else F.min_by
    # a null id is chosen only where there is no other
    worst = -(2**63) if keep == "largest" else 2**63 - 1
    chosen = (
        docs.select(F.unhex(F.md5(norm)).alias("_h"), norm.alias("_norm"), F.coalesce(F.col(doc_id).cast("bigint"), F.lit(worst)).alias("_id"),
                    row.alias("_row"))
        .groupBy("_h", "_norm").agg(pick("_row", "_id").alias("_row"))
    )
    return chosen.select(*[F.col("_row")[f"c{i}"].alias(c) for i, c in enumerate(docs.columns)])


def query(spark, sf_dir: str) -> DataFrame:
    from sft_tables.llm.common import read_table

    return exact_groups(read_table(spark, sf_dir, "documents"), keep="largest")


SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(d.norm) AS text_sha256
FROM d JOIN g ON d.norm = g.norm
"""
