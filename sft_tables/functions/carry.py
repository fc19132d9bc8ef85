"""Ordered carry within a key that may be arbitrarily large.

A window over ``partitionBy(key)`` puts the whole key into one task. Here the order column (an integer)
is cut into blocks: the window runs per (key, block), so a key with a third of all rows is spread over
many tasks, and only one summary row per block meets in the per-key window that passes values on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 16384
BLOCK_COL = "_blk"


def with_block(df: DataFrame, order: str, block: int = BLOCK) -> DataFrame:
    return df.withColumn(BLOCK_COL, F.floor(F.col(order) / F.lit(block)).cast("bigint"))


def block_window(keys: list[str], order: str):
    return Window.partitionBy(*keys, BLOCK_COL).orderBy(order)


def before(keys: list[str], order: str):
    """Frame: every earlier row of the same block."""
    return block_window(keys, order).rowsBetween(Window.unboundedPreceding, -1)


def earlier_blocks(keys: list[str]):
    return Window.partitionBy(*keys).orderBy(BLOCK_COL).rowsBetween(Window.unboundedPreceding, -1)


def last_in_block(marker: Column, order: str) -> Column:
    """Aggregate: the marker with the highest order among rows that have one."""
    return F.max_by(marker, F.when(marker.isNotNull(), F.col(order)))


def last_before(
    df: DataFrame, keys: list[str], order: str, markers: dict[str, Column], block: int = BLOCK
) -> DataFrame:
    """Add, per name, the last non-null marker of an earlier row of the same key."""
    base = with_block(df, order, block)
    local = base.select(
        "*", *[F.last(m, ignorenulls=True).over(before(keys, order)).alias(f"_in_{n}") for n, m in markers.items()]
    )
    summary = base.groupBy(*keys, BLOCK_COL).agg(
        *[last_in_block(m, order).alias(f"_out_{n}") for n, m in markers.items()]
    )
    carried = summary.select(
        *keys,
        BLOCK_COL,
        *[F.last(f"_out_{n}", ignorenulls=True).over(earlier_blocks(keys)).alias(f"_carry_{n}") for n in markers],
    ).filter(_any_not_null([f"_carry_{n}" for n in markers]))
    joined = local.join(carried, [*keys, BLOCK_COL], "left")
    return joined.select(
        *df.columns, *[F.coalesce(f"_in_{n}", f"_carry_{n}").alias(n) for n in markers]
    )


def running_total(df: DataFrame, keys: list[str], order: str, amount: Column, name: str, block: int = BLOCK) -> DataFrame:
    """Add the sum of ``amount`` over all earlier rows of the same key."""
    base = with_block(df, order, block).withColumn("_amount", amount)
    local = base.withColumn("_in", F.coalesce(F.sum("_amount").over(before(keys, order)), F.lit(0)))
    carried = (
        base.groupBy(*keys, BLOCK_COL).agg(F.sum("_amount").alias("_total"))
        .select(*keys, BLOCK_COL, F.sum("_total").over(earlier_blocks(keys)).alias("_carry"))
        .filter("_carry <> 0")
    )
    return local.join(carried, [*keys, BLOCK_COL], "left").select(
        *df.columns, (F.col("_in") + F.coalesce("_carry", F.lit(0))).cast("bigint").alias(name)
    )


def _any_not_null(names: list[str]) -> Column:
    condition = F.lit(False)
    for n in names:
        condition = condition | F.col(n).isNotNull()
    return condition
