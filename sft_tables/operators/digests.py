"""Content digests of normalized datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAN_OUT = 4096
LEVELS = 4
TURN_LEVELS = 2


def dataset_digest(sft: DataFrame, key: str = "dataset_id", index: str = "row_index") -> DataFrame:
    """One SHA-256 per dataset over its rows in order, whatever the partitioning.

    A tree of fixed depth: rows are hashed, then 4096 neighbours at a time, four times. No group has more
    than 4096 entries for datasets up to 4096^4 rows, and each level shuffles 4096 times less than the last.
    ``index`` is the 1-based position of the row. Rows with several turns (a column ``turn``, numbered from 1) are
    hashed turn by turn first, 4096 at a time too, so the order of turns counts.
    """
    # byte lengths in front keep the three texts apart whatever characters they hold
    row = F.sha2(F.concat(
        F.octet_length("instruction"), F.lit(":"), F.octet_length("input"), F.lit(":"), "instruction", "input", "output"), 256)
    position = (F.col(index) - 1).alias("_at")
    if "turn" in sft.columns:
        turns = sft.filter("turn IS NOT NULL").select(key, position, (F.col("turn") - 1).alias("_place"), row.alias("_sha"))
        for _ in range(TURN_LEVELS):
            turns = _folded(turns, [key, "_at"], "_place")
        level = sft.filter("turn IS NULL").select(key, position, row.alias("_sha")).unionByName(turns.select(key, "_at", "_sha"))
    else:
        level = sft.select(key, position, row.alias("_sha"))
    for _ in range(LEVELS):
        level = _folded(level, [key], "_at")
    return level.select(key, F.col("_sha").alias("sha256"))


def _folded(level: DataFrame, keys: list[str], place: str) -> DataFrame:
    """One hash for every 4096 neighbouring places."""
    ordered = F.array_sort(F.collect_list(F.struct(place, "_sha")))
    joined = F.array_join(F.transform(ordered, lambda x: x["_sha"]), "")
    bucket = F.floor(F.col(place) / FAN_OUT).cast("bigint").alias("_bucket")
    return level.groupBy(*keys, bucket).agg(F.sha2(joined, 256).alias("_sha")).select(*keys, F.col("_bucket").alias(place), "_sha")
