"""Files as byte blocks: what a block looks like depends on the blocks before it, which one summary row per block settles.

Each file is listed as blocks of a fixed size. A first pass gives every block of a file with several blocks a summary, a
running total over the summaries (itself blocked, ``functions/carry.py``) gives every block the state it starts in, and a
second pass cuts the blocks into records in parallel. Records are written down once, numbered by block, and files with a
broken place anywhere give that place instead of rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sft_tables.functions.carry import running_total
from sft_tables.session import written
from sft_tables.sources.files import list_files, open_bytes

BLOCK_BYTES, MOST_TASKS = 8 << 20, 1 << 16
#: Files that a task opens where they are much smaller than a block.
FILES_PER_TASK = 64
CHUNK = 1 << 20
#: A record of a block, or the place where the block is broken.
RECORD = "path string, block bigint, local bigint, raw string, code string, position bigint, detail string"


class Blocks:
    """The blocks of all files below a path: (path, length, block, start, stop, several); an empty file is one block."""

    def __init__(self, spark: SparkSession, path: str | list[str], size: int = BLOCK_BYTES):
        files = self.files = written(list_files(spark, path), "files")
        number = F.greatest(F.ceil(F.col("length") / size), F.lit(1)).cast("bigint")
        counted = files.agg(F.sum(number).alias("blocks"), F.count(F.lit(1)).alias("files"), F.sum("length").alias("length")).first()
        # small files share tasks: as many as their bytes, or opening them, are worth
        worth = -(-(counted["length"] or 0) // size) + counted["files"] // FILES_PER_TASK
        self.size, self.tasks = size, max(1, min(worth, counted["blocks"] or 0, MOST_TASKS))
        self.any_several = (counted["blocks"] or 0) > counted["files"]
        blocks = files.select("path", "length", F.explode(F.sequence(F.lit(0), number - 1)).alias("block"))
        self.table = blocks.select(
            "path", "length", "block", (F.col("block") * size).alias("start"),
            F.least("length", (F.col("block") + 1) * size).alias("stop"), (F.col("length") > size).alias("several"))

    def spread(self, rows: DataFrame) -> DataFrame:
        """Small rows that stand for much work, dealt out evenly (adaptive execution would put them together)."""
        return rows.repartition(self.tasks)


def numbered(records: DataFrame, name: str = "row_index") -> DataFrame:
    """Records with their 1-based position in the file: the place in the block and the records of earlier blocks."""
    counts = records.filter("code IS NULL").groupBy("path", "block").agg(F.count(F.lit(1)).alias("_n"))
    before = running_total(counts, ["path"], "block", F.col("_n"), "_before").filter("_before > 0").select("path", "block", "_before")
    return records.join(written(before, "block-offsets"), ["path", "block"], "left").withColumn(
        name, F.col("local") + F.coalesce("_before", F.lit(0)))


def first_broken(records: DataFrame) -> DataFrame:
    """(path, code, position, detail, block): the first broken place of every broken file."""
    place = F.struct("position", "code", "detail", "block")
    return records.filter("code IS NOT NULL").groupBy("path").agg(F.min(place).alias("p")).select(
        "path", "p.code", "p.position", "p.detail", "p.block")


def settled(rows: DataFrame, broken: DataFrame) -> DataFrame:
    """(dataset_id, row_index, raw, code, detail): the rows of whole files, and one row per broken file."""
    good = rows.filter("code IS NULL").join(broken.select("path"), "path", "left_anti").select(
        F.col("path").alias("dataset_id"), "row_index", "raw", F.lit(None).cast("string").alias("code"), F.lit(None).cast("string").alias("detail"))
    none = F.lit(None)
    return good.unionByName(broken.select(
        F.col("path").alias("dataset_id"), none.cast("bigint").alias("row_index"), none.cast("string").alias("raw"), "code", "detail"))


LINE = re.compile(rb"[^\r\n]*(?:\r\n|\n|\r)")


def lines_from(uri: str, start: int) -> Iterator[tuple[int, bytes]]:
    """(offset, line with its end) of the lines that begin at ``start`` or later; they may end with CR, LF or both."""
    with open_bytes(uri) as stream:
        at = max(0, start - 1)
        stream.seek(at)
        held, skip = b"", start > 0
        while True:
            piece = stream.read(CHUNK)
            held += piece
            used = 0
            # a CR at the end of what was read may be the first half of a line end
            for found in LINE.finditer(held, 0, len(held) - (1 if piece and held.endswith(b"\r") else 0)):
                if not skip:
                    yield at + used, found.group()
                skip, used = False, found.end()
            at, held = at + used, held[used:]
            if not piece:
                if held and not skip:
                    yield at, held
                return
