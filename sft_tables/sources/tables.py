"""CSV files, read by many tasks also where quoted cells hold line ends.

A block's records begin at the lines that begin in it, unless such a line goes on inside quotes. Each block of a long file is
read under both assumptions, which tells how its end depends on its start; chained over the blocks, that settles where every
block starts. Separators and quoting are found per file; a file that cannot be read is a violation, not an error.
"""

from __future__ import annotations

import csv
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sft_tables.functions.carry import last_before, running_total
from sft_tables.session import written
from sft_tables.sources.arrays import in_frames, refused_of, rows_of
from sft_tables.sources.blocks import BLOCK_BYTES, RECORD, Blocks, first_broken, lines_from, numbered, settled
from sft_tables.sources.files import open_text
from sft_tables.sources.probe import csv_dialect

BAD, HEADER = "BAD_CSV", "CSV_HEADER"
LAYOUT = "path string, mark string, quote string, doubled boolean, spaced boolean, header array<string>, code string, detail string"
#: Cells of any length: the largest limit that the csv module takes.
LONGEST = 2**31 - 1
END = "\x1e\n"


def dialect_of(mark: str, quote: str, doubled: bool, spaced: bool) -> type[csv.Dialect]:
    return type("Found", (csv.excel,), {"delimiter": mark, "quotechar": quote, "doublequote": bool(doubled), "skipinitialspace": bool(spaced)})


def layout(uri: str, sep: str | None) -> tuple:
    """(path, separator, quote, doubled quotes, blanks after separators, header, code, detail) of a file."""
    csv.field_size_limit(LONGEST)
    try:
        found = csv_dialect(uri) if sep is None else dialect_of(sep, '"', True, False)
        with open_text(uri, newline="") as text:
            header = next((r for r in csv.reader(text, found) if r), [])
    except (csv.Error, UnicodeError) as error:
        return uri, None, None, None, None, None, BAD, str(error)
    if not header or not all(header):
        return uri, None, None, None, None, None, HEADER, None
    return uri, found.delimiter, found.quotechar, found.doublequote, found.skipinitialspace, header, None, None


def csv_layouts(blocks: Blocks, sep: str | None = None) -> DataFrame:
    """How every file is written, or why it cannot be read."""
    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([layout(uri, sep) for uri in batch["path"]], columns=[c.split()[0] for c in LAYOUT.split(", ")])

    return blocks.spread(blocks.files.select("path")).mapInPandas(look, LAYOUT)


def ends_inside(uri: str, start: int, stop: int, dialect: type[csv.Dialect], inside: bool) -> bool:
    """Are quotes open after the lines that begin in a block, given whether they are before them?"""
    def lines() -> Iterator[str]:
        first = dialect.quotechar if inside else ""
        for at, line in lines_from(uri, start):
            if at >= stop:
                break
            yield first + line.decode("utf-8", "surrogateescape")
            first = ""
        yield first + END

    last: list[str] = []
    for last in csv.reader(lines(), dialect):  # noqa: B007
        pass
    return last != next(csv.reader([END], dialect))


def block_starts(blocks: Blocks, layouts: DataFrame, spark: SparkSession) -> DataFrame:
    """(path, block, inside): whether the first line that begins in a block of a long file goes on inside quotes."""
    schema = "path string, block bigint, from_outside boolean, from_inside boolean"

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        csv.field_size_limit(LONGEST)
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                found = dialect_of(r.mark, r.quote, r.doubled, r.spaced)
                rows.append((r.path, r.block, *(ends_inside(r.path, r.start, r.stop, found, x) for x in (False, True))))
            yield pd.DataFrame(rows, columns=["path", "block", "from_outside", "from_inside"])

    if not blocks.any_several:
        return spark.createDataFrame([], "path string, block bigint, inside boolean")
    several = blocks.table.filter("several").join(layouts.filter("code IS NULL"), "path")
    ends = written(blocks.spread(several.select("path", "block", "start", "stop", "mark", "quote", "doubled", "spaced")).mapInPandas(look, schema), "csv-index")
    # a block either ends the same way from both starts, or keeps the start, or turns it round
    turned = F.col("from_outside") & ~F.col("from_inside")
    found = running_total(ends, ["path"], "block", turned.cast("bigint"), "_turns")
    fixed = F.when(F.col("from_outside") == F.col("from_inside"), F.struct(F.col("from_outside").alias("inside"), F.col("_turns").alias("turns")))
    found = last_before(found.withColumn("_fixed", fixed), ["path"], "block", {"_known": F.col("_fixed")})
    since = F.col("_turns") - F.coalesce("_known.turns", F.lit(0))
    inside = F.coalesce("_known.inside", F.lit(False)) != (since % 2 == 1)
    return written(found.select("path", "block", inside.alias("inside")), "csv-states")


def cells_as_json(header: list[str], cells: list[str]) -> str:
    """One row: cells missing at the end are null, those beyond the header a list under the key 'None'."""
    row: dict[str, object] = dict.fromkeys(header)
    row.update(zip(header, cells))
    if len(cells) > len(header):
        row["None"] = cells[len(header):]
    return json.dumps(row, ensure_ascii=False)


class BlockCells:
    """The records that begin in a block; the last one may go on beyond it."""

    def __init__(self, uri: str, start: int, stop: int, dialect: type[csv.Dialect], inside: bool, multi_line: bool):
        self.uri, self.start, self.stop, self.dialect, self.inside, self.multi_line = uri, start, stop, dialect, inside, multi_line
        self.at = self.following = start

    def lines(self) -> Iterator[str]:
        first = self.dialect.quotechar if self.inside else ""
        for at, line in lines_from(self.uri, self.start):
            if self.following == self.start and at >= self.stop:
                return  # no line begins here
            self.at, self.following = at, at + len(line)
            yield first + line.decode("utf-8-sig" if not at else "utf-8")
            first = ""

    def records(self) -> Iterator[list[str]]:
        lines = self.lines()
        reader = csv.reader(lines, self.dialect) if self.multi_line else (next(csv.reader([line], self.dialect), []) for line in lines)
        if self.inside:
            next(reader, None)  # the rest of a record of an earlier block
        while self.following < self.stop:
            cells = next(reader, None)
            if cells is None:
                return
            if cells:
                yield cells


def block_rows(uri: str, block: int, header: list[str], found: BlockCells) -> Iterator[tuple]:
    try:
        for local, cells in enumerate(found.records(), 1):
            yield uri, block, local, cells_as_json(header, cells), None, None, None
    except (csv.Error, UnicodeError) as error:
        yield uri, block, None, None, BAD, found.at, f"line at byte {found.at}: {error}"


def read_csv_table(spark: SparkSession, path: str | list[str], sep: str | None = None, multi_line: bool = True, size: int = BLOCK_BYTES) -> DataFrame:
    """(dataset_id, row_index, raw, code, detail): rows as JSON text with every header column as a key, or one row with a
    code for a file whose separator cannot be found or whose text is broken (BAD_CSV), or without a full header (CSV_HEADER).

    Empty cells are '', cells missing at the end of a short row are null, extra cells are a list under the key 'None'; blank
    lines are no rows; cells have any length. Files are read in blocks of ``size`` bytes by as many tasks as there are
    blocks; a quoted cell may hold line ends, wherever the blocks are cut; without ``multi_line`` every line is a row. Rows
    are written to the shared folder once; a file that is broken anywhere gives no rows.
    """
    blocks = Blocks(spark, path, size)
    layouts = written(csv_layouts(blocks, sep), "csv-layouts")
    fine = layouts.filter("code IS NULL")
    several = block_starts(blocks, layouts, spark) if multi_line else spark.createDataFrame([], "path string, block bigint, inside boolean")
    work = blocks.table.join(fine, "path").join(several, ["path", "block"], "left").select(
        "path", "block", "start", "stop", "mark", "quote", "doubled", "spaced", "header", F.coalesce("inside", F.lit(False)).alias("inside"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        csv.field_size_limit(LONGEST)
        for batch in batches:
            for r in batch.itertuples(index=False):
                found = BlockCells(r.path, r.start, r.stop, dialect_of(r.mark, r.quote, r.doubled, r.spaced), r.inside, multi_line)
                yield from in_frames(block_rows(r.path, r.block, list(r.header), found), RECORD)

    records = written(blocks.spread(work).mapInPandas(read, RECORD), "csv-rows")
    broken = first_broken(records).select("path", "code", "detail").unionByName(layouts.filter("code IS NOT NULL").select("path", "code", "detail"))
    # the first record of a file is its header
    rows = numbered(records).withColumn("row_index", F.col("row_index") - 1).filter("row_index > 0 OR code IS NOT NULL")
    return settled(rows, broken)


def read_csv(spark: SparkSession, path: str | list[str], sep: str | None = None, multi_line: bool = True) -> DataFrame:
    """The rows of ``read_csv_table``."""
    return rows_of(read_csv_table(spark, path, sep, multi_line))


def csv_errors(spark: SparkSession, path: str | list[str], sep: str | None = None, multi_line: bool = True) -> DataFrame:
    """The files that ``read_csv_table`` refuses, as violations (dataset_id, code, detail)."""
    return refused_of(read_csv_table(spark, path, sep, multi_line))
