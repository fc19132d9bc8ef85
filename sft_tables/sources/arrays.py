"""Large JSON files that hold one array, read by many tasks.

Whether a byte lies inside a string depends on the quotes before it, and how deep it lies on the brackets before it outside
strings. Both are sums: the parity of quotes, and for either parity at its start a block's change of depth. With the state
that each block starts in, commas at depth one are found in all blocks at once; an element belongs to the block that holds
the bracket or comma before it, and its text is decoded strictly.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sft_tables.functions.carry import last_before, running_total
from sft_tables.session import written
from sft_tables.sources.blocks import BLOCK_BYTES, CHUNK, RECORD, Blocks, first_broken, numbered, settled
from sft_tables.sources.files import open_bytes

BAD, NOT_ARRAY = "BAD_JSON", "NOT_ARRAY"
BOM = b"\xef\xbb\xbf"
DECODER, BLANK = json.JSONDecoder(), re.compile(r"[ \t\r\n]*")
QUOTE, BACKSLASH, COMMA, OPEN, CLOSE = (ord(c) for c in '"\\,[]')
BLANKS = np.isin(np.arange(256), [9, 10, 13, 32])
#: +1 for an opening bracket, -1 for a closing one.
TURN = np.zeros(256, np.int8)
TURN[[ord("["), ord("{")]], TURN[[ord("]"), ord("}")]] = 1, -1


def backslashes_before(stream, start: int) -> int:
    """How many backslashes end right before a place of a file."""
    count, at = 0, start
    while at:
        size = min(at, 64 if not count else CHUNK)
        stream.seek(at - size)
        piece = stream.read(size)
        run = len(piece) - len(piece.rstrip(b"\\"))
        count, at = count + run, at - size
        if run < size:
            break
    return count


def quotes(data: np.ndarray, escapes: int) -> tuple[np.ndarray, int]:
    """Which bytes are quotes that no backslash escapes, and how many backslashes end the bytes (``escapes``: before them)."""
    found = data == QUOTE
    slash = data == BACKSLASH
    if escapes or slash.any():
        last = np.maximum.accumulate(np.where(slash, -1 - escapes, np.arange(len(data))))
        run = np.arange(len(data)) - 1 - np.concatenate([[-1 - escapes], last[:-1]])
        found &= run % 2 == 0
        escapes = int(len(data) - 1 - last[-1])
    return found, escapes


def summary(uri: str, start: int, stop: int) -> dict[str, int | None]:
    """What a block adds for the blocks after it."""
    parity, turns, lines, chars, last_line, blank = 0, [0, 0], 0, 0, None, True
    with open_bytes(uri) as stream:
        escapes = backslashes_before(stream, start)
        stream.seek(start)
        at = start
        while at < stop:
            data = np.frombuffer(stream.read(min(CHUNK, stop - at)), np.uint8)
            if not len(data):
                break
            if not at and data[:3].tobytes() == BOM:
                # no character, and blank
                data = np.concatenate([np.full(3, 0x80, np.uint8), data[3:]])
            found, escapes = quotes(data, escapes)
            inside = (np.cumsum(found, dtype=np.int64) + parity) & 1
            turn = TURN[data]
            turns[0] += int(turn[inside == 0].sum())
            turns[1] += int(turn[inside == 1].sum())
            parity = int(inside[-1])
            first = np.flatnonzero((data & 0xC0) != 0x80)
            ends = np.flatnonzero(data == 10)
            if len(ends):
                lines += len(ends)
                last_line = chars + int(np.searchsorted(first, ends[-1], "right"))
            chars += len(first)
            blank = blank and bool((BLANKS[data] | (at == 0) & (np.arange(len(data)) < 3) & (data == 0x80)).all())
            at += len(data)
    return {"parity": parity, "turn_outside": turns[0], "turn_inside": turns[1], "lines": lines, "chars": chars, "line_start": last_line, "filled": int(not blank)}


SUMMARY = "path string, block bigint, parity bigint, turn_outside bigint, turn_inside bigint, lines bigint, chars bigint, line_start bigint, filled bigint"


STATES = "path string, block bigint, inside boolean, depth bigint, opened boolean, line bigint, column bigint"


def block_states(blocks: Blocks, spark: SparkSession) -> DataFrame:
    """(path, block, inside, depth, opened, line, column) at the start of the blocks of files with several: inside a string
    or not, how deep, whether anything came before, and the line and column (characters since the line's start) there."""
    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [{"path": p, "block": b, **summary(p, a, z)} for p, b, a, z in zip(batch["path"], batch["block"], batch["start"], batch["stop"])]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in SUMMARY.split(", ")]).astype({"line_start": "Int64"})

    if not blocks.any_several:
        return spark.createDataFrame([], STATES)
    several = blocks.spread(blocks.table.filter("several").select("path", "block", "start", "stop"))
    found = written(several.mapInPandas(look, SUMMARY), "array-index")
    for amount, name in (("parity", "_quotes"), ("lines", "line"), ("chars", "_chars"), ("filled", "_filled")):
        found = running_total(found, ["path"], "block", F.col(amount), name)
    found = found.withColumn("inside", F.col("_quotes") % 2 == 1)
    found = running_total(found, ["path"], "block", F.when(F.col("inside"), F.col("turn_inside")).otherwise(F.col("turn_outside")), "depth")
    mark = F.col("_chars") + F.col("line_start")
    began = last_before(found.select("path", "block", mark.alias("_mark")), ["path"], "block", {"_line_start": F.col("_mark")})
    found = found.join(began.select("path", "block", "_line_start"), ["path", "block"], "left")
    return written(found.select(
        "path", "block", "inside", "depth", (F.col("_filled") > 0).alias("opened"), "line",
        (F.col("_chars") - F.coalesce("_line_start", F.lit(0))).alias("column")), "array-states")


class Broken(ValueError):
    """Why there are no rows: a code, a byte of the file, and a message."""

    def __init__(self, code: str, position: int, detail: str | None):
        super().__init__(detail)
        self.code, self.position, self.detail = code, position, detail


class BlockElements:
    """The elements of an array that belong to one block, from the state the block starts in."""

    def __init__(self, uri: str, start: int, stop: int, inside: bool, depth: int, opened: bool):
        self.uri, self.start, self.stop = uri, start, stop
        self.inside, self.depth, self.opened = inside, depth, opened

    def delimiters(self, stream) -> Iterator[tuple[int, int, bytes]]:
        """(place, byte, bytes before it since the last one) of the array's brackets and commas; at the end of the file byte 0."""
        escapes = backslashes_before(stream, self.start)
        stream.seek(self.start)
        at, parity, depth, held, waiting = self.start, int(self.inside), self.depth, [], True
        while True:
            raw = stream.read(CHUNK)
            if not raw:
                yield at, 0, b"".join(held)
                return
            data = np.frombuffer(raw, np.uint8)
            found, escapes = quotes(data, escapes)
            inside = (np.cumsum(found, dtype=np.int64) + parity) & 1
            parity = int(inside[-1])
            turn = np.where(inside == 0, TURN[data], 0)
            places = np.flatnonzero((turn != 0) | (inside == 0) & (data == COMMA))
            deep = depth + np.cumsum(turn[places], dtype=np.int64)
            depth = int(deep[-1]) if len(deep) else depth
            byte = data[places]
            mine = (deep == 1) & ((byte == COMMA) | (turn[places] > 0)) | (deep == 0) & (turn[places] < 0)
            used = 0
            for place, what in zip(places[mine].tolist(), byte[mine].tolist()):
                held.append(raw[used:place])
                yield at + place, what, b"".join(held)
                held, used = [], place + 1
            held.append(raw[used:])
            at += len(raw)

    def elements(self) -> Iterator[str]:
        if self.opened and (self.depth < 0 or self.inside and self.depth == 0):
            return  # broken further up
        with open_bytes(self.uri) as stream:
            delimiters = self.delimiters(stream)
            if self.depth > 0:
                # the element that goes on here belongs to an earlier block
                place, opener, _ = next(delimiters)
                if opener == 0 or place >= self.stop:
                    return
            elif self.opened:
                self.nothing_more(stream, self.start)
                return
            else:
                place, opener, before = next(delimiters)
                text = before.removeprefix(BOM) if not self.start else before
                if opener != OPEN or text.strip(b" \t\r\n"):
                    if opener == 0 and not text.strip(b" \t\r\n") and self.start:
                        return
                    raise Broken(NOT_ARRAY, -1, None)
                if place >= self.stop:
                    return
            while opener in (COMMA, OPEN) and place < self.stop:
                end, closer, raw = next(delimiters)
                yield from self.element(place + 1, raw, opener, closer, end)
                place, opener = end, closer
            if opener not in (0, COMMA, OPEN) and place < self.stop:
                self.nothing_more(stream, place + 1)

    def element(self, start: int, raw: bytes, opener: int, closer: int, end: int) -> Iterator[str]:
        """The one value between two delimiters."""
        try:
            text = raw.decode()
        except UnicodeDecodeError as error:
            raise Broken(BAD, start + error.start, "not UTF-8") from error
        if closer == CLOSE and opener == OPEN and not text.strip(" \t\r\n"):
            return
        head = BLANK.match(text).end()

        def at(place: int) -> int:
            return start + len(text[:place].encode())

        try:
            _, stop = DECODER.raw_decode(text, head)
        except json.JSONDecodeError as error:
            raise Broken(BAD, at(error.pos), error.msg) from error
        rest = BLANK.match(text, stop).end()
        if rest < len(text) or closer not in (COMMA, CLOSE):
            raise Broken(BAD, at(rest), "Expecting ',' delimiter")
        yield text[head:stop]

    def nothing_more(self, stream, start: int) -> None:
        """After the array only blanks may follow, as far as this block goes."""
        stream.seek(start)
        at = start
        while at < self.stop:
            data = np.frombuffer(stream.read(min(CHUNK, self.stop - at)), np.uint8)
            if not len(data):
                return
            other = np.flatnonzero(~BLANKS[data])
            if len(other):
                raise Broken(BAD, at + int(other[0]), "Extra data")
            at += len(data)


def no_array(uri: str) -> Broken:
    """What is wrong with a file whose first character opens no array: it is read as one value."""
    with open_bytes(uri) as stream:
        raw = stream.read()
    start = len(BOM) if raw.startswith(BOM) else 0
    try:
        text = raw[start:].decode()
    except UnicodeDecodeError as error:
        return Broken(BAD, start + error.start, "not UTF-8")

    def at(place: int) -> int:
        return start + len(text[:place].encode())

    try:
        _, stop = DECODER.raw_decode(text, BLANK.match(text).end())
    except json.JSONDecodeError as error:
        return Broken(BAD, at(error.pos), error.msg)
    rest = BLANK.match(text, stop).end()
    return Broken(BAD, at(rest), "Extra data") if rest < len(text) else Broken(NOT_ARRAY, 0, None)


def block_records(uri: str, block: int, found: BlockElements) -> Iterator[tuple]:
    local = 0
    try:
        for local, raw in enumerate(found.elements(), 1):
            yield uri, block, local, raw, None, None, None
    except Broken as error:
        if error.position < 0:
            error = no_array(uri)
        yield uri, block, None, None, error.code, error.position, error.detail


def in_frames(rows: Iterator[tuple], columns: str, most: int = 1000) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in columns.split(", ")]
    whole = [c.split()[0] for c in columns.split(", ") if c.endswith("bigint")]
    while part := list(islice(rows, most)):
        yield pd.DataFrame(part, columns=names).astype(dict.fromkeys(whole, "Int64"))


def line_and_column(uri: str, start: int, position: int, line: int, column: int) -> tuple[int, int]:
    """1-based line and column of a byte, from those (0-based) at the start of its block."""
    with open_bytes(uri) as stream:
        stream.seek(start)
        text = stream.read(position - start)
    if not start:
        text = text.removeprefix(BOM)
    lines = text.count(b"\n")
    tail = text[text.rfind(b"\n") + 1:]
    chars = sum((b & 0xC0) != 0x80 for b in tail)
    return line + lines + 1, (0 if lines else column) + chars + 1


def read_json_table(spark: SparkSession, path: str | list[str], size: int = BLOCK_BYTES) -> DataFrame:
    """(dataset_id, row_index, raw, code, detail): one row per element of a top-level JSON array, or one row with a code
    for a file that is no JSON (BAD_JSON, with line and column) or no array (NOT_ARRAY).

    Files are read in blocks of ``size`` bytes by as many tasks as there are blocks: once for the summaries if they are
    longer than a block, and once for the elements, which are written to the shared folder; every use of the result reads
    those. A file that is broken anywhere gives no rows. One element has to fit into memory; files whose first character
    opens no array are looked at whole by one task.
    """
    blocks = Blocks(spark, path, size)
    states = block_states(blocks, spark)
    marked = blocks.spread(blocks.table.join(states, ["path", "block"], "left").select(
        "path", "block", "start", "stop", F.coalesce("inside", F.lit(False)).alias("inside"), F.coalesce("depth", F.lit(0)).alias("depth"),
        F.coalesce("opened", F.lit(False)).alias("opened")))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                found = BlockElements(row.path, row.start, row.stop, row.inside, row.depth, row.opened)
                yield from in_frames(block_records(row.path, row.block, found), RECORD)

    records = written(marked.mapInPandas(read, RECORD), "array-elements")
    broken = first_broken(records)
    # the place of an error may lie beyond the block that found it
    place = broken.withColumn("block", F.expr(f"position div {blocks.size}")).join(states, ["path", "block"], "left")

    def locate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i, row in enumerate(batch.itertuples(index=False)):
                if row.detail is not None:
                    line, column = line_and_column(row.path, row.block * size, row.position, row.line, row.column)
                    batch.at[i, "detail"] = f"line {line}, column {column}: {row.detail}"
            yield batch[["path", "code", "detail"]]

    located = place.select("path", "code", "detail", "position", "block", F.coalesce("line", F.lit(0)).alias("line"), F.coalesce("column", F.lit(0)).alias("column"))
    return settled(numbered(records), written(located.mapInPandas(locate, "path string, code string, detail string"), "array-errors"))


def rows_of(table: DataFrame) -> DataFrame:
    """The rows of a table of rows and refused files."""
    return table.filter("code IS NULL").select("dataset_id", "row_index", "raw")


def refused_of(table: DataFrame) -> DataFrame:
    """The refused files of such a table, as violations (dataset_id, code, detail)."""
    return table.filter("code IS NOT NULL").select("dataset_id", "code", "detail")


def read_json_array(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The rows of ``read_json_table``."""
    return rows_of(read_json_table(spark, path))


def json_array_errors(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The files that ``read_json_table`` refuses."""
    return refused_of(read_json_table(spark, path))
