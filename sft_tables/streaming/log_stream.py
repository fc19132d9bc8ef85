"""The console view of training logs as a stream, on Spark's own state.

Two stateful steps by run, around expressions that batch and stream share: the first puts chunks in order and cuts them
into records (an open record and early chunks wait in its state), the second carries what records depend on from earlier
ones (traceback, phase, last step, last progress shown). What a line is, and how it is shown, is decided by the same
column expressions as in ``operators.logs``. Only runs with new chunks, or whose timer is due, are touched; the output is
appended by Spark's file sink, so a batch that is repeated after a failure leaves no duplicates.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import reduce
from operator import add

import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from sft_tables.functions.once import once
from sft_tables.operators import logs
from sft_tables.streaming.tables import ROCKSDB, write_rows

CHUNKS = "run_id bigint, chunk_no bigint, text string, last boolean"
LINES = "run_id bigint, line_no bigint, text string"
PLACE = "next_chunk bigint, seq bigint"
PACK = "chunk_no array<bigint>, text array<string>, last array<boolean>"
RECORDS = "run_id {key}, seq bigint, line string, cr boolean"
PIECES = "run_id {key}, seq bigint, pieces array<string>"
CARRIED = "in_traceback boolean, phase string, phase_seq bigint, step_seq bigint, step_current bigint, step_total bigint, shown bigint"
FLAGS = ("cr", "blank", "tb_start", "tb_end", "important", "warning", "starts", "summary", "done", "in_traceback", "due", "train", "table")
CR, BLANK, TB_START, TB_END, IMPORTANT, WARNING, STARTS, SUMMARY, DONE, INSIDE, DUE, TRAIN, TABLE = (1 << n for n in range(len(FLAGS)))
MARKS = FLAGS[:9]
TAGS = ("seq", "line", "flags", "current", "total", "phase_seq", "step_seq", "step_current", "step_total")
TAGGED = "run_id {key}, " + ", ".join(f"{n} array<{ {'line': 'string', 'flags': 'int'}.get(n, 'bigint')}>" for n in TAGS)
#: Chunks and characters of a pack of early chunks, and records of a row of many, at most.
PACKED, PACKED_TEXT, BATCH = 512, 1 << 18, 4096


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=_names(schema), dtype=object)


class Records(StatefulProcessor):
    """Chunks of a run, in any order, to its records; a record without a line closes the run.

    ``place`` is where the run goes on (its next chunk, negative while early ones wait), ``open`` the pieces of the record
    that has not ended, ``early`` the chunks that wait for those before them, in packs. Each look at the state is a call to
    Spark, which costs more than the work on a chunk: packs are added unread, and read when the missing chunk has come. One
    timer a run: for the missing chunk if any wait, else for the end of a silent run.
    """

    def __init__(self, patience: int | None, ttl: int | None):
        self.patience, self.ttl = patience, ttl
        self.timed = patience is not None or ttl is not None

    def init(self, handle) -> None:
        self.handle = handle
        self.place = handle.getValueState("place", PLACE)
        self.open = handle.getListState("open", "piece string")
        self.early = handle.getListState("early", PACK)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        chunks = (chunk for batch in rows for chunk in zip(batch["chunk_no"], batch["text"], batch["last"]))
        yield self.records(key, *self.take(chunks, timerValues))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self.records(key, *self.give_up(timerValues))

    def records(self, key, seq: int, pieces: list[str], ended: bool) -> pd.DataFrame:
        found = [(key[0], n, p[:-1] if p[-1] in "\r\n" else p, p[-1] == "\r") for n, p in enumerate(pieces, seq + 1)]
        return _frame(found + [(key[0], seq + len(pieces) + 1, None, False)] * ended, RECORDS)

    def take(self, chunks: Iterable[tuple], timerValues) -> tuple[int, list[str], bool]:
        """The number of records before, the pieces of text that are whole now, each with the character that ends it, and
        whether the run has ended."""
        place = self.place.get()
        following, came = abs(place[0]) if place else 1, {}
        for number, text, last in chunks:
            if number >= following:
                came.setdefault(int(number), (text, bool(last)))
        kept = self.kept() if place and place[0] < 0 and following in came else {}
        return self.advance(place, following, came, kept, timerValues)

    def give_up(self, timerValues) -> tuple[int, list[str], bool]:
        """The same when a timer is due: go on after the gap, or end the run."""
        place = self.place.get() or (1, 0)
        kept = self.kept() if place[0] < 0 else {}
        return self.advance(place, min(kept, default=place[0]), {}, kept, timerValues, not kept)

    def kept(self) -> dict:
        """Early chunks by number; of one that came twice, the first."""
        return {n: (text, last) for pack in reversed(list(self.early.get())) for n, text, last in reversed(list(zip(*pack)))}

    def advance(self, place, following: int, came: dict, kept: dict, timerValues, ended: bool = False) -> tuple[int, list[str], bool]:
        """Take the chunks whose turn it is, of those that came and those that were ``kept`` (none, if they were not read), and
        keep the others."""
        seq, waited, texts = place[1] if place else 0, bool(place and place[0] < 0), []
        first = following == 1
        while not ended and (chunk := came.pop(following, None) or kept.get(following)):
            text, ended = chunk
            texts.append(text)
            following += 1
        pieces = self.cut(first, "".join(texts), ended)
        if self.timed:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
        if ended:
            if place:
                self.place.clear()
            if waited:
                self.early.clear()
            return seq, pieces, True
        waits = self.hold(came, {n: chunk for n, chunk in kept.items() if n >= following}, bool(kept)) or waited and not kept
        if (now := (-following if waits else following, seq + len(pieces))) != place:
            self.place.update(now)
        wait = (self.patience if waits else self.ttl) if self.timed else None
        if wait is not None:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + wait)
        return seq, pieces, False

    def hold(self, came: dict, kept: dict, read: bool) -> bool:
        """Write chunks down that come early: added to those that are there, or in their place if these were read."""
        chunks = came | kept
        packs, size = [], PACKED_TEXT
        for n in sorted(chunks):
            if size >= PACKED_TEXT or len(packs[-1][0]) == PACKED:
                packs.append(([], [], []))
                size = 0
            for column, value in zip(packs[-1], (n, *chunks[n])):
                column.append(value)
            size += len(chunks[n][0])
        if read and packs:
            self.early.put(packs)
        elif read:
            self.early.clear()
        elif packs:
            self.early.appendList(packs)
        return bool(packs)

    def cut(self, first: bool, text: str, ended: bool) -> list[str]:
        """Pieces that have ended, with what was open before (nothing, at the ``first`` chunk); what has not ended stays open."""
        pieces = [p for p in re.split(r"(?<=[\r\n])", text) if p]
        rest = pieces.pop() if pieces and not ended and pieces[-1][-1] not in "\r\n" else None
        before = [p[0] for p in self.open.get()] if not first and (pieces or ended) else []
        if before:
            pieces[:1] = ["".join(before + pieces[:1])]
        if rest is not None and before:
            self.open.put([(rest,)])
        elif rest is not None:
            self.open.appendValue((rest,))
        elif before:
            self.open.clear()
        return pieces

    def close(self) -> None:
        pass


class RecordRows(Records):
    """The same on rows: no frames for every run, and many records to a row."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        return self.packed(key, *self.take((row[1:] for row in rows), timerValues))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        return self.packed(key, *self.give_up(timerValues))

    def packed(self, key, seq: int, pieces: list[str], ended: bool) -> Iterator[Row]:
        row = Row(*_names(PIECES))
        pieces = (*pieces, *[None] * ended)
        for at in range(0, len(pieces), BATCH):
            yield row(key[0], seq + at, pieces[at:at + BATCH])


class Tags(StatefulProcessor):
    """Records of a run with their marks, in order, to tagged records; what the next one depends on is the state."""

    def init(self, handle) -> None:
        self.carried = handle.getValueState("carried", CARRIED)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        row = Row("run_id", *TAGS)
        known = self.carried.get()
        inside, phase, phase_seq, step_seq, step, whole, shown = known or (False, None, None, None, None, None, 0)
        ended = False
        for _, *columns in sorted(rows, key=lambda records: records[1][0]):
            out = []
            for seq, line, flags, number, of in zip(*columns):
                if line is None:
                    ended = True
                    continue
                inside = bool(inside or flags & TB_START)
                plain = not (inside or flags & (BLANK | IMPORTANT | WARNING))
                change = "train" if flags & STARTS else "table" if flags & SUMMARY else "none" if flags & DONE else None
                due = True
                if plain and change is None and number is not None and phase == "train":
                    again = step_seq is not None and step_seq > phase_seq and (step, whole) == (number, of)
                    due = not again and logs.is_due(number, of, shown)
                    if due:
                        shown = number
                tags = flags | INSIDE * inside | DUE * due | TRAIN * (phase == "train") | TABLE * (phase == "table")
                out.append((seq, line, tags, number, of, phase_seq if phase != "none" else None, step_seq, step, whole))
                if plain and change:
                    phase, phase_seq, shown = change, seq, 0
                elif plain and number is not None:
                    step_seq, step, whole = seq, number, of
                if not flags & TB_START and (flags & TB_END or flags & BLANK and not flags & CR):
                    inside = False
            if out:
                yield row(key[0], *zip(*out))
        if not ended:
            self.carried.update((inside, phase, phase_seq, step_seq, step, whole, shown))
        elif known:
            self.carried.clear()

    def close(self) -> None:
        pass


def _milliseconds(seconds: float | None) -> int | None:
    return None if seconds is None else int(seconds * 1000)


def marks(pieces: DataFrame) -> DataFrame:
    """Rows of pieces to rows of records with their marks: one row to the next step, not one for each record."""
    def flags(record: Column) -> Column:
        marked = {"cr": record["cr"], **logs.said(record["line"])}
        return reduce(add, [F.when(marked[n], 1 << i).otherwise(0) for i, n in enumerate(MARKS)])

    cut = F.transform("pieces", lambda piece, at: F.struct(
        (F.col("seq") + at + 1).alias("seq"), logs.record_line(piece).alias("line"), logs.record_cr(piece).alias("cr")))
    kept = F.filter(cut, lambda record: record["line"].isNull() | ~(record["cr"] & (record["line"] == "")))
    plain = F.transform(kept, lambda record: F.struct(record["seq"].alias("seq"), logs.strip_ansi(record["line"]).alias("line"), record["cr"].alias("cr")))
    marked = F.transform(plain, lambda record: F.struct(
        record["seq"].alias("seq"), record["line"].alias("line"), flags(record).alias("flags"), logs.said(record["line"])["step"].alias("step")))
    return once(pieces, m=marked).filter("size(m) > 0").select(
        "run_id", "m.seq", "m.line", "m.flags", F.col("m.step")["current"].alias("current"), F.col("m.step")["total"].alias("total"))


def shown_stream(chunks: DataFrame, patience: float | None = None, ttl: float | None = None) -> DataFrame:
    """Streaming chunks (run_id, chunk_no, text[, last]) to shown lines (run_id, line_no, text), to be written in append mode.

    Chunks of a run are numbered from 1 and may come in any order and more than once; one that comes early waits for those
    before it, at most ``patience`` seconds. The chunk marked ``last`` ends its run: an unfinished last line is shown and
    the run's state goes. So it does ``ttl`` seconds after its last chunk, unless chunks wait. Both are processing time and
    without end by default; with them Spark runs batches without data too, so an ``availableNow`` query needs
    ``spark.sql.streaming.noDataMicroBatches.enabled=false`` to end. A chunk of a run that has ended begins that run anew. Rows without a run or a number are left
    out; a null text is empty. The new records of one run in one micro-batch are held by one task.
    """
    chunks.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    key = chunks.schema["run_id"].dataType.simpleString()
    last = F.coalesce("last", F.lit(False)) if "last" in chunks.columns else F.lit(False)
    rows = chunks.filter("run_id IS NOT NULL AND chunk_no IS NOT NULL").select(
        "run_id", "chunk_no", F.coalesce("text", F.lit("")).alias("text"), last.alias("last"))
    cutter = RecordRows(_milliseconds(patience), _milliseconds(ttl))
    pieces = rows.groupBy("run_id").transformWithState(cutter, PIECES.format(key=key), "Append", "ProcessingTime" if cutter.timed else "None")
    marked = marks(pieces)
    tagged = marked.groupBy("run_id").transformWithState(Tags(), TAGGED.format(key=key), "Append", "None").select("run_id", F.inline(F.arrays_zip(*TAGS)))
    flag = {n: (F.col("flags").bitwiseAND(1 << i) != 0).alias(n) for i, n in enumerate(FLAGS)}
    step = F.when(F.col("current").isNotNull(), F.struct("current", "total"))
    before = F.when(F.col("step_seq").isNotNull(), F.struct(F.col("step_seq").alias("seq"), F.col("step_current").alias("current"), F.col("step_total").alias("total")))
    classified = logs.kinds(tagged.select(
        "run_id", "seq", "line", *[flag[n] for n in FLAGS[:11]], step.alias("step"),
        F.when(flag["train"], "train").when(flag["table"], "table").alias("phase"), "phase_seq", before.alias("last_step")), "due")
    lines = logs.told(classified.filter(F.col("kind").isin(*logs.SHOWN) & ((F.col("kind") != "progress") | (F.col("due") & (F.col("progress.total") != 0)))))
    return lines.select("run_id", F.col("seq").alias("line_no"), "text")


def log_stream(chunks: DataFrame, out: str, checkpoint: str, patience: float | None = None, ttl: float | None = None):
    """Writer of ``shown_stream`` to ``out/lines``."""
    return write_rows(shown_stream(chunks, patience, ttl), f"{out}/lines", checkpoint)
