"""Removal of repeated passages: common prefixes of suffixes, from a Burrows-Wheeler transform, up to a length.

Bytes are removed where a string of LENGTH bytes covers them that also starts in a document with a smaller id. Equal
strings have equal smallest inner hashes, so strings are dealt out by that hash, a run of neighbours with one hash as
one piece of text; pieces whose hash occurs in one document only share nothing and stay where they are. Pieces of one hash
that are equal, byte for byte, count as one. Where pieces of one hash differ, their suffixes are sorted, and intervals of
the transform are extended backwards breadth first: each round finds the borders with the next larger common prefix, and
the search stops at LENGTH. What is still together shares LENGTH bytes. Hashes decide what meets, never what is equal.

All that crosses the network is packed arrays per (block of documents, bucket of hashes).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sft_tables.llm.common import (ROLL, bucket_cuts, bucketed, mixed, pack, pack_keys, read_table, slices, stored, text_bytes, unpack, unpack_keys,
                                   word_hashes)

LENGTH = 50
#: Length of the inner strings whose smallest hash deals out; and the longest run of strings that travels as one piece.
INNER, LONGEST = 24, 128
#: Strings of a hash that occurs more often than this are dealt out one by one by their own hash: a common phrase with
#: many different surroundings would be one large group otherwise.
OFTEN = 2000
#: Text of a block, and on average of a bucket.
BLOCK_BYTES, BUCKET_BYTES = 2 << 20, 8 << 20
LAST_ID = 2**63 - 1

BLOCKS = "block bigint, ids binary, sizes binary, data binary, n_bytes bigint, starts binary, counts binary, keys binary"
ASKED = "bucket int, block bigint, keys binary, docs binary, counts binary"
MARKS = "bucket int, block bigint, marks binary"
#: Pieces for a bucket; and, in buckets below 0, what a block keeps for their answers: the start and the number of each piece.
PIECES = "bucket int, block bigint, keys binary, docs binary, sizes binary, data binary, starts binary, numbers binary"
ANSWERS = "bucket int, block bigint, intervals binary, ends binary, docs binary, starts binary, numbers binary"
ANSWER_COLUMNS = [c.split()[0] for c in ANSWERS.split(", ")]


def row_batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "binary": pa.binary(), "int": pa.int32(), "bigint": pa.int64()}
    fields = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(fields)], [n for n, _ in fields])


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole documents, about BLOCK_BYTES of text at a time."""
    import zstandard

    task, count, held = TaskContext.get().partitionId(), 0, 0
    parts: list[tuple] = []

    def flush() -> pa.RecordBatch:
        sizes, data = (np.concatenate([p[i] for p in parts]) for i in (1, 2))
        start, run, key = runs(data, sizes)
        return row_batch(BLOCKS, [(task << 32 | count, pack(np.concatenate([p[0] for p in parts])), pack(sizes),
                                   zstandard.ZstdCompressor(level=3).compress(data.tobytes()), len(data),
                                   pack(np.diff(start, prepend=0)), pack(run.astype(np.uint8)), pack(key >> np.uint64(16)))])

    for batch in slices(batches, most=BLOCK_BYTES // 4):
        data, offsets = text_bytes(batch.column(1))
        parts.append((batch.column(0).to_numpy(zero_copy_only=False), np.diff(offsets), data))
        held += len(data)
        if held >= BLOCK_BYTES:
            yield flush()
            parts, held, count = [], 0, count + 1
    if parts:
        yield flush()


def gram_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the strings of a length at every byte (those past the end are of no use)."""
    powers = {1: ((data.astype(np.uint64) + np.uint64(1)) * ROLL) ^ np.uint64(0x5851F42D4C957F2D)}
    size = 1
    while size * 2 <= length:
        powers[size * 2] = joined(powers[size], powers[size], size)
        size *= 2
    whole, done = None, 0
    for part in sorted(powers, reverse=True):
        if length - done >= part:
            whole = powers[part] if whole is None else joined(whole, powers[part], done)
            done += part
    return mixed(whole)


def joined(left: np.ndarray, right: np.ndarray, at: int) -> np.ndarray:
    """Hash of a string and the one ``at`` bytes on."""
    out = left * (ROLL ^ np.uint64(2 * at))
    out[:max(0, len(left) - at)] += right[at:]
    return out ^ (out >> np.uint64(29))


def runs(data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The strings of LENGTH bytes of documents, as runs of neighbours with one smallest inner hash: start, number, key."""
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    n = len(data)
    edges = np.zeros(n + 1, np.int8)
    long = sizes >= LENGTH
    np.add.at(edges, offsets[:-1][long], 1)
    np.add.at(edges, offsets[1:][long] - LENGTH + 1, -1)
    inside = np.cumsum(edges[:-1], dtype=np.int8) > 0
    low, span = gram_hashes(data, INNER), 1
    width = LENGTH - INNER + 1
    while span * 2 <= width:
        low = smaller(low, low, span)
        span *= 2
    low = smaller(low, low, width - span)
    first = inside.copy()
    first[1:] &= ~inside[:-1] | (low[1:] != low[:-1])
    start = np.flatnonzero(first)
    ends = np.flatnonzero(inside & np.concatenate([~inside[1:] | first[1:], [True]])[:n]) + 1 if n else start
    count = ends - start
    if len(count) and count.max() > LONGEST:
        cut = -(-count // LONGEST)
        nth = np.arange(cut.sum()) - np.repeat(np.cumsum(cut) - cut, cut)
        start, end = np.repeat(start, cut) + nth * LONGEST, np.repeat(ends, cut)
        count = np.minimum(end - start, LONGEST)
    return start, count, mixed(low[start] ^ np.uint64(0x2545F4914F6CDD1D))


class Runs:
    """A block's runs as stored, with the document of each and 48-bit keys (in the upper bits)."""

    def __init__(self, row: dict):
        self.offsets = np.concatenate([[0], np.cumsum(unpack(row["sizes"], np.int64))])
        self.start = np.cumsum(unpack(row["starts"], np.int64))
        self.key = unpack(row["keys"], np.uint64) << np.uint64(16)
        self.doc = np.searchsorted(self.offsets, self.start, "right") - 1

    def distinct_keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct keys of the runs, and each run's place among them."""
        return np.unique(self.key, return_inverse=True)


def block_text(row: dict) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(row["data"], max_output_size=max(1, row["n_bytes"])), np.uint8)


def equal_texts(data: np.ndarray, start: np.ndarray, sizes: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, first): texts ordered so that equal ones of one key are neighbours, and which differ from the one before."""
    text = word_hashes(data, start, start + sizes)
    order = np.lexsort((text, keys))
    if not len(order):
        return order, np.zeros(0, bool)
    first = np.concatenate([[True], (keys[order][1:] != keys[order][:-1]) | (text[order][1:] != text[order][:-1])])
    again = np.flatnonzero(~first)
    first[again] = sizes[order[again]] != sizes[order[again - 1]]
    again = again[~first[again]]
    for at in range(0, len(again), 1 << 16):
        some = again[at:at + (1 << 16)]
        n = sizes[order[some]]
        same = data[within(start[order[some]], n)] == data[within(start[order[some - 1]], n)]
        first[some] = ~np.logical_and.reduceat(same, np.cumsum(n) - n)
    return order, first


def pieces(data: np.ndarray, ids: np.ndarray, found: Runs, count: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, ...]:
    """(start, count, number) of the pieces to ask for, and the distinct ones by number: (key, first piece, smallest id).

    marks: per run 0 not shared, 1 shared, 2 shared very often.
    """
    some, often = np.flatnonzero(marks == 1), np.flatnonzero(marks == 2)
    n = count[often]
    each = within(found.start[often], n)
    start = np.concatenate([found.start[some], each])
    size = np.concatenate([count[some], np.ones(len(each), np.int64)])
    doc = np.concatenate([found.doc[some], np.repeat(found.doc[often], n)])
    key = np.concatenate([found.key[some], mixed(word_hashes(data, each, each + LENGTH) ^ np.uint64(0x9E6C63D0876A9A47))])
    order, new = equal_texts(data, start, size + LENGTH - 1, key)
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    at = np.flatnonzero(new)
    lowest = np.minimum.reduceat(ids[doc[order]], at) if len(at) else np.zeros(0, np.int64)
    return start, size, number, key[order][at], order[at], lowest


def smaller(left: np.ndarray, right: np.ndarray, at: int) -> np.ndarray:
    out = left.copy()
    if at < len(left):
        np.minimum(left[:len(left) - at], right[at:], out=out[:len(left) - at])
    return out


def asking(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = Runs(row)
                keys, at = found.distinct_keys()
                counts = np.bincount(at, minlength=len(keys))
                low, high = np.full(len(keys), len(found.offsets)), np.zeros(len(keys), np.int64)
                np.minimum.at(low, at, found.doc)
                np.maximum.at(high, at, found.doc)
                cuts = bucket_cuts(keys, buckets)
                yield row_batch(ASKED, [(b, row["block"], pack_keys(keys[i:j]), pack((low < high)[i:j]), pack(counts[i:j].astype(np.uint32)))
                                        for b, (i, j) in enumerate(zip(cuts[:-1], cuts[1:])) if i < j])
    return run


def marking(often: int):
    """Which keys of a bucket occur in several documents, and which of them very often."""
    def run(key: tuple, asked: pa.Table) -> pa.Table:
        rows = asked.to_pylist()
        keys = [unpack_keys(r["keys"]) for r in rows]
        several = np.concatenate([unpack(r["docs"], bool) for r in rows])
        counts = np.concatenate([unpack(r["counts"], np.uint32) for r in rows])
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        shared = np.bincount(at, 1 + several, len(distinct)) > 1
        mark = (shared * (1 + (np.bincount(at, counts, len(distinct)) > often))).astype(np.uint8)[at]
        ends = np.cumsum([len(k) for k in keys])
        return pa.Table.from_batches([row_batch(MARKS, [(key[0].as_py(), r["block"], pack(mark[e - len(k):e])) for r, k, e in zip(rows, keys, ends)])])
    return run


def joined_marks(marks: list[dict], found: Runs) -> np.ndarray:
    """Marks of the block's runs from the answers of all buckets."""
    keys, at = found.distinct_keys()
    told = np.concatenate([np.zeros(0, np.uint8), *[unpack(r["marks"], np.uint8) for r in sorted(marks, key=lambda r: r["bucket"])]])
    assert len(told) == len(keys)
    return told[at]


def sending(buckets: int):
    """The pieces of a block whose keys are shared: distinct texts with the smallest id that has them here; and which
    pieces these are, for the block itself."""
    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        import zstandard

        row, marks = left.to_pylist()[0], right.to_pylist()
        if not any(np.any(unpack(r["marks"], np.uint8)) for r in marks):
            return pa.Table.from_batches([row_batch(PIECES, [])])
        found, data, ids = Runs(row), block_text(row), unpack(row["ids"], np.int64)
        each, count, number, keys, first, lowest = pieces(data, ids, found, unpack(row["counts"], np.uint8).astype(np.int64), joined_marks(marks, found))
        start, sizes = each[first], count[first] + LENGTH - 1
        cuts = bucket_cuts(keys, buckets)
        none = (None, None)
        own = int(mixed(np.array([row["block"]], np.uint64))[0] % np.uint64(buckets))
        out = [(-1 - own, row["block"], *none, *none, pack(each), pack(number))]
        for b, (i, j) in enumerate(zip(cuts[:-1], cuts[1:])):
            if i < j:
                text = data[within(start[i:j], sizes[i:j])]
                out.append((b, row["block"], pack_keys(keys[i:j]), pack(lowest[i:j]), pack(sizes[i:j].astype(np.uint16)),
                            zstandard.ZstdCompressor(level=3).compress(text.tobytes()), *none))
        return pa.Table.from_batches([row_batch(PIECES, out)])
    return run


def within(start: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of the ranges that begin at ``start``."""
    return np.repeat(start - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def sorted_suffixes(codes: np.ndarray, depth: int) -> np.ndarray:
    """Positions by the text from there (around the end), as far as the first ``depth`` codes tell."""
    n, size = len(codes), 7
    key = np.zeros(n, np.int64)
    for i in range(size):
        key = key << 9 | np.roll(codes, -i)
    while True:
        order = np.argsort(key)
        if size >= depth:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], key[order][1:] != key[order][:-1]]))
        key = rank * n + np.roll(rank, -size)
        size *= 2


def bounded_borders(bwt: np.ndarray, depth: int) -> np.ndarray:
    """Where neighbours in sorted order share fewer than ``depth`` codes (index: the later neighbour; both ends count).

    Round l holds intervals of suffixes that begin with the same l codes. Extending an interval backwards by each code in
    it gives intervals of l + 1 codes; a border that was not known before has a common prefix of exactly l codes, and
    only intervals that found one go on.
    """
    n = len(bwt)
    step = np.empty(n, np.int64)
    step[np.argsort(bwt, kind="stable")] = np.arange(n)
    run_start = np.flatnonzero(np.concatenate([[True], bwt[1:] != bwt[:-1]]))
    run_end = np.append(run_start[1:], n)
    run_of = np.repeat(np.arange(len(run_start)), run_end - run_start)
    run_code = bwt[run_start].astype(np.int64)
    known = np.zeros(n + 1, bool)
    known[[0, n]] = True
    low, high = np.array([0]), np.array([n])
    for _ in range(depth):
        one = high - low == 1
        lows, highs = [step[low[one]]], [step[low[one]] + 1]
        low, high = low[~one], high[~one]
        if len(low):
            first, sizes = run_of[low], run_of[high - 1] - run_of[low] + 1
            run, owner = within(first, sizes), np.repeat(np.arange(len(low)), sizes)
            a = step[np.maximum(run_start[run], low[owner])]
            b = step[np.minimum(run_end[run], high[owner]) - 1] + 1
            key = owner * 512 + run_code[run]
            order = np.argsort(key)
            cut = np.flatnonzero(np.concatenate([[True], np.diff(key[order]) > 0]))
            lows.append(np.minimum.reduceat(a[order], cut))
            highs.append(np.maximum.reduceat(b[order], cut))
        low, high = np.concatenate(lows), np.concatenate(highs)
        new = ~known[high]
        low, high = low[new], high[new]
        known[high] = True
        if not len(low):
            break
    return known


def smallest_ids(data: np.ndarray, sizes: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For every string of LENGTH bytes in the given texts, in order: the smallest id of a text that holds it."""
    q = len(sizes)
    base = np.cumsum(sizes + 1) - sizes - 1
    codes = np.zeros(len(data) + q, np.int64)
    codes[within(base, sizes)] = data.astype(np.int64) + 1
    order = sorted_suffixes(codes, LENGTH)
    known = bounded_borders(codes[order - 1].astype(np.int16), LENGTH)
    group = np.empty(len(codes), np.int64)
    group[order] = np.cumsum(known[:-1]) - 1
    count = sizes - LENGTH + 1
    at = group[within(base, count)]
    lowest = np.full(len(codes), LAST_ID)
    np.minimum.at(lowest, at, np.repeat(docs, count))
    return lowest[at]


def answering(key: tuple, asked: pa.Table) -> pa.Table:
    """For each piece of a bucket: intervals of its strings with the smallest id of a document that holds them. What blocks
    keep for themselves is passed on."""
    import zstandard

    if key[0].as_py() < 0:
        none = pa.nulls(asked.num_rows, pa.binary())
        return pa.table([asked[c] if c in asked.column_names and c != "docs" else none for c in ANSWER_COLUMNS], names=ANSWER_COLUMNS)
    rows = asked.to_pylist()
    per_row = [unpack_keys(r["keys"]) for r in rows]
    keys = np.concatenate(per_row)
    docs = np.concatenate([unpack(r["docs"], np.int64) for r in rows])
    sizes = np.concatenate([unpack(r["sizes"], np.uint16) for r in rows]).astype(np.int64)
    data = np.frombuffer(b"".join(zstandard.ZstdDecompressor().decompress(r["data"]) for r in rows), np.uint8)
    start = np.cumsum(sizes) - sizes
    order, new = equal_texts(data, start, sizes, keys)
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    at = np.flatnonzero(new)
    lowest, some = np.minimum.reduceat(docs[order], at), order[at]
    # texts that are alone under their key share no string with another
    alone = np.concatenate([[True], np.diff(keys[some]) != 0, [True]])
    mixed_keys = np.flatnonzero(~(alone[:-1] & alone[1:]))
    count = sizes[some] - LENGTH + 1
    intervals, ends, ids = np.ones(len(some), np.int64), count, lowest
    if len(mixed_keys):
        n = count[mixed_keys]
        found = smallest_ids(data[within(start[some[mixed_keys]], sizes[some[mixed_keys]])], sizes[some[mixed_keys]], lowest[mixed_keys])
        owner = np.repeat(np.arange(len(n)), n)
        last = np.flatnonzero(np.concatenate([(found[1:] != found[:-1]) | (owner[1:] != owner[:-1]), [True]]))
        intervals[mixed_keys] = np.bincount(owner[last], minlength=len(n))
        cut = np.cumsum(intervals) - intervals
        ends, ids = np.repeat(count, intervals), np.repeat(lowest, intervals)
        place = within(cut[mixed_keys], intervals[mixed_keys])
        ends[place] = last + 1 - (np.cumsum(n) - n)[owner[last]]
        ids[place] = found[last]
    cut = np.cumsum(intervals) - intervals
    out, done = [], 0
    for r, k in zip(rows, per_row):
        mine = number[done:done + len(k)]
        done += len(k)
        place = within(cut[mine], intervals[mine])
        out.append((key[0].as_py(), r["block"], pack(intervals[mine].astype(np.uint8)), pack(ends[place].astype(np.uint8)), pack(ids[place]), None, None))
    return pa.Table.from_batches([row_batch(ANSWERS, out)])


RESULT = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def removing(id_kind: pa.DataType, keep_text: bool):
    """A block's documents without the strings that a document with a smaller id has, too."""
    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        data, all_ids, sizes = block_text(row), unpack(row["ids"], np.int64), unpack(row["sizes"], np.int64)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        told = right.to_pylist()
        answers = sorted((r for r in told if r["bucket"] >= 0), key=lambda r: r["bucket"])
        start, number = (np.concatenate([np.zeros(0, np.int64), *[unpack(r[c], np.int64) for r in told if r["bucket"] < 0]]) for c in ("starts", "numbers"))
        doc = np.searchsorted(offsets, start, "right") - 1
        covered = np.zeros(len(data) + 1, np.int32)
        if answers:
            intervals = np.concatenate([unpack(r["intervals"], np.uint8) for r in answers]).astype(np.int64)
            ends = np.concatenate([unpack(r["ends"], np.uint8) for r in answers]).astype(np.int64)
            ids = np.concatenate([unpack(r["docs"], np.int64) for r in answers])
            cut = np.cumsum(intervals) - intervals
            begins = np.where(np.isin(np.arange(len(ends)), cut), 0, np.concatenate([[0], ends[:-1]]))
            n = intervals[number]
            at, owner = within(cut[number], n), np.repeat(np.arange(len(number)), n)
            gone = ids[at] < all_ids[doc[owner]]
            at, owner = at[gone], owner[gone]
            np.add.at(covered, start[owner] + begins[at], 1)
            np.add.at(covered, start[owner] + ends[at] + LENGTH - 1, -1)
        gone = np.cumsum(covered[:-1]) > 0
        first = gone.copy()
        first[1:] &= ~gone[:-1]
        edges = offsets[:-1][sizes > 0]
        first[edges] = gone[edges]
        upto, spans = (np.concatenate([[0], np.cumsum(x)])[offsets] for x in (gone, first))
        kept = data[~gone].tobytes()
        cuts = offsets - upto
        parts = [kept[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
        ids = pa.array([None if i == LAST_ID else i for i in all_ids.tolist()], pa.int64()).cast(id_kind)
        columns = {"doc_id": ids, "n_bytes": sizes, "n_removed": np.diff(upto), "n_spans": np.diff(spans),
                   "kept_sha256": [hashlib.sha256(p).hexdigest() for p in parts]}
        if keep_text:
            columns["kept"] = pa.array(parts, pa.binary())
        return pa.table(columns)
    return run


def without_repeats(docs: DataFrame, keep_text: bool = False, often: int = OFTEN) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept]) per row of ``docs``.

    Texts are UTF-8 bytes, null counts as empty; matches never cross documents and are judged on the input. Rows with
    the same id never remove bytes of each other; a null id counts as larger than all others. Texts shorter than LENGTH
    bytes lose nothing. An empty table gives no rows; further columns are ignored.

    First, keys: blocks of documents, stored with their runs, ask which of their hashes occur elsewhere. Second, the pieces
    with such hashes meet by hash and are compared. Third, blocks remove what they are told. Texts are hashed and stored
    once, compressed and in buckets of blocks, and never shuffled; the first step reads the runs alone.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType
    rows = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID)).alias("doc_id"), "text")
    cut = bucketed(rows.mapInArrow(blocks, BLOCKS), "repeats_blocks", "block")
    total = cut.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(16, -(-total // BUCKET_BYTES))
    asked = cut.select("block", "sizes", "starts", "keys").mapInArrow(asking(buckets), ASKED)
    marks = stored(asked.groupBy("bucket").applyInArrow(marking(often), MARKS), "repeats-marks")
    sent = cut.groupBy("block").cogroup(marks.groupBy("block")).applyInArrow(sending(buckets), PIECES)
    answers = stored(sent.groupBy("bucket").applyInArrow(answering, ANSWERS), "repeats-answers")
    extra = ", kept binary" if keep_text else ""
    texts = cut.select("block", "ids", "sizes", "data", "n_bytes")
    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        removing(to_arrow_type(kind), keep_text), f"doc_id {kind.simpleString()}, {RESULT}{extra}")


def query(spark, sf_dir: str) -> DataFrame:
    return without_repeats(read_table(spark, sf_dir, "documents"))


SQL = """
WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS MATERIALIZED (SELECT doc_id, p, hash(substr(h, CAST(2 * p + 1 AS BIGINT), 100)) AS s FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS p FROM b)),
f AS (SELECT s, min(doc_id) AS m FROM win GROUP BY s),
hit AS (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS q FROM win JOIN f USING (s) WHERE m < doc_id),
isle AS (SELECT doc_id, p, sum(CASE WHEN q IS NULL OR p > q + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM hit),
span AS (SELECT doc_id, k, min(p) AS a, max(p) + 50 AS z FROM isle GROUP BY doc_id, k),
part AS (SELECT doc_id, k, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY k), 0) AS y FROM span),
g AS (SELECT doc_id, sum(z - a) AS n_removed, count(*) AS n_spans, max(z) AS last,
             string_agg(substr(h, CAST(2 * y + 1 AS BIGINT), CAST(2 * (a - y) AS BIGINT)), '' ORDER BY k) AS kept FROM part JOIN b USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, CAST(2 * coalesce(last, 0) + 1 AS BIGINT)))) AS kept_sha256
FROM b LEFT JOIN g USING (doc_id)
"""
