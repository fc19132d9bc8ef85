"""What the operators share: reading tables, word rules, slices of Arrow batches, tables in the shared folder."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sft_tables.session import configure, scratch_dir
from sft_tables.session import written as stored  # noqa: F401

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 1 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % divisor


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its offsets (one more than rows); null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0]:offsets[-1]] if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``most`` bytes of text, or one longer row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        ends = text_bytes(column)[1][1:]
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + most, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def give_back() -> None:
    """Return freed memory to the system at the end of a task; C libraries keep it otherwise, and workers are reused."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def uniform(doc_id: Column, seed: str = "") -> Column:
    """A number in (0, 1) from 52 bits of the id's MD5, in the order of the MD5s: the same on every run."""
    digits = F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 13)
    return (F.conv(digits, 16, 10).cast("bigint") + 0.5) / float(16**13)


def sample_ids(rows: DataFrame, label: str, most: int) -> list[tuple]:
    """At most ``most`` (doc_id, label) of each label: the first by the ids' MD5, the same on every run.

    Labels are counted first; then all but about ``most`` ids of each are passed over by their MD5 alone, so that only a
    bounded number of ids per label is ever gathered, whatever the size of the table. Bounded by the number of labels.
    """
    counts = dict(rows.groupBy(label).count().collect())
    if not counts:
        return []
    wanted = most + 6 * most**0.5 + 20
    cut = F.element_at(F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, wanted / n))]), F.col(label))
    near = rows.select("doc_id", label, uniform(F.col("doc_id")).alias("_u")).filter(F.col("_u") <= cut).distinct().collect()
    out: list[tuple] = []
    for k in counts:
        out += [(i, k) for _, i in sorted((u, i) for i, v, u in near if v == k)[:most]]
    return out


#: Multiplier of the rolling hashes (odd, so that its powers are units modulo 2**64) and the constants of the final mix.
ROLL = np.uint64(0x9E3779B97F4A7C15)
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (one to one)."""
    x = (x ^ (x >> np.uint64(30))) * MIX[0]
    x = (x ^ (x >> np.uint64(27))) * MIX[1]
    return x ^ (x >> np.uint64(31))


def lowered(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all rows, lower-cased A-Z, in order; and each row's first word (one more than rows)."""
    starts, ends, first = word_spans(data, offsets)
    return word_hashes(lowered(data), starts, ends), first


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte of each word, the byte after it, and each row's first word (one more than rows)."""
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    edge = np.concatenate([[True], blank, [True]])
    starts = np.flatnonzero(~blank & (edge[:-2] | first[:-1]))
    ends = np.flatnonzero(~blank & (edge[2:] | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span, by its bytes and its length: eight bytes at a time, longer words in more rounds."""
    out = np.zeros(len(starts), np.uint64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    wide = np.lib.stride_tricks.as_strided(padded, (len(data) + 1, 8), (1, 1))
    length = ends - starts
    live, at = np.arange(len(starts)), starts
    keep = np.concatenate([[np.uint64(0)], (np.uint64(2**64 - 1) >> (np.uint64(64) - np.arange(8, 64, 8, dtype=np.uint64))), [np.uint64(2**64 - 1)]])
    while len(live):
        piece = np.ascontiguousarray(wide[at]).view(np.uint64).ravel()
        left = ends[live] - at
        piece &= keep[np.minimum(left, 8)]
        out[live] = mixed((out[live] + np.minimum(left, 8).astype(np.uint64)) * ROLL + piece)
        more = left > 8
        live, at = live[more], at[more] + 8
    return mixed(out + length.astype(np.uint64))


def pack(values: np.ndarray) -> bytes:
    """Numbers as compressed bytes, equal byte places together."""
    import zstandard

    raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1) if len(values) else np.zeros((0, 1), np.uint8)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(raw.T).tobytes())


def unpack(data: bytes, dtype) -> np.ndarray:
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(dtype).ravel() if len(raw) else np.zeros(0, dtype)


def pack_keys(keys: np.ndarray) -> bytes:
    """Ascending 64-bit keys as compressed differences."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


def bucket_cuts(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Borders of the buckets in ascending 64-bit keys; buckets are even ranges of the key space."""
    lows = [np.uint64((b << 64) // buckets) for b in range(1, buckets)]
    return np.concatenate([[0], np.searchsorted(keys, np.array(lows, np.uint64)), [len(keys)]]).astype(np.int64)


def text_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices with their word hashes and each row's first word."""
    for batch in slices(batches):
        yield (batch, *words(*text_bytes(batch.column(batch.schema.get_field_index("text")))))


def shared_write(df: DataFrame, name: str, *by: str) -> str:
    """Write a table to the shared folder in folders by some columns; gives its path."""
    path = scratch_dir(df.sparkSession, name)
    df.write.partitionBy(*by).parquet(path)
    return path


def bucketed(df: DataFrame, name: str, column: str) -> DataFrame:
    """Write a table to the shared folder in hash buckets of a column, so that later joins on it leave it where it is.

    The table is registered under a name of its own; there are as many buckets as shuffle partitions.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    table = f"{name}_{path.rstrip('/').rpartition('-')[2]}".replace("-", "_").replace(".", "_")
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    df.write.bucketBy(buckets, column).format("parquet").option("path", path).saveAsTable(table)
    return spark.table(table)
