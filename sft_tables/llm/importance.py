"""Importance resampling of documents towards a target text collection, by hashed word and word-pair features.

A feature's bucket is the CRC-32 of its bytes. Frequent words and frequent pairs of them (the head) are found in one pass
over all documents and broadcast with their CRC registers and buckets; whatever is not in these tables (the tail) has its
CRC computed from its bytes. Both give the same number, so bucket totals are exact whatever the head holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sft_tables.llm.common import LOWER, ROLL, UPPER, give_back, lowered, mixed, read_table, slices, stored, text_bytes

BUCKETS, PERCENT, LEAST_WORDS, SEED = 10_000, 25, 20, 7
#: Entries of the head, of what a task reports for it, and of what a task remembers meanwhile; longest word in it (bytes).
HEAD_WORDS, HEAD_PAIRS, REPORTED, REMEMBERED, HEAD_BYTES = 1 << 15, 1 << 16, 1 << 13, 1 << 18, 16
#: Longer texts are worked on in parts of about so many bytes, cut between words.
PART = 1 << 22
POLYNOMIAL = 0xEDB88320
START = np.uint32(0xFFFFFFFF)
#: Bytes of words after lower-casing: digits, letters, and everything beyond ASCII.
INSIDE = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])


def crc_table(bits: int) -> list[int]:
    """Registers that ``bits`` further bits shift to."""
    out = []
    for c in range(1 << bits):
        for _ in range(bits):
            c = c >> 1 ^ (POLYNOMIAL if c & 1 else 0)
        out.append(c)
    return out


TABLE = np.array(crc_table(8), np.uint32)


def advanced(register: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC registers after the bytes of spans."""
    register = register.copy()
    live = np.flatnonzero(ends > starts)
    at, stop = starts[live], ends[live]
    while len(live):
        now = register[live]
        register[live] = TABLE[(now ^ data[at]) & np.uint32(255)] ^ (now >> np.uint32(8))
        at = at + 1
        more = at < stop
        if not more.all():
            live, at, stop = live[more], at[more], stop[more]
    return register


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte of each word of lower-cased rows, the byte after it, and each row's first word (one more than rows)."""
    inside = INSIDE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    edge = np.concatenate([[False], inside, [False]])
    starts = np.flatnonzero(inside & (~edge[:-2] | first[:-1]))
    ends = np.flatnonzero(inside & (~edge[2:] | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The first 16 bytes of words as two numbers each; no word holds a zero byte, so shorter words are told apart."""
    padded = np.concatenate([data, np.zeros(HEAD_BYTES, np.uint8)])
    wide = np.lib.stride_tricks.as_strided(padded, (len(data) + 1, HEAD_BYTES), (1, 1))
    keys = np.ascontiguousarray(wide[starts]).view(np.uint64).reshape(-1, 2)
    length = ends - starts
    bits = np.concatenate([np.uint64(2**64 - 1) >> (np.uint64(64) - np.arange(8, 64, 8, dtype=np.uint64)), [np.uint64(2**64 - 1)]])
    keep = np.concatenate([[np.uint64(0)], bits])
    keys[:, 0] &= keep[np.minimum(length, 8)]
    keys[:, 1] &= keep[np.clip(length - 8, 0, 8)]
    return keys


def key_of(word: bytes) -> np.ndarray:
    return np.frombuffer(word.ljust(HEAD_BYTES, b"\0"), np.uint64)


def word_of(key: np.ndarray) -> bytes:
    return key.tobytes().rstrip(b"\0")


def spread(keys: np.ndarray) -> np.ndarray:
    return mixed(keys[:, 0] * ROLL + mixed(keys[:, 1]))


@dataclass
class Head:
    """Frequent words with their CRC registers, and frequent pairs of them with their buckets, in tables of slots."""

    words: np.ndarray
    registers: np.ndarray
    pairs: np.ndarray
    pair_buckets: np.ndarray
    word_slots: np.ndarray
    pair_slots: np.ndarray

    @staticmethod
    def of(words: list[bytes], pairs: list[tuple[bytes, bytes]], buckets: int) -> Head:
        keys = np.array([key_of(w) for w in words], np.uint64).reshape(-1, 2)
        place = {w: i for i, w in enumerate(words)}
        known = [(a, b) for a, b in pairs if a in place and b in place]
        data = np.frombuffer(b" ".join([*words, *(a + b" " + b for a, b in known)]), np.uint8)
        lengths = np.array([len(w) for w in words] + [len(a) + 1 + len(b) for a, b in known], np.int64)
        starts = np.cumsum(lengths + 1) - lengths - 1
        registers = advanced(np.full(len(lengths), START), data, starts, starts + lengths)
        numbers = np.array([place[a] << 32 | place[b] for a, b in known], np.uint64)
        pair_buckets = ((registers[len(words):] ^ START) % np.uint32(buckets)).astype(np.uint16)
        return Head(keys, registers[:len(words)], numbers, pair_buckets, slots(spread(keys), 4 * HEAD_WORDS), slots(mixed(numbers), 4 * HEAD_PAIRS))

    def numbers(self, keys: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Each word's place in the head, or -1; the whole word is compared."""
        if not len(self.words):
            return np.full(len(keys), -1, np.int64)
        found = self.word_slots[slot(spread(keys), len(self.word_slots))]
        same = (self.words[found] == keys).all(axis=1) & (found >= 0) & (length <= HEAD_BYTES)
        return np.where(same, found, -1)

    def pair_places(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.pairs):
            return np.full(len(left), -1, np.int64)
        numbers = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        found = self.pair_slots[slot(mixed(numbers), len(self.pair_slots))]
        return np.where((found >= 0) & (self.pairs[found] == numbers) & (left >= 0) & (right >= 0), found, -1)

    def buckets_of(self, data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Buckets of all words and of all pairs of rows, with each row's first word and first pair (one more than rows)."""
        data = lowered(data)
        starts, ends, first = spans(data, offsets)
        place = self.numbers(word_keys(data, starts, ends), ends - starts)
        register = np.full(len(starts), START)
        head = place >= 0
        register[head] = self.registers[place[head]]
        register[~head] = advanced(register[~head], data, starts[~head], ends[~head])
        words = ((register ^ START) % np.uint32(buckets)).astype(np.uint16)
        last = np.zeros(len(starts) + 1, bool)
        last[first[1:]] = True
        left = np.flatnonzero(~last[1:])
        known = self.pair_places(place[left], place[left + 1])
        pairs = np.zeros(len(left), np.uint16)
        pairs[known >= 0] = self.pair_buckets[known[known >= 0]]
        tail = left[known < 0]
        between = register[tail]
        between = TABLE[(between ^ np.uint32(32)) & np.uint32(255)] ^ (between >> np.uint32(8))
        pairs[known < 0] = ((advanced(between, data, starts[tail + 1], ends[tail + 1]) ^ START) % np.uint32(buckets)).astype(np.uint16)
        return words, pairs, first, np.searchsorted(left, first)


def slot(hashed: np.ndarray, size: int) -> np.ndarray:
    return (hashed >> np.uint64(64 - (size.bit_length() - 1))).astype(np.int64)


def slots(hashed: np.ndarray, size: int) -> np.ndarray:
    """Which entry a slot holds, or -1; of entries for one slot the first, the others count as tail."""
    out = np.full(size, -1, np.int32)
    at = slot(hashed, size)[::-1]
    out[at] = np.arange(len(hashed), dtype=np.int32)[::-1]
    return out


def cut(data: np.ndarray, start: int, most: int) -> int:
    """Where a part that begins at ``start`` ends: after a byte between words, about ``most`` bytes on."""
    stop = start + most
    if stop >= len(data):
        return len(data)
    gap = np.flatnonzero(~INSIDE[lowered(data[start:stop])])
    if len(gap):
        return start + int(gap[-1]) + 1
    while stop < len(data):
        gap = np.flatnonzero(~INSIDE[lowered(data[stop:stop + most])])
        if len(gap):
            return stop + int(gap[0]) + 1
        stop += most
    return len(data)


def in_parts(data: np.ndarray, most: int = PART) -> Iterator[tuple[np.ndarray, int]]:
    """A text in parts that end between words, each led by the last word before it, and how many words lead (0 or 1)."""
    start, lead = 0, data[:0]
    while start < len(data):
        stop = cut(data, start, most)
        yield np.concatenate([lead, data[start:stop]]), int(len(lead) > 0)
        starts, ends, _ = spans(lowered(data[start:stop]), np.array([0, stop - start]))
        if len(starts):
            lead = np.concatenate([data[start:stop][starts[-1]:ends[-1]], np.array([32], np.uint8)])
        start = stop


def row_parts(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, Iterator[tuple[np.ndarray, np.ndarray, int]]]]:
    """Slices of batches, each with its text as (bytes, row offsets, leading words): one of these, or several of one long row."""
    for batch in slices(batches, column):
        data, offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))
        if len(data) <= PART:
            yield batch, iter([(data, offsets, 0)])
        else:
            yield batch, ((part, np.array([0, len(part)]), lead) for part, lead in in_parts(data))


class Frequent:
    """The most frequent of a stream of keys, with bounded memory: when there are too many, the rarer half is forgotten.

    Counts may be too low then; the head is a table for speed, and results do not depend on it.
    """

    def __init__(self, width: int):
        self.hashes, self.counts, self.keys = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros((0, width), np.uint64)

    def add(self, hashes: np.ndarray, keys: np.ndarray) -> None:
        found, shown, counts = np.unique(hashes, return_index=True, return_counts=True)
        self.hashes = np.concatenate([self.hashes, found])
        self.counts = np.concatenate([self.counts, counts])
        self.keys = np.concatenate([self.keys, keys[shown]])
        if len(self.hashes) > REMEMBERED:
            self.trim(REMEMBERED // 2)

    def trim(self, most: int) -> None:
        self.hashes, shown, each = np.unique(self.hashes, return_index=True, return_inverse=True)
        self.counts, self.keys = np.bincount(each, self.counts, len(shown)).astype(np.int64), self.keys[shown]
        if len(shown) > most:
            best = np.sort(np.argpartition(-self.counts, most)[:most])
            self.hashes, self.counts, self.keys = self.hashes[best], self.counts[best], self.keys[best]


def head_of(docs: DataFrame, buckets: int = BUCKETS) -> Head:
    """Frequent words and pairs of all documents; every task reports a bounded number of each, and counts are added up."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pairs = Frequent(2), Frequent(4)
        for _, texts in row_parts(batches, "text"):
            for data, offsets, _ in texts:
                data = lowered(data)
                starts, ends, first = spans(data, offsets)
                keys = word_keys(data, starts, ends)
                hashes = spread(keys)
                short = ends - starts <= HEAD_BYTES
                words.add(hashes[short], keys[short])
                last = np.zeros(len(starts) + 1, bool)
                last[first[1:]] = True
                left = np.flatnonzero(~last[1:])
                left = left[short[left] & short[left + 1]]
                pairs.add(mixed(hashes[left] * ROLL + hashes[left + 1]), np.concatenate([keys[left], keys[left + 1]], axis=1))
        words.trim(REPORTED)
        pairs.trim(REPORTED)
        yield pa.RecordBatch.from_arrays([
            pa.array([word_of(k[:2]) for k in words.keys] + [word_of(k[:2]) for k in pairs.keys], pa.binary()),
            pa.array([None] * len(words.keys) + [word_of(k[2:]) for k in pairs.keys], pa.binary()),
            pa.array(np.concatenate([words.counts, pairs.counts]), pa.int64()),
        ], ["first", "second", "times"])
        give_back()

    counted = stored(docs.select("text").mapInArrow(run, "first binary, second binary, times bigint").groupBy("first", "second").agg(F.sum("times").alias("times")), "importance-head")
    best = [F.desc("times"), "first", "second"]
    words = counted.filter("second IS NULL").orderBy(*best).limit(HEAD_WORDS).collect()
    pairs = counted.filter("second IS NOT NULL").orderBy(*best).limit(HEAD_PAIRS).collect()
    return Head.of([bytes(r["first"]) for r in words], [(bytes(r["first"]), bytes(r["second"])) for r in pairs], buckets)


def packed_rows(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Runs of 16-bit numbers as a binary column."""
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer((offsets * 2).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(values))])


def bucketed_features(docs: DataFrame, head: Head, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_words, words, pairs) per row: the buckets of its words and of its pairs as 16-bit numbers."""
    if buckets > 1 << 16:
        raise ValueError("bucket numbers need more than 16 bits")
    shared = docs.sparkSession.sparkContext.broadcast(head)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch, texts in row_parts(batches, "text"):
            found = []
            for data, offsets, lead in texts:
                words, pairs, first, first_pair = known.buckets_of(data, offsets, buckets)
                found.append((words[lead:], pairs, first - np.minimum(first, lead), first_pair))
            words, pairs = (np.concatenate([f[i] for f in found]) for i in (0, 1))
            first, first_pair = (found[0][i] if len(found) == 1 else np.array([0, len(all_)]) for i, all_ in ((2, words), (3, pairs)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(first), pa.int64()), packed_rows(words, first).cast(pa.binary()), packed_rows(pairs, first_pair).cast(pa.binary())],
                ["doc_id", "n_words", "words", "pairs"])
        give_back()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words bigint, words binary, pairs binary")


def totals(features: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all rows by bucket; every task sends one number per bucket, which are added up by bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for column in batch.columns:
                total += np.bincount(text_bytes(column)[0].view(np.uint16), minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in features.select("words", "pairs").mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket, a thousand times the logarithm of the ratio of its smoothed shares, rounded down."""
    s, t, buckets = source.astype(np.float64), target.astype(np.float64), float(len(source))
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weighted(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight): the floored mean of the gains of a row's features, 0 without any."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for name in ("words", "pairs"):
                data, offsets = text_bytes(batch.column(batch.schema.get_field_index(name)))
                running = np.concatenate([[0], np.cumsum(gain[data.view(np.uint16)])])[offsets // 2]
                number, total = number + np.diff(offsets) // 2, total + np.diff(running)
            weight = np.where(number > 0, total // np.maximum(number, 1), 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(number), pa.array(weight)], ["doc_id", "n_words", "n_features", "weight"])

    kind = features.schema["doc_id"].dataType.simpleString()
    return features.mapInArrow(run, f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint")


def ranked(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of (doc_id, n_words, n_features, weight, score): ranks of the drawn rows.

    Rows are sorted over ranges of (score, id), with a number of their own so that equal rows spread; a row's rank is its
    place in its range and the rows of the ranges before it. The driver sees one count per range.
    """
    spark = scored.sparkSession
    columns = ["doc_id", "n_features", "weight", "score"]
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("weight"), F.col("_salt")]
    ranges = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = (
        scored.filter(F.col("n_words") >= least_words).withColumn("_salt", F.rand(1))
        .repartitionByRange(ranges, *order).sortWithinPartitions(*order).select(*columns, F.monotonically_increasing_id().alias("_at"))
    )
    placed = stored(placed, "importance-ranked")
    part = F.shiftright("_at", 33)
    counts = placed.groupBy(part.alias("_part")).count().collect()
    before, number = [], 0
    for r in sorted(counts, key=lambda r: r["_part"]):
        before.append((r["_part"], number))
        number += r["count"]
    place = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    offsets = spark.createDataFrame(before, "_part bigint, _before bigint")
    with_rank = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part").select(
        *columns, F.when(place <= percent * number // 100, place).alias("rank"))
    return with_rank.unionByName(scored.filter(F.col("n_words") < least_words).select(*columns, F.lit(None).cast("bigint").alias("rank")))


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) per row of ``docs``: how much its words and word pairs look like those of
    ``target``, the weight with its random term, and the row's place among the drawn ones (null: not drawn).

    Of the rows with at least ``least_words`` words, ``percent`` of a hundred are drawn, highest score first, ties to the
    smaller id. Null and empty texts have no features and weight 0; texts are worked on whole, in parts of megabytes; a
    null id draws its random term as an empty text and comes last in ties; repeated rows are rows of their own, with
    ranks of their own; an empty table gives no rows; an empty target has no features; further columns are ignored.
    """
    head = head_of(docs, buckets)
    source = stored(bucketed_features(docs, head, buckets), "importance-features")
    aim = bucketed_features(target.select(F.lit(0).alias("doc_id"), "text"), head, buckets)
    gain = gains(totals(source, buckets), totals(aim, buckets))
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8)
    noise = F.floor(-1000 * F.log(-F.log((F.conv(digits, 16, 10).cast("bigint") + 0.5) / 4294967296.0)))
    scored = stored(weighted(source, gain).withColumn("score", F.col("weight") + noise), "importance-scores")
    return ranked(scored, percent, least_words)


def drawn_documents(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are drawn, with all their columns. Rows of one id are drawn together."""
    ids = resampled(docs, target, **options).filter("rank IS NOT NULL").select(F.col("doc_id").alias("_drawn")).distinct()
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["_drawn"]), "left_semi")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


SQL = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
df AS (
  SELECT doc_id, len(w) AS n_words, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM d),
bf AS (
  SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM b),
dc AS MATERIALIZED (SELECT doc_id, f, count(*) AS n FROM df GROUP BY doc_id, f),
names AS (SELECT f, hex(encode(f)) AS h FROM (SELECT f FROM dc UNION SELECT f FROM bf)),
codes AS MATERIALIZED (
  SELECT f, xor(list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(0, length(h)), lambda j: CAST(instr('0123456789ABCDEF', substr(h, j + 2 - 2 * (j % 2), 1)) - 1 AS BIGINT))),
    lambda a, x: xor(a >> 4, {[int(c) for c in crc_table(4)]}[(xor(a, x) & 15) + 1])), 4294967295) % {BUCKETS} AS bucket
  FROM names),
s AS (SELECT bucket, CAST(sum(n) AS BIGINT) AS s FROM dc JOIN codes USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM bf JOIN codes USING (f) GROUP BY bucket),
sums AS (SELECT CAST(coalesce((SELECT sum(s) FROM s), 0) AS DOUBLE) AS ss, CAST(coalesce((SELECT sum(t) FROM t), 0) AS DOUBLE) AS tt),
g AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1) * (ss + {BUCKETS}) / ((coalesce(s, 0) + 1) * (tt + {BUCKETS})))) AS BIGINT) AS gain
  FROM s FULL JOIN t USING (bucket), sums),
w AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_features, CAST(floor(CAST(sum(n * gain) AS DOUBLE) / sum(n)) AS BIGINT) AS weight FROM dc JOIN codes USING (f) JOIN g USING (bucket) GROUP BY doc_id),
r AS (
  SELECT doc_id, len(w) AS n_words, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
    CAST(('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8)) AS BIGINT) AS h FROM d LEFT JOIN w USING (doc_id)),
x AS (SELECT doc_id, n_words, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM r),
k AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS number FROM x WHERE n_words >= {LEAST_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN place <= {PERCENT} * number // 100 THEN place END AS rank FROM x LEFT JOIN k USING (doc_id)
"""
