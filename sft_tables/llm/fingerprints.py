"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is cut into paragraphs; their digests are thrown into a table of cells, each with a count and sums of digests.
Tables of two versions are subtracted, which leaves only the differing paragraphs, and peeling cells with a single digest
recovers these. A table folds to any smaller one, so two fingerprints are compared at a small size first, and at larger
ones where that cannot be peeled. A table is made large enough that it can be peeled alone, which is the last resort for
texts of very different lengths: any two fingerprints can be compared, from their strings alone.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sft_tables.llm.common import SLICE_BYTES, mixed, read_table, slices, text_bytes, word_hashes, word_spans

#: Every digest lies in one cell of each third of a table; cells of the smallest third (a power of two).
PARTS = 3
LEAST = 16
#: Long paragraphs are cut further after sentence ends, and after one word in so many, chosen by its hash.
WORDS_PER_CUT = 8
SALTS = [np.uint64(x) for x in (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0, 0x082EFA98EC4E6C89)]
FIRST_ID = -(2**63)


def paragraphs(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(digests, row of each): every byte lies in one paragraph; the n-th repetition in a text has a digest of its own.

    A paragraph ends, after its white space, at a line end, a sentence end, or a word whose hash says so.
    """
    data, offsets = text_bytes(pa.array(texts, pa.large_string()))
    starts, ends, first = word_spans(data, offsets)
    after = np.append(data, np.uint8(10))[ends] if len(ends) else np.zeros(0, np.uint8)
    final = data[ends - 1] if len(ends) else after
    cut = (after == 10) | (final == 46) | (final == 33) | (final == 63) | (word_hashes(data, starts, ends) % np.uint64(WORDS_PER_CUT) == 0)
    # the last word of a text says nothing about the next text
    cut[first[1:][first[1:] > first[:-1]] - 1] = False
    begins = np.zeros(len(data) + 1, bool)
    begins[starts[1:][cut[:-1]]] = True
    begins[offsets[:-1][np.diff(offsets) > 0]] = True
    begins[len(data):] = False
    at = np.flatnonzero(begins)
    digests = word_hashes(data, at, np.append(at[1:], len(data)))
    rows = np.searchsorted(offsets, at, "right") - 1
    order = np.lexsort((digests, rows))
    same = np.concatenate([[False], (digests[order][1:] == digests[order][:-1]) & (rows[order][1:] == rows[order][:-1])]) if len(at) else np.zeros(0, bool)
    since = np.arange(len(at)) - np.maximum.accumulate(np.where(same, 0, np.arange(len(at)))) if len(at) else np.zeros(0, int)
    again = np.zeros(len(at), np.uint64)
    again[order] = since.astype(np.uint64)
    digests = mixed(digests + again * SALTS[3])
    order = np.lexsort((digests, rows))
    digests, rows = digests[order], rows[order]
    # sums cannot hold a digest twice; that two paragraphs of a text have one by chance is as good as impossible
    new = np.concatenate([[True], (digests[1:] != digests[:-1]) | (rows[1:] != rows[:-1])]) if len(rows) else np.zeros(0, bool)
    return digests[new], rows[new]


def check(keys: np.ndarray) -> np.ndarray:
    return mixed(keys ^ SALTS[3]) >> np.uint64(32)


def power_of_two(least: np.ndarray) -> np.ndarray:
    """The next power of two, LEAST at least."""
    return np.int64(1) << np.ceil(np.log2(np.maximum(least, LEAST))).astype(np.int64)


def ranges(start: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of the ranges that begin at ``start``."""
    return np.repeat(start - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


class Tables:
    """Sketches of many owners, cell by cell; each owner has thirds of its own size."""

    def __init__(self, third: np.ndarray):
        self.third = np.asarray(third, np.int64)
        self.start = np.cumsum(PARTS * self.third) - PARTS * self.third
        self.owner = np.repeat(np.arange(len(self.third)), PARTS * self.third)
        # counts are kept modulo 256, which peeling does not mind
        self.count = np.zeros(len(self.owner), np.uint8)
        self.keys = np.zeros(len(self.owner), np.uint64)
        self.checks = np.zeros(len(self.owner), np.uint64)

    def places(self, keys: np.ndarray, owners: np.ndarray) -> list[np.ndarray]:
        """The cell of each key in each third of its owner's table."""
        third = self.third[owners]
        mask = (third - 1).astype(np.uint64)
        return [self.start[owners] + j * third + (mixed(keys ^ SALTS[j]) & mask).astype(np.int64) for j in range(PARTS)]

    def add(self, keys: np.ndarray, owners: np.ndarray, signs: np.ndarray) -> None:
        checks = check(keys)
        for at in self.places(keys, owners):
            np.add.at(self.count, at, signs)
            np.bitwise_xor.at(self.keys, at, keys)
            np.bitwise_xor.at(self.checks, at, checks)

    def add_folded(self, other: Tables, rows: np.ndarray, sign: int) -> None:
        """Add (or take off) the table ``rows[i]`` of others to the i-th table here, folded to its size."""
        sizes = PARTS * other.third[rows]
        cell = ranges(other.start[rows], sizes)
        owner = np.repeat(np.arange(len(rows)), sizes)
        within = cell - other.start[rows][owner]
        part, place = np.divmod(within, other.third[rows][owner])
        at = self.start[owner] + part * self.third[owner] + (place & (self.third[owner] - 1))
        np.add.at(self.count, at, other.count[cell] if sign > 0 else -other.count[cell])
        np.bitwise_xor.at(self.keys, at, other.keys[cell])
        np.bitwise_xor.at(self.checks, at, other.checks[cell])

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(keys, their owners, signs) recovered; what could not be is left in the tables."""
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint8))]
        look = np.arange(len(self.owner))
        while len(look):
            count = self.count[look]
            look = look[(count == 1) | (count == 255)]
            pure = look[check(self.keys[look]) == self.checks[look]]
            if not len(pure):
                break
            owners = self.owner[pure]
            order = np.lexsort((self.keys[pure], owners))
            pure, owners = pure[order], owners[order]
            keys = self.keys[pure]
            new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])])
            keys, owners, signs = keys[new], owners[new], self.count[pure][new]
            self.add(keys, owners, -signs)
            found.append((keys, owners, signs))
            look = np.unique(np.concatenate(self.places(keys, owners)))
        return tuple(np.concatenate(x) for x in zip(*found))

    def empty(self) -> np.ndarray:
        left = np.bincount(self.owner[(self.count != 0) | (self.keys != 0) | (self.checks != 0)], minlength=len(self.third))
        return left == 0

    def some(self, rows: np.ndarray) -> Tables:
        """A copy of some owners' tables."""
        out = Tables(self.third[rows])
        cell = ranges(self.start[rows], PARTS * self.third[rows])
        out.count, out.keys, out.checks = self.count[cell], self.keys[cell], self.checks[cell]
        return out


class Sketches(Tables):
    """Fingerprints of many texts: tables that can be peeled alone, with the number of digests in each."""

    def __init__(self, third: np.ndarray, sizes: np.ndarray):
        super().__init__(third)
        self.sizes = np.asarray(sizes, np.int64)
        #: What peeling each table alone gave, where that is known: (digests, owners), ascending by owner.
        self.peeled: tuple[np.ndarray, np.ndarray] | None = None

    @classmethod
    def of(cls, digests: np.ndarray, rows: np.ndarray, texts: int) -> Sketches:
        """Of each text's digests (different ones, by text): about two cells for each, more where that cannot be peeled."""
        sizes = np.bincount(rows, minlength=texts)
        third = power_of_two(-(-2 * sizes // PARTS))
        todo, recovered = np.ones(texts, bool), []
        while todo.any():
            trial = Tables(np.where(todo, third, 0))
            mine = todo[rows]
            trial.add(digests[mine], rows[mine], np.ones(int(mine.sum()), np.uint8))
            keys, owners, _ = trial.peel()
            done = todo & trial.empty()
            recovered.append((keys[done[owners]], owners[done[owners]]))
            todo &= ~done
            third[todo] *= 2
        out = cls(third, sizes)
        out.add(digests, rows, np.ones(len(rows), np.uint8))
        keys, owners = (np.concatenate(x) for x in zip(*recovered)) if recovered else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        order = np.argsort(owners, kind="stable")
        out.peeled = keys[order], owners[order]
        return out

    def alone(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The digests of some fingerprints, peeled alone, and which of ``rows`` each belongs to."""
        if self.peeled is None:
            keys, owners, _ = self.some(rows).peel()
            return keys, owners
        keys, owners = self.peeled
        cuts = np.searchsorted(owners, np.arange(len(self.third) + 1))
        sizes = cuts[rows + 1] - cuts[rows]
        return keys[ranges(cuts[rows], sizes)], np.repeat(np.arange(len(rows)), sizes)

    def texts(self) -> list[str]:
        """Each fingerprint as text: number of digests, cells of a third, then counts, digest sums and check sums."""
        ends = self.start + PARTS * self.third
        out = []
        for n, third, a, z in zip(self.sizes.tolist(), self.third.tolist(), self.start.tolist(), ends.tolist()):
            raw = self.count[a:z].tobytes() + self.keys[a:z].astype("<u8").tobytes() + self.checks[a:z].astype("<u4").tobytes()
            out.append(f"{n}:{third}:{base64.b64encode(raw).decode()}")
        return out

    @classmethod
    def read(cls, prints: list[str]) -> Sketches:
        parts = [p.split(":") for p in prints]
        out = cls(np.array([int(p[1]) for p in parts], np.int64), np.array([int(p[0]) for p in parts], np.int64))
        for i, p in enumerate(parts):
            raw, a, n = base64.b64decode(p[2]), out.start[i], PARTS * out.third[i]
            out.count[a:a + n] = np.frombuffer(raw, np.uint8, n)
            out.keys[a:a + n] = np.frombuffer(raw, "<u8", n, n)
            out.checks[a:a + n] = np.frombuffer(raw, "<u4", n, 9 * n)
        return out

    def differing(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """How many digests differ between the fingerprints ``left[i]`` and ``right[i]``, by subtracting and peeling.

        Pairs are folded to a size that suits texts which have most in common, and to one twice as large as long as the
        difference cannot be peeled, up to the smaller of the two; then both are peeled alone.
        """
        out = np.zeros(len(left), np.int64)
        most = np.minimum(self.third[left], self.third[right])
        third = np.minimum(power_of_two((self.sizes[left] + self.sizes[right]) // 6), most)
        todo = np.arange(len(left))
        alone = []
        while len(todo):
            tables = Tables(third[todo])
            tables.add_folded(self, left[todo], 1)
            tables.add_folded(self, right[todo], -1)
            _, owners, _ = tables.peel()
            done = tables.empty()
            out[todo[done]] = np.bincount(owners, minlength=len(todo))[done]
            todo = todo[~done]
            alone.append(todo[third[todo] >= most[todo]])
            todo = todo[third[todo] < most[todo]]
            third[todo] *= 2
        last = np.concatenate([np.zeros(0, np.int64), *alone])
        if len(last):
            keys, owners = [], []
            for rows in (left[last], right[last]):
                found, owner = self.alone(rows)
                keys.append(found)
                owners.append(owner)
            key, owner = np.concatenate(keys), np.concatenate(owners)
            order = np.lexsort((key, owner))
            key, owner = key[order], owner[order]
            same = np.flatnonzero((key[1:] == key[:-1]) & (owner[1:] == owner[:-1]))
            out[last] = np.bincount(owner, minlength=len(last)) - 2 * np.bincount(owner[same], minlength=len(last))
        return out

    def likeness(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Share of common paragraphs among all of two texts; two empty texts are alike."""
        both = self.sizes[left] + self.sizes[right]
        common = (both - self.differing(left, right)) / 2
        return np.where(both == 0, 1.0, common / np.maximum(both - common, 1))


def likeness(fingerprint: str, other: str) -> float:
    """Of two fingerprints as ``fingerprinted`` gives them: the share of common paragraphs among all of both texts."""
    return float(Sketches.read([fingerprint, other]).likeness(np.array([0]), np.array([1]))[0])


def edited(text: str, following: str) -> str:
    """The last third of the code points (rounded down) replaced by the first as many, or all, of the next text."""
    k = len(text) // 3
    return text[:len(text) - k] + following[:k]


COLUMNS = "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compared(texts: list[str]) -> list[list]:
    """Columns of COLUMNS for all texts but the last, each with the text after it."""
    n = len(texts) - 1
    changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
    found = Sketches.of(*paragraphs(texts + changed), 2 * n + 1)
    prints, own = found.texts(), np.arange(n)
    return [[len(t) for t in texts[:n]], [hashlib.sha256(t.encode()).hexdigest() for t in changed], prints[:n], prints[n + 1:],
            found.likeness(own, own + n + 1).tolist(), found.likeness(own, own + 1).tolist()]


def borders(docs: DataFrame, parts: int) -> tuple[np.ndarray, dict[int, int], dict[int, int]]:
    """Cuts of the id range into even parts, by descending id; each part's first id and the part before it (round)."""
    ids = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(FIRST_ID)).alias("id"))
    fractions = F.array(*[F.lit(i / parts) for i in range(1, parts)]) if parts > 1 else F.array(F.lit(0.5))
    cuts = np.array(ids.agg(F.percentile_approx("id", fractions, 100 * parts)).first()[0] or [], np.int64)

    def highest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(0).to_numpy(zero_copy_only=False)
            part = part_of(key, cuts)
            order = np.lexsort((key, part))
            last = np.flatnonzero(np.append(np.diff(part[order]) > 0, True)) if len(key) else order
            yield pa.RecordBatch.from_arrays([pa.array(part[order][last]), pa.array(key[order][last])], ["part", "id"])

    heads = {r[0]: r[1] for r in ids.mapInArrow(highest, "part bigint, id bigint").groupBy("part").agg(F.max("id")).collect()}
    filled = sorted(heads)
    return cuts, heads, {p: filled[i - 1] for i, p in enumerate(filled)}


def part_of(key: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    return len(cuts) - np.searchsorted(cuts, key, "left")


def fingerprinted(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) per row of ``docs``.

    The next document has the next smaller id; after the last comes the first. Rows with the same id follow each other
    by text; a null id comes last, a null text counts as empty, a single row is its own next. Empty texts have no
    paragraphs; two of them are alike (1). An empty table gives no rows; further columns are ignored.

    Texts move once: ids are cut into ``parts`` even ranges (shuffle partitions, if not given; the borders and each
    range's first id are all that the driver sees), each range is sorted and streamed, and a range's first document is
    also sent to the range before it.
    """
    spark = docs.sparkSession
    parts = parts or max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 << 15))
    cuts, heads, before = borders(docs, parts)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            key = batch.column(0).to_numpy(zero_copy_only=False)
            part = part_of(key, cuts)
            head = np.flatnonzero([heads[p] == k for p, k in zip(part.tolist(), key.tolist())])
            for rows, to, guest in ((None, part, 0), (head, np.array([before[p] for p in part[head].tolist()], np.int64), 1)):
                some = batch if rows is None else batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(np.full(len(to), guest), pa.int32()), *some.columns],
                                                 ["part", "guest", "key", "doc_id", "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        part, size, over = -1, 0, False

        def flush() -> pa.RecordBatch:
            columns = compared([t for _, t in held])
            kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            return pa.RecordBatch.from_arrays([pa.array([i for i, _ in held[:-1]], id_kind), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                                              ["doc_id", *(c.split()[0] for c in COLUMNS.split(", "))])

        for batch in slices(batches):
            for to, guest, doc_id, text in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4))):
                if to != part:
                    held, part, size, over = [], to, 0, False
                if over:
                    continue
                held.append((doc_id, text))
                size += len(text)
                over = guest == 1
                if len(held) > 1 and (over or size >= SLICE_BYTES):
                    yield flush()
                    held, size = held[-1:], len(text)

    from pyspark.sql.pandas.types import to_arrow_type

    id_kind = to_arrow_type(docs.schema["doc_id"].dataType)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(FIRST_ID)).alias("key"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    routed = rows.mapInArrow(route, f"part int, guest int, key bigint, doc_id {kind}, text string")
    ordered = routed.repartitionById(parts, "part").sortWithinPartitions("part", "guest", F.desc("key"), "text")
    return ordered.mapInArrow(run, f"doc_id {kind}, {COLUMNS}")


def query(spark, sf_dir: str) -> DataFrame:
    return fingerprinted(read_table(spark, sf_dir, "documents"))
