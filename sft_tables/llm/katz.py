"""Language-model scoring by Katz backoff: Good-Turing discounted counts, exactly normalised backoff weights.

The corpus is cut into blocks of whole documents. Each block asks for its distinct n-grams once: asks go to buckets of
the n-gram hash, where all blocks' training counts meet, become the model's tables and are answered. Everything that
crosses the network is packed arrays of distinct n-grams per (block, bucket); no n-gram and no document is a hot key.

    P(w) = d(c(w)) c(w) / N                          for known words; what is left goes to unknown ones
    P(w | h) = d(c(h, w)) c(h, w) / c(h)             where (h, w) was seen
             = a(h) P(w)                             else, a(h) = (1 - sum of the above) / (1 - sum of their P(w))
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sft_tables.llm.common import (ROLL, bucket_cuts, bucketed, mixed, pack, pack_keys, read_table, remainder, shared_write, text_rows, unpack,
                                   unpack_keys)

#: Tokens of a block and, on average, of a bucket.
BLOCK_TOKENS, BUCKET_TOKENS = 1 << 21, 1 << 20
#: Word pairs are compared by 56 bits of their hashes.
PAIR_BITS = np.uint64(2**64 - 2**8)
#: Counts up to this are discounted by Good-Turing, higher ones by RESERVE, so that every context keeps something for new words.
LAST_DISCOUNTED = 5
RESERVE = 1e-3
START, END = np.uint64(1), np.uint64(2)

BLOCKS = "block bigint, ids binary, sizes binary, train binary, vocabulary binary, tokens binary, n_tokens bigint"
ASKED = "level int, bucket int, block bigint, keys binary, counts binary"
ANSWERED = "kind string, level int, bucket int, block bigint, keys binary, counts binary, owner binary, stats array<bigint>"
CONTEXTS = "bucket int, block bigint, keys binary, counts binary, lower binary"
WEIGHTS = "kind string, bucket int, block bigint, keys binary, weights binary"


def _ids(values: list) -> bytes:
    import pickle

    return pickle.dumps(values)


def _unids(data: bytes) -> list:
    import pickle

    return pickle.loads(data)


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole documents as numbers into a block's own vocabulary; each document's tokens end with END."""
    task, count = TaskContext.get().partitionId(), 0
    ids: list = []
    train: list[np.ndarray] = []
    sizes: list[np.ndarray] = []
    tokens: list[np.ndarray] = []
    held = 0

    def flush() -> pa.RecordBatch:
        vocabulary, numbers, uses = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
        # small numbers for frequent words
        order = np.argsort(-uses, kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order))
        return batch_rows(BLOCKS, [(task << 32 | count, _ids(ids), pack(np.concatenate(sizes)), pack(np.concatenate(train)), pack(vocabulary[order]),
                                    pack(rank[numbers]), len(numbers))])

    for batch, hashes, first in text_rows(batches):
        n = np.diff(first)
        whole = np.full(len(hashes) + len(n), END)
        # neither START nor END is ever a word
        whole[np.arange(len(hashes)) + np.repeat(np.arange(len(n)), n)] = np.where(hashes <= END, hashes + np.uint64(3), hashes)
        ids += batch.column(0).to_pylist()
        train.append(np.array(batch.column(1).to_pylist(), bool))
        sizes.append(n + 1)
        tokens.append(whole)
        held += len(whole)
        if held >= BLOCK_TOKENS:
            yield flush()
            ids, train, sizes, tokens, held = [], [], [], [], 0
            count += 1
    if held:
        yield flush()


@dataclass
class Block:
    """A block's distinct words and word pairs. Number ``len(words)`` stands for START as a context."""

    row: dict

    def __post_init__(self):
        words = unpack(self.row["vocabulary"], np.uint64)
        order = np.argsort(words)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.words, self.tokens = words[order], place[unpack(self.row["tokens"], np.uint32)]
        self.sizes = unpack(self.row["sizes"], np.int64)
        train = unpack(self.row["train"], bool)
        self.in_train = np.repeat(train, self.sizes)
        first = np.cumsum(self.sizes) - self.sizes
        self.first = first
        context = np.empty_like(self.tokens)
        context[1:] = self.tokens[:-1]
        context[first] = len(self.words)
        wide = len(self.words)
        pairs, self.pair_of = np.unique(context * wide + self.tokens, return_inverse=True)
        self.context, self.word = pairs // wide, pairs % wide
        hashes = mixed(self.contexts[self.context] * ROLL + self.words[self.word]) & PAIR_BITS
        self.order = np.argsort(hashes)
        self.pairs = hashes[self.order]

    @property
    def contexts(self) -> np.ndarray:
        return np.append(self.words, START)

    def asks(self) -> list[tuple[int, np.ndarray, np.ndarray]]:
        singles = np.bincount(self.tokens[self.in_train], minlength=len(self.words))
        doubles = np.bincount(self.pair_of[self.in_train], minlength=len(self.pairs))[self.order]
        return [(1, self.words, singles), (2, self.pairs, doubles)]


def batch_rows(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "binary": pa.binary(), "int": pa.int32(), "bigint": pa.int64(), "array<bigint>": pa.list_(pa.int64())}
    fields = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(fields)], [n for n, _ in fields])


def asking(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for level, keys, counts in Block(row).asks():
                    cuts = bucket_cuts(keys, buckets)
                    yield batch_rows(ASKED, [
                        (level, b, row["block"], pack_keys(keys[i:j]), pack(counts[i:j].astype(np.uint32)))
                        for b, (i, j) in enumerate(zip(cuts[:-1], cuts[1:])) if i < j])
    return run


def counted(key: tuple, asked: pa.Table) -> pa.Table:
    """Training counts of a bucket's n-grams over all blocks: the table's part, its statistics, and each block's answer.

    Of the blocks that saw an n-gram in training, the first one owns it: it adds it up for its context.
    """
    level, bucket = key[0].as_py(), key[1].as_py()
    rows = sorted(asked.to_pylist(), key=lambda r: r["block"])
    keys = [unpack_keys(r["keys"]) for r in rows]
    counts = np.concatenate([unpack(r["counts"], np.uint32) for r in rows]).astype(np.int64)
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(at, counts, len(distinct)).astype(np.int64)
    seen = np.flatnonzero(counts)
    owner = np.zeros(len(counts), bool)
    owner[seen[np.unique(at[seen], return_index=True)[1]]] = True
    answer = total[at].astype(np.uint64)
    ends = np.cumsum([len(k) for k in keys])
    known = total > 0
    stats = [int((total == r).sum()) for r in range(1, LAST_DISCOUNTED + 2)] + [int(total.sum()), int(known.sum())]
    out = [("table", level, bucket, None, pack_keys(distinct[known]), pack(total[known]), None, stats)]
    out += [("answer", level, bucket, r["block"], None, pack(answer[e - len(k):e]), pack(owner[e - len(k):e]), None) for r, k, e in zip(rows, keys, ends)]
    return pa.Table.from_batches([batch_rows(ANSWERED, out)])


def discounts(of_counts: list[int]) -> np.ndarray:
    """Factor d(r) for counts 0..LAST_DISCOUNTED+1 (the last one for all above), from how many n-grams occur r times."""
    k, n = LAST_DISCOUNTED, [0, *of_counts]
    d = np.full(k + 2, 1 - RESERVE)
    d[0] = 0
    beyond = (k + 1) * n[k + 1] / n[1] if n[1] else 1.0
    for r in range(1, k + 1):
        if n[r] and n[r + 1] and beyond < 1:
            found = ((r + 1) * n[r + 1] / (r * n[r]) - beyond) / (1 - beyond)
            if 0 < found < 1 - RESERVE:
                d[r] = found
    return d


@dataclass
class Model:
    """What every block needs of the whole corpus: a few numbers per n-gram length."""

    tokens: int
    types: int
    unknown: float
    d1: np.ndarray
    d2: np.ndarray

    def single(self, c: np.ndarray) -> np.ndarray:
        p = self.d1[np.minimum(c, LAST_DISCOUNTED + 1)] * c / max(self.tokens, 1)
        return np.where(c > 0, p, self.unknown)


def model_of(stats: dict[int, list[int]]) -> Model:
    one, two = stats.get(1, [0] * (LAST_DISCOUNTED + 3)), stats.get(2, [0] * (LAST_DISCOUNTED + 3))
    n_r, tokens, types = one[:-2], one[-2], one[-1]
    d1 = discounts(n_r)
    low = sum(r * n for r, n in enumerate(n_r[:LAST_DISCOUNTED], 1))
    kept = sum(d1[r] * r * n for r, n in enumerate(n_r[:LAST_DISCOUNTED], 1)) + d1[-1] * (tokens - low)
    return Model(tokens, types, 1 - kept / tokens if tokens else 1.0, d1, discounts(two[:-2]))


class Resolved:
    """A block with the corpus's counts of its words and pairs."""

    def __init__(self, model: Model, row: dict, answers: list[dict]):
        self.block = block = Block(row)
        answers = sorted(answers, key=lambda r: (r["level"], r["bucket"]))
        self.one = np.concatenate([unpack(r["counts"], np.uint64) for r in answers if r["level"] == 1]).astype(np.int64)
        self.two, self.owner = np.empty(len(block.pairs), np.int64), np.empty(len(block.pairs), bool)
        self.two[block.order] = np.concatenate([unpack(r["counts"], np.uint64) for r in answers if r["level"] == 2])
        self.owner[block.order] = np.concatenate([unpack(r["owner"], bool) for r in answers if r["level"] == 2])
        # a text starts as often as it ends
        self.of_context = np.append(self.one, self.one[np.searchsorted(block.words, END)])
        self.single = model.single(self.one)

    def contexts(self) -> tuple[np.ndarray, np.ndarray]:
        """The block's contexts that were seen in training, ascending: their keys and their numbers."""
        keys = self.block.contexts
        order = np.argsort(keys)
        order = order[self.of_context[order] > 0]
        return keys[order], order


def context_asks(model: Model, buckets: int):
    """What the pairs that a block owns add to their contexts: uses by count, and probability in the shorter model."""
    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        known = Resolved(model, row, right.to_pylist())
        keys, order = known.contexts()
        own = known.owner & (known.two > 0)
        context, two = known.block.context[own], known.two[own]
        size, top = len(known.of_context), LAST_DISCOUNTED + 1
        uses = np.bincount(context * (top + 1) + np.minimum(two, top), np.where(two < top, 1, two), size * (top + 1)).reshape(size, top + 1)[:, 1:]
        lower = np.bincount(context, known.single[known.block.word[own]], size)
        counts = np.concatenate([known.of_context[:, None], uses.astype(np.int64)], 1)[order]
        cuts = bucket_cuts(keys, buckets)
        return pa.Table.from_batches([batch_rows(CONTEXTS, [
            (b, row["block"], pack_keys(keys[i:j]), pack(counts[i:j].ravel(order="F")), pack(lower[order[i:j]]))
            for b, (i, j) in enumerate(zip(cuts[:-1], cuts[1:])) if i < j])])
    return run


def weighing(model: Model):
    """Backoff weights of a bucket's contexts, and each block's answer."""
    def run(key: tuple, asked: pa.Table) -> pa.Table:
        rows = sorted(asked.to_pylist(), key=lambda r: r["block"])
        keys = [unpack_keys(r["keys"]) for r in rows]
        counts = np.concatenate([unpack(r["counts"], np.int64).reshape(LAST_DISCOUNTED + 2, -1) for r in rows], 1)
        distinct, first, at = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        r = np.append(np.arange(1, LAST_DISCOUNTED + 1), 1)
        kept = np.bincount(at, (model.d2[1:] * r) @ counts[1:], len(distinct))
        lower = np.bincount(at, np.concatenate([unpack(r["lower"], np.float64) for r in rows]), len(distinct))
        weight = np.log10(np.maximum(1 - kept / counts[0, first], 1e-12) / np.maximum(1 - lower, 1e-12))
        ends = np.cumsum([len(k) for k in keys])
        out = [("table", key[0].as_py(), None, pack_keys(distinct), pack(weight))]
        out += [("answer", key[0].as_py(), r["block"], None, pack(weight[at[e - len(k):e]])) for r, k, e in zip(rows, keys, ends)]
        return pa.Table.from_batches([batch_rows(WEIGHTS, out)])
    return run


def scoring(model: Model, id_kind: pa.DataType):
    """Every token of a block from the longest n-gram that was seen, with backoff weights on the way down."""
    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        row, answers = left.to_pylist()[0], right.to_pylist()
        known = Resolved(model, row, [r for r in answers if r["weights"] is None])
        block = known.block
        weight = np.zeros(len(known.of_context))
        weight[known.contexts()[1]] = np.concatenate([np.zeros(0), *[unpack(r["weights"], np.float64) for r in sorted(
            (r for r in answers if r["weights"] is not None), key=lambda r: r["bucket"])]])
        kept = model.d2[np.minimum(known.two, LAST_DISCOUNTED + 1)] * known.two
        with np.errstate(divide="ignore", invalid="ignore"):
            pair_log = np.where(known.two > 0, np.log10(kept / known.of_context[block.context]),
                                weight[block.context] + np.log10(known.single[block.word]))
        base_log = np.log10((known.one + 1) / (model.tokens + model.types + 1))
        backs = (known.two == 0) & (known.of_context[block.context] > 0)
        token, base, n_known, back = (np.add.reduceat(x, block.first) for x in (
            pair_log[block.pair_of], base_log[block.tokens], (known.one > 0)[block.tokens].astype(np.int64), backs[block.pair_of].astype(np.int64)))
        return pa.table({
            "doc_id": pa.array(_unids(row["ids"]), id_kind), "held_out": ~unpack(row["train"], bool), "n_tokens": block.sizes, "n_known": n_known,
            "train_tokens": np.full(len(block.sizes), model.tokens, np.int64), "base_score": base, "score": token, "n_backoffs": back,
        })
    return run


def scored(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_backoffs) per row of ``docs``.

    Learns from rows whose crc32(doc_id as text) modulo 7 is not 2; scores all. Null texts count as empty: their only
    token is the end. Words are compared by 64-bit hashes. Texts are read whole; repeated rows count and are scored
    each; an empty table gives no rows; further columns are ignored. Where nothing can be learned, every token is
    unknown with probability 1 and base score 0.

    The tables (n-gram counts by length and bucket, backoff weights by bucket) stay in the shared folder, as packed
    ascending keys and values; ``tables`` reads them.
    """
    return fit_and_score(docs)[0]


def fit_and_score(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """The scores, and the paths of the count and weight tables.

    Blocks are stored in buckets, so that only asks and answers are shuffled, to the blocks' places.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType
    marked = docs.select("doc_id", (remainder(F.col("doc_id"), 7) != 2).alias("train"), "text")
    cut = bucketed(marked.mapInArrow(blocks, BLOCKS), "katz_blocks", "block")
    total = cut.agg(F.sum("n_tokens")).first()[0] or 0
    buckets = max(16, -(-total // BUCKET_TOKENS))

    asked = cut.mapInArrow(asking(buckets), ASKED)
    counts = shared_write(asked.groupBy("level", "bucket").applyInArrow(counted, ANSWERED), "katz_counts", "kind")
    read = spark.read.schema(ANSWERED).parquet(counts)
    sums = read.filter("kind = 'table'").groupBy("level").agg(
        F.array(*[F.sum(F.col("stats")[i]) for i in range(LAST_DISCOUNTED + 3)])).collect()
    model = model_of({r[0]: list(r[1]) for r in sums})

    answers = read.filter("kind = 'answer'").select("block", "level", "bucket", "counts", "owner")
    asked = cut.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(context_asks(model, buckets), CONTEXTS)
    weights = shared_write(asked.groupBy("bucket").applyInArrow(weighing(model), WEIGHTS), "katz_weights", "kind")
    told = answers.unionByName(spark.read.schema(WEIGHTS).parquet(weights).filter("kind = 'answer'").select("block", "bucket", "weights"),
                               allowMissingColumns=True)
    out = cut.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
        scoring(model, to_arrow_type(kind)), f"doc_id {kind.simpleString()}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
                                             "base_score double, score double, n_backoffs bigint")
    return out, counts, weights


def tables(spark, counts: str, weights: str) -> tuple[dict[int, dict[int, int]], dict[int, float]]:
    """The model as dictionaries by hash, for looking into small models: ({length: {n-gram: count}}, {context: log10 weight})."""
    grams: dict[int, dict[int, int]] = {1: {}, 2: {}}
    for r in spark.read.schema(ANSWERED).parquet(counts).filter("kind = 'table'").collect():
        grams[r["level"]].update(zip(unpack_keys(r["keys"]).tolist(), unpack(r["counts"], np.int64).tolist()))
    back: dict[int, float] = {}
    for r in spark.read.schema(WEIGHTS).parquet(weights).filter("kind = 'table'").collect():
        back.update(zip(unpack_keys(r["keys"]).tolist(), unpack(r["weights"], np.float64).tolist()))
    return grams, back


def query(spark, sf_dir: str) -> DataFrame:
    return scored(read_table(spark, sf_dir, "documents"))
