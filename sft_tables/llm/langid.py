"""Language identification by unigram models over a fixed public vocabulary, summed over all segmentations.

Each language has one probability per vocabulary piece. A word's probability is the sum over all its segmentations
into pieces, found by a forward pass over the word's lattice; a text's is the product over its words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sft_tables.llm.common import give_back, read_table, remainder, sample_ids, slices

SPACE, GAP = "▁", "\n"
#: At most so many documents of each language are learned from (a documented bound of the fit; scoring has none).
DOCS_PER_LANGUAGE = 200
ROUNDS = 4
SMOOTHING = 0.02
#: Probability of one character that has no piece, and so of any text in any language.
UNKNOWN = 1e-9
CACHED = 600_000
#: Characters, the most frequent among the pieces, whose steps in the trie are one table look-up.
FREQUENT = 96
CHUNK = 20_000
UNDECIDED = "und"


class Trie:
    """The pieces as a tree of characters, walked from all positions of a text at once."""

    def __init__(self, pieces: list[str]):
        uses = Counter("".join(pieces))
        self.classes = np.zeros(0x110000, np.int32)
        for i, (c, _) in enumerate(sorted(uses.items(), key=lambda x: (-x[1], x[0])), 1):
            self.classes[ord(c)] = i
        self.width = len(uses) + 1
        nodes = {"": 0}
        steps: dict[int, int] = {}
        for piece in pieces:
            for n in range(1, len(piece) + 1):
                if piece[:n] not in nodes:
                    nodes[piece[:n]] = len(nodes)
                    steps[nodes[piece[:n - 1]] * self.width + int(self.classes[ord(piece[n - 1])])] = nodes[piece[:n]]
        self.piece = np.full(len(nodes), -1)
        self.piece[[nodes[p] for p in pieces]] = np.arange(len(pieces))
        self.keys = np.array(sorted(steps), np.int64)
        self.targets = np.array([steps[k] for k in self.keys.tolist()], np.int32)
        self.near = np.zeros((len(nodes), FREQUENT), np.int32)
        parent, c = self.keys // self.width, self.keys % self.width
        self.near[parent[c < FREQUENT], c[c < FREQUENT]] = self.targets[c < FREQUENT]

    def step(self, node: np.ndarray, c: np.ndarray) -> np.ndarray:
        """The node below by a character; 0 where there is none."""
        out = self.near[node, np.minimum(c, FREQUENT - 1)]
        rare = np.flatnonzero(c >= FREQUENT - 1)
        if len(rare) and len(self.keys):
            key = node[rare] * np.int64(self.width) + c[rare]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            out[rare] = np.where(self.keys[at] == key, self.targets[at], 0)
        return out

    def matches(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, piece) of every piece at every place."""
        c = self.classes[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        c = np.append(c, np.int32(0))
        at = np.arange(len(text))
        node, length = np.zeros(len(text), np.int32), 0
        found = []
        while len(at):
            node = self.step(node, c[at + length])
            length += 1
            alive = node > 0
            at, node = at[alive], node[alive]
            ends = self.piece[node] >= 0
            found.append((at[ends], at[ends] + length, self.piece[node[ends]]))
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3


class Lattice:
    """All ways to cut words into pieces: edges between character positions, ordered by where they end in the word."""

    def __init__(self, words: list[str], trie: Trie, lengths: np.ndarray):
        joined = GAP.join(words) + GAP
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        self.first = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        self.last = self.first + sizes
        self.nodes = len(joined)
        start, end, piece = trie.matches(joined)
        single = np.zeros(self.nodes, bool)
        single[start[lengths[piece] == 1]] = True
        single[self.last] = True
        bare = np.flatnonzero(~single)
        end = np.concatenate([end, bare + 1])
        self.piece = np.concatenate([piece, np.full(len(bare), len(lengths) - 1)])
        start = np.concatenate([start, bare])
        self.word = np.searchsorted(self.first, start, "right") - 1
        order = np.lexsort((end, end - self.first[self.word]))
        self.start, self.end, self.piece, self.word = start[order], end[order], self.piece[order], self.word[order]

    def _summed(self, values: np.ndarray, into: np.ndarray, at: np.ndarray) -> None:
        """into[at] = log of the sum of exp(values) over equal neighbours of ``at``."""
        new = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        top = np.maximum.reduceat(values, new)
        part = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(at))))
        into[at[new]] = top + np.log(np.add.reduceat(np.exp(values - top[part]), new))

    def forward(self, log_p: np.ndarray) -> np.ndarray:
        """Log of the summed probability of everything up to each position; log_p: pieces x languages."""
        total = np.full((self.nodes, log_p.shape[1]), -np.inf)
        total[self.first] = 0.0
        depth = self.end - self.first[self.word]
        cuts = np.flatnonzero(np.concatenate([[True], depth[1:] != depth[:-1], [True]])) if len(depth) else []
        for a, b in zip(cuts[:-1], cuts[1:]):
            self._summed(total[self.start[a:b]] + log_p[self.piece[a:b]], total, self.end[a:b])
        return total

    def expected(self, log_p: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece in ``counts`` (words x languages) occurrences of the words."""
        ahead = self.forward(log_p)
        behind = np.full_like(ahead, -np.inf)
        behind[self.last] = 0.0
        order = np.lexsort((self.start, self.first[self.word] - self.start))
        start, end, piece = self.start[order], self.end[order], self.piece[order]
        depth = (start - self.first[self.word[order]])
        cuts = np.flatnonzero(np.concatenate([[True], depth[1:] != depth[:-1], [True]])) if len(depth) else []
        for a, b in zip(cuts[:-1], cuts[1:]):
            self._summed(behind[end[a:b]] + log_p[piece[a:b]], behind, start[a:b])
        use = np.exp(ahead[self.start] + log_p[self.piece] + behind[self.end] - ahead[self.last[self.word]]) * counts[self.word]
        return np.stack([np.bincount(self.piece, use[:, k], len(log_p)) for k in range(log_p.shape[1])], 1)


class Model:
    """Languages and their piece probabilities; scores of words seen are kept during a task."""

    def __init__(self, pieces: list[str], languages: list[str], log_p: np.ndarray | None = None):
        self.pieces, self.languages, self.log_p = pieces, languages, log_p
        self._ready()

    def _ready(self) -> None:
        self.lengths = np.array([len(p) for p in self.pieces] + [1])
        self.trie = Trie(self.pieces)
        self.rows: dict[str, int] = {}
        self.table = np.zeros((0, len(self.languages)))

    def __getstate__(self):
        return self.pieces, self.languages, self.log_p

    def __setstate__(self, state):
        self.pieces, self.languages, self.log_p = state
        self._ready()

    def fit(self, counts: dict[str, np.ndarray]) -> None:
        """Expectation and maximisation from even probabilities; counts: word -> occurrences per language."""
        words, n = list(counts), len(self.pieces) + 1
        log_p = np.full((n, len(self.languages)), -np.log(n))
        for _ in range(ROUNDS):
            uses = np.full(log_p.shape, SMOOTHING)
            for at in range(0, len(words), CHUNK):
                part = words[at:at + CHUNK]
                uses += Lattice(part, self.trie, self.lengths).expected(log_p, np.array([counts[w] for w in part]))
            log_p = np.log(uses / uses.sum(0))
            log_p[-1] = np.log(UNKNOWN)
        self.log_p = log_p

    def forget(self) -> None:
        """Drop the scores of words, at the end of a task: workers go on to other operators' tasks."""
        self.rows = {}
        self.table = self.table[:0].copy()
        give_back()

    def word_rows(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Row numbers in ``table`` of each text's words."""
        rows = self.rows
        new = list({w for text in texts for w in text if w not in rows})
        if len(rows) + len(new) > CACHED:
            rows.clear()
            self.table = self.table[:0].copy()
            new = list({w for text in texts for w in text})
        scores = [self.table]
        for at in range(0, len(new), CHUNK):
            lattice = Lattice([SPACE + w for w in new[at:at + CHUNK]], self.trie, self.lengths)
            scores.append(lattice.forward(self.log_p)[lattice.last])
        rows.update(zip(new, range(len(rows), len(rows) + len(new))))
        self.table = np.concatenate(scores) if new else self.table
        return [np.fromiter(map(rows.__getitem__, text), np.int64, len(text)) for text in texts]

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        split = [(t or "").lower().split() for t in texts]
        totals = np.zeros((len(texts), len(self.languages)))
        if self.languages:
            for i, at in enumerate(self.word_rows(split)):
                totals[i] = self.table[at].sum(0)
        best = totals.argmax(1) if self.languages else np.zeros(len(texts), int)
        odds = np.exp(totals - totals.max(1, keepdims=True)) if self.languages else np.ones((len(texts), 1))
        sure = 1.0 / odds.sum(1)
        lettered = [bool(self.languages) and any(map(str.isalpha, t or "")) for t in texts]
        return [self.languages[b] if ok else UNDECIDED for b, ok in zip(best, lettered)], np.where(lettered, sure, 0.0)


def vocabulary_pieces(model_path: str) -> list[str]:
    """The plain pieces of the vocabulary file."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(model_path, "rb") as f:
        model.ParseFromString(f.read())
    return [p.piece for p in model.pieces if p.type == 1]


def train(docs: DataFrame, model_path: str, per_language: int = DOCS_PER_LANGUAGE) -> Model:
    """Fit on at most ``per_language`` documents of each language, the ones whose ids' MD5 come first.

    Null texts, null languages and held-out rows (crc32 of the id modulo 4 is 2) are never learned from. The ids are
    chosen without texts; only the chosen texts are fetched.
    """
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), 4) != 2))
    ids = sample_ids(known, "lang", per_language)
    chosen = docs.sparkSession.createDataFrame(sorted({(i,) for i, _ in ids}), docs.select("doc_id").schema)
    texts = known.join(F.broadcast(chosen), "doc_id").select("lang", "text").collect()
    languages = sorted({r[0] for r in texts})
    model = Model(vocabulary_pieces(model_path), languages)
    counts: dict[str, np.ndarray] = {}
    for lang, text in texts:
        at = languages.index(lang)
        for word in text.lower().split():
            word = SPACE + word
            if word not in counts:
                counts[word] = np.zeros(len(languages))
            counts[word][at] += 1
    if languages:
        model.fit(counts)
    return model


def identified(docs: DataFrame, model_path: str, per_language: int = DOCS_PER_LANGUAGE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per row of ``docs``.

    ``score`` is the posterior of the predicted language under even priors. A null text or one without a letter is
    ``und`` with score 0, as is every text where no language could be learned. Ties go to the language first by code
    point. Whole texts are scored, of any length; repeated rows give repeated results; an empty table gives none;
    further columns are ignored. One pass over the texts, no shuffle.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, model_path, per_language))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            languages, scores = model.value.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(languages, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"])
        model.value.forget()

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def accepted(docs: DataFrame, model_path: str, least: float = 0.5, per_language: int = DOCS_PER_LANGUAGE) -> DataFrame:
    """The rows of ``docs``, as given, that have a language: not ``und``, and a posterior of at least ``least``.

    Null and empty texts and those without a letter go, as does everything where no language could be learned; repeated
    rows stay repeated, an empty table gives none, columns of any name are kept. One pass over the texts, no shuffle.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, model_path, per_language))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            languages, scores = model.value.predict(batch.column(batch.schema.get_field_index("text")).to_pylist())
            yield batch.filter(pa.array([a != UNDECIDED and s >= least for a, s in zip(languages, scores)], pa.bool_()))
        model.value.forget()

    return docs.mapInArrow(run, docs.schema)


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return identified(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
