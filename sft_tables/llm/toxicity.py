"""Toxicity: a bidirectional gated recurrent network with attention pooling over character and word inputs, in numpy.

A word enters as its own embedding and the mean embedding of its character trigrams. Texts are read in overlapping
windows of words; every window is scored, and a text's score comes from its highest window.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sft_tables.llm.common import give_back, read_table, remainder, sample_ids, slices

WINDOW, STRIDE = 32, 24
WORD_DIM, CHAR_DIM, HIDDEN, ATTEND = 8, 16, 12, 8
TRIGRAMS = 8192
#: Bounds of the fit (scoring has none): documents per label, words with an embedding of their own.
DOCS_PER_LABEL, VOCABULARY = 1000, 4000
EPOCHS, BATCH, RATE = 8, 256, 0.01
#: Clean windows taught in an epoch, about, where a small sample has so many; a toxic text's windows in the first epoch;
#: letters of a word's beginning.
CLEAN_WINDOWS, FIRST_WINDOWS, BEGINNING = 6000, 8, 5
CACHED = 250_000
THRESHOLD = 0.3
EDGES = ".,;:!?\"'()[]{}<>*_-|"


def tokens(text: str | None) -> list[str]:
    """Lower-cased words without punctuation at their edges; a word of punctuation only stays as it is."""
    return [w.strip(EDGES) or w for w in (text or "").lower().split()]


def trigrams(word: str) -> list[int]:
    padded = f"^{word}$"
    return [zlib.crc32(padded[i:i + 3].encode()) % TRIGRAMS for i in range(max(1, len(padded) - 2))]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def window_starts(n: int) -> np.ndarray:
    """First words of a text's windows: every STRIDE words, the last one ending with the text."""
    if n <= WINDOW:
        return np.zeros(1, np.int64)
    return np.append(np.arange(0, n - WINDOW, STRIDE), n - WINDOW)


class Network:
    """Parameters, the forward pass over windows, and its gradient. Word 0 is 'no such word'."""

    def __init__(self, words: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.words = {w: i + 1 for i, w in enumerate(words)}
        dim = WORD_DIM + CHAR_DIM

        def draw(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        self.p = {"word": draw(len(words) + 1, WORD_DIM, scale=0.1), "char": draw(TRIGRAMS, CHAR_DIM, scale=0.3)}
        self.p["word"][0] = 0
        for side in "fb":
            self.p |= {f"{side}x": draw(dim, 3 * HIDDEN, scale=dim**-0.5), f"{side}h": draw(HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5),
                       f"{side}0": np.zeros(3 * HIDDEN, np.float32)}
        self.p |= {"a": draw(2 * HIDDEN, ATTEND, scale=0.3), "a0": np.zeros(ATTEND, np.float32), "v": draw(ATTEND, scale=0.5),
                   "w": draw(2 * HIDDEN, scale=0.3), "w0": np.zeros(1, np.float32)}
        self.slope, self.shift = 1.0, 0.0
        self.constant: float | None = None

    def embed(self, words: list[str]) -> tuple[np.ndarray, tuple]:
        """Inputs of distinct words, and what their gradient needs."""
        own = np.fromiter((self.words.get(w, 0) for w in words), np.int64, len(words))
        grams = [trigrams(w) for w in words]
        sizes = np.fromiter(map(len, grams), np.int64, len(words))
        flat = np.fromiter((g for gs in grams for g in gs), np.int64, int(sizes.sum()))
        starts = np.cumsum(sizes) - sizes
        chars = np.add.reduceat(self.p["char"][flat], starts) / sizes[:, None].astype(np.float32) if len(words) else np.zeros((0, CHAR_DIM), np.float32)
        return np.concatenate([self.p["word"][own], chars], 1), (own, flat, sizes)

    def states(self, side: str, gx: np.ndarray, mask: np.ndarray | None, keep: list | None = None) -> np.ndarray:
        """Hidden states (time, window, HIDDEN) in reading order of that side; gx: input parts of the gates."""
        u, steps = self.p[f"{side}h"], range(gx.shape[0])
        h = np.zeros((gx.shape[1], HIDDEN), np.float32)
        out = np.empty((gx.shape[0], gx.shape[1], HIDDEN), np.float32)
        for t in (steps if side == "f" else reversed(steps)):
            gh = h @ u
            zr = sigmoid(gx[t, :, :2 * HIDDEN] + gh[:, :2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            n = np.tanh(gx[t, :, 2 * HIDDEN:] + r * gh[:, 2 * HIDDEN:])
            new = n + z * (h - n)
            if mask is not None:
                new = np.where(mask[t][:, None], new, h)
            if keep is not None:
                keep.append((t, h, z, r, n, gh[:, 2 * HIDDEN:]))
            h = out[t] = new
        return out

    def pooled(self, both: np.ndarray, mask: np.ndarray | None) -> tuple[np.ndarray, tuple]:
        """Logits of the windows by attention over their states."""
        t = np.tanh(both @ self.p["a"] + self.p["a0"])
        s = t @ self.p["v"]
        if mask is not None:
            s = np.where(mask, s, -1e9)
        e = np.exp(s - s.max(0))
        attention = e / e.sum(0)
        c = np.einsum("tb,tbh->bh", attention, both)
        return c @ self.p["w"] + self.p["w0"][0], (t, attention, c)

    def gates(self, side: str, inputs: np.ndarray) -> np.ndarray:
        return inputs @ self.p[f"{side}x"] + self.p[f"{side}0"]

    def logits(self, gates: tuple[np.ndarray, np.ndarray], at: np.ndarray, mask: np.ndarray | None = None) -> np.ndarray:
        """Scores of windows; gates: rows per word of either side, at: (time, window) row numbers."""
        both = np.concatenate([self.states(s, g[at], mask) for s, g in zip("fb", gates)], 2)
        return self.pooled(both, mask)[0]

    def gradient(self, words: list[str], at: np.ndarray, mask: np.ndarray, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean log loss of the windows and its gradient."""
        p, g = self.p, {}
        inputs, (own, flat, sizes) = self.embed(words)
        x = inputs[at]
        kept: dict[str, list] = {"f": [], "b": []}
        both = np.concatenate([self.states(s, self.gates(s, inputs)[at], mask, kept[s]) for s in "fb"], 2)
        logit, (t, attention, c) = self.pooled(both, mask)
        prob = sigmoid(logit)
        loss = float(np.mean(np.logaddexp(0, logit) - label * logit))
        d = ((prob - label) / len(label)).astype(np.float32)
        g["w"], g["w0"] = c.T @ d, d.sum(keepdims=True)
        dc = d[:, None] * p["w"]
        dboth = attention[:, :, None] * dc[None]
        da = np.einsum("bh,tbh->tb", dc, both)
        ds = attention * (da - (attention * da).sum(0))
        g["v"] = np.einsum("tb,tbk->k", ds, t)
        dt = ds[:, :, None] * p["v"] * (1 - t * t)
        g["a"], g["a0"] = np.einsum("tbh,tbk->hk", both, dt), dt.sum((0, 1))
        dboth = dboth + dt @ p["a"].T
        dx = np.zeros_like(x)
        for side, part in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, None))):
            u, wx = p[f"{side}h"], p[f"{side}x"]
            gu, gw, g0 = np.zeros_like(u), np.zeros_like(wx), np.zeros(3 * HIDDEN, np.float32)
            back = np.zeros((at.shape[1], HIDDEN), np.float32)
            for step, h, z, r, n, ghn in reversed(kept[side]):
                m = mask[step][:, None]
                total = back + dboth[step, :, part]
                dh = total * m
                dz = dh * (h - n) * z * (1 - z)
                dn = dh * (1 - z) * (1 - n * n)
                dr = dn * ghn * r * (1 - r)
                dgh = np.concatenate([dz, dr, dn * r], 1)
                dgx = np.concatenate([dz, dr, dn], 1)
                back = dh * z + dgh @ u.T + total * ~m
                gu += h.T @ dgh
                gw += x[step].T @ dgx
                g0 += dgx.sum(0)
                dx[step] += dgx @ wx.T
            g[f"{side}h"], g[f"{side}x"], g[f"{side}0"] = gu, gw, g0
        dinputs = np.zeros_like(inputs)
        np.add.at(dinputs, at.ravel(), dx.reshape(-1, dx.shape[2]))
        g["word"], g["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
        np.add.at(g["word"], own, dinputs[:, :WORD_DIM])
        g["word"][0] = 0
        np.add.at(g["char"], flat, np.repeat(dinputs[:, WORD_DIM:] / sizes[:, None].astype(np.float32), sizes, 0))
        return loss, g


def windows_of(texts: list[np.ndarray], pad: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(time, window) word rows, which of them are words, and each window's text; an empty text has one empty window."""
    starts = [window_starts(len(t)) for t in texts]
    owner = np.repeat(np.arange(len(texts)), [len(s) for s in starts])
    flat = np.concatenate([*texts, np.full(WINDOW, pad)]).astype(np.int64)
    sizes = np.array([len(t) for t in texts], np.int64)
    base = np.cumsum(sizes) - sizes
    inside = np.concatenate(starts)[None] + np.arange(WINDOW)[:, None]
    real = inside < sizes[owner]
    return np.where(real, flat[np.where(real, base[owner] + inside, 0)], pad), real, owner


def fitted(texts: list[str], labels: np.ndarray, share: float, seed: int = 7) -> Network:
    """Train on labelled texts; ``share``: how many of all labelled texts are toxic (the sample is balanced).

    The label is the text's, so of a toxic text only its highest windows are taught (in the first epoch more of them),
    and of a clean text its highest and a few more. The first epoch's order comes from how much more often words and
    their beginnings occur in toxic texts.
    """
    split = [tokens(t) for t in texts]
    seen = Counter(w for words in split for w in set(words))
    net = Network([w for w, n in sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:VOCABULARY] if n >= 3], seed)
    if not 0 < labels.sum() < len(labels):
        net.constant = float(labels.mean()) if len(labels) else 0.5
        return net
    vocabulary = [*seen, ""]
    number = {w: i for i, w in enumerate(vocabulary)}
    at, real, owner = windows_of([np.array([number[w] for w in words], np.int64) for words in split], len(vocabulary) - 1)
    rng = np.random.default_rng(seed)
    scores = first_scores(split, labels, number)[at].max(0)
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    s = {k: np.zeros_like(v) for k, v in net.p.items()}
    step = 0

    def every() -> np.ndarray:
        inputs = net.embed(vocabulary)[0]
        gates = net.gates("f", inputs), net.gates("b", inputs)
        return np.concatenate([net.logits(gates, at[:, i:i + 8192], real[:, i:i + 8192]) for i in range(0, at.shape[1], 8192)])

    for epoch in range(EPOCHS):
        order = np.lexsort((-scores, owner))
        first = np.concatenate([[0], np.flatnonzero(np.diff(owner[order])) + 1])
        rank = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
        size = np.repeat(np.diff(np.append(first, len(order))), np.diff(np.append(first, len(order))))
        toxic = labels[owner[order]] == 1
        most = np.where(toxic, FIRST_WINDOWS if epoch == 0 else np.maximum(1, size // 10), 4)
        chosen = order[(rank < most) | (~toxic & (rng.random(len(order)) < max(0.05, CLEAN_WINDOWS / len(order))))]
        rng.shuffle(chosen)
        for i in range(0, len(chosen), BATCH):
            part = chosen[i:i + BATCH]
            rows, back = np.unique(at[:, part], return_inverse=True)
            _, g = net.gradient([vocabulary[r] for r in rows], back.reshape(WINDOW, -1), real[:, part], labels[owner[part]].astype(np.float32))
            step += 1
            rate = RATE * min(1.0, 2 * (1 - (epoch + i / len(chosen)) / EPOCHS))
            for k, v in net.p.items():
                m[k] += 0.1 * (g[k] - m[k])
                s[k] += 0.01 * (g[k] * g[k] - s[k])
                v -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.99**step)) + 1e-7)
        scores = every()
    highest = np.full(len(texts), -np.inf)
    np.maximum.at(highest, owner, scores)
    net.slope, net.shift = scaled(highest, labels, share)
    return net


def first_scores(split: list[list[str]], labels: np.ndarray, number: dict[str, int]) -> np.ndarray:
    """Per word: the larger log odds of a toxic text, of the word and of its first letters."""
    found: dict[str, np.ndarray] = {}
    for words, label in zip(split, labels.astype(int).tolist()):
        for part in {w for word in set(words) for w in (word, f"^{word[:BEGINNING]}")}:
            found.setdefault(part, np.zeros(2))[label] += 1
    toxic, clean = labels.sum(), len(labels) - labels.sum()
    odds = {part: np.log((n[1] + 0.5) / (toxic + 1)) - np.log((n[0] + 0.5) / (clean + 1)) for part, n in found.items()}
    out = np.full(len(number), -np.inf)
    for word, i in number.items():
        out[i] = max(odds.get(word, -10.0), odds.get(f"^{word[:BEGINNING]}", -10.0))
    return out


def scaled(x: np.ndarray, labels: np.ndarray, share: float) -> tuple[float, float]:
    """Slope and shift that turn a text's highest window into a probability, with classes weighted as in the corpus."""
    weight = np.where(labels == 1, share / labels.mean(), (1 - share) / (1 - labels.mean()))
    centre, width = x.mean(), x.std() + 1e-6
    u = (x - centre) / width
    a, b = 1.0, 0.0
    for _ in range(50):
        p = sigmoid(a * u + b)
        d, h = weight * (p - labels), weight * np.maximum(p * (1 - p), 1e-6)
        hess = np.array([[np.sum(h * u * u) + 0.1, np.sum(h * u)], [np.sum(h * u), np.sum(h) + 1e-3]])
        move = np.linalg.solve(hess, [np.sum(d * u) + 0.1 * (a - 1), np.sum(d)])
        a, b = a - np.clip(move[0], -1, 1), b - np.clip(move[1], -1, 1)
    return float(a / width), float(b - a * centre / width)


class Scorer:
    """The network as a task uses it: gate inputs of words seen are kept."""

    def __init__(self, net: Network):
        self.net = net
        self.rows: dict[str, int] = {}
        self.gates: tuple[np.ndarray, np.ndarray] | None = None

    def __getstate__(self):
        return self.net

    def __setstate__(self, net):
        self.__init__(net)

    def forget(self) -> None:
        """Drop what is kept, at the end of a task: workers go on to other operators' tasks."""
        self.rows, self.gates = {}, None
        give_back()

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Probability that a text is toxic, from the highest of all its windows."""
        net = self.net
        if net.constant is not None:
            return np.full(len(texts), net.constant)
        split = [tokens(t) for t in texts]
        new = list({w for words in split for w in words if w not in self.rows})
        if self.gates is None or len(self.rows) + len(new) > CACHED:
            self.rows.clear()
            new = ["", *{w for words in split for w in words if w}]
        if new:
            made = []
            for i in range(0, len(new), 20_000):
                inputs = net.embed(new[i:i + 20_000])[0]
                made.append((net.gates("f", inputs), net.gates("b", inputs)))
            old = [self.gates] if self.rows else []
            self.gates = tuple(np.concatenate([x[k] for x in old + made]) for k in (0, 1))
            self.rows.update(zip(new, range(len(self.rows), len(self.rows) + len(new))))
        numbers = [np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words)) for words in split]
        highest = np.full(len(texts), -np.inf)
        for some in (np.flatnonzero([len(n) >= WINDOW for n in numbers]), np.flatnonzero([len(n) < WINDOW for n in numbers])):
            if not len(some):
                continue
            at, real, owner = windows_of([numbers[i] for i in some], self.rows[""])
            mask = None if real.all() else real
            for i in range(0, at.shape[1], 4096):
                found = net.logits(self.gates, at[:, i:i + 4096], None if mask is None else mask[:, i:i + 4096])
                np.maximum.at(highest, some[owner[i:i + 4096]], found)
        return sigmoid(net.slope * highest + net.shift).astype(np.float64)


def train(docs: DataFrame, labels: DataFrame, per_label: int = DOCS_PER_LABEL) -> Network:
    """Fit on at most ``per_label`` documents of either label, the ones whose ids' MD5 come first.

    Held-out ids (crc32 modulo 4 is 2) and null labels are never used; a document with several labels is toxic if one
    says so. Only chosen texts are fetched; without both labels the network is constant: their mean, or 0.5.
    """
    marks = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (remainder(F.col("doc_id"), 4) != 2)).groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"))
    ids = sample_ids(marks, "toxic", per_label)
    totals = dict(marks.groupBy("toxic").count().collect())
    chosen = docs.sparkSession.createDataFrame(ids, marks.schema)
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic", "doc_id").collect()
    found.sort(key=lambda r: (r[2], r[0] or ""))
    share = totals.get(1, 0) / max(1, sum(totals.values()))
    return fitted([r[0] or "" for r in found], np.array([r[1] for r in found], np.float64), min(max(share, 0.01), 0.99))


def scored(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, per_label: int = DOCS_PER_LABEL) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs``; only the text enters a score.

    A null or empty text has one empty window and so a score too. All windows of whole texts are scored, of any
    length; repeated rows give repeated results; an empty table gives none; further columns are ignored. One pass over
    the texts, no shuffle.
    """
    scorer = docs.sparkSession.sparkContext.broadcast(Scorer(train(docs, labels, per_label)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            scores = scorer.value.score(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])
        scorer.value.forget()

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def query(spark, sf_dir: str) -> DataFrame:
    return scored(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
