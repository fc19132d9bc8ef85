"""Language ID, toxicity and language-model scoring against definitions, brute force and held-out rows."""

import collections
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest

from sft_tables.llm import katz, langid, toxicity

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PIECES = ["a", "b", "ab", "ba", "aba", "▁", "▁a", "c"]


def cuts(word):
    """All segmentations of a word into pieces; a character without a piece is a piece."""
    if not word:
        yield ()
    for n in range(1, len(word) + 1):
        if word[:n] in PIECES or n == 1 and word[0] not in PIECES:
            for rest in cuts(word[n:]):
                yield (word[:n], *rest)


def test_forward_sums_all_segmentations():
    rng = np.random.default_rng(1)
    p = rng.dirichlet(np.ones(len(PIECES) + 1), 2).T
    model = langid.Model(PIECES, ["x", "y"], np.log(p))
    words = ["".join(w) for n in range(1, 6) for w in itertools.product("abz", repeat=n)] + ["▁abab", "▁", "ca"]
    lattice = langid.Lattice(words, model.trie, model.lengths)
    found = lattice.forward(model.log_p)[lattice.last]
    number = {piece: i for i, piece in enumerate(PIECES)}
    for word, got in zip(words, found):
        want = sum(np.prod([p[number.get(piece, len(PIECES))] for piece in cut], 0) for cut in cuts(word))
        assert got == pytest.approx(np.log(want))
    counts = rng.integers(1, 5, (len(words), 2)).astype(float)
    uses = np.zeros_like(p)
    for word, n in zip(words, counts):
        each = [(cut, np.prod([p[number.get(piece, len(PIECES))] for piece in cut], 0)) for cut in cuts(word)]
        total = sum(q for _, q in each)
        for cut, q in each:
            for piece in cut:
                uses[number.get(piece, len(PIECES))] += n * q / total
    assert lattice.expected(model.log_p, counts) == pytest.approx(uses)


def invented(rng, syllables, n):
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(n))


def test_languages_of_held_out_rows(docs, model_path):
    rng = random.Random(4)
    kinds = {"en": ["th", "ing", "er", "on", "the"], "de": ["sch", "ung", "ei", "ich", "der"], "es": ["ción", "que", "ar", "ñ", "los"]}
    rows = [(i, invented(rng, kinds[lang], 30), lang) for i, lang in enumerate(rng.choices(list(kinds), k=300))]
    hidden = [(i, t, None if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in rows]
    found = {r["doc_id"]: r for r in langid.identified(docs(hidden), model_path).collect()}
    assert all(found[i]["lang_pred"] == lang and found[i]["score"] > 0.9 for i, _, lang in rows)
    assert sum(r["held_out"] for r in found.values()) == sum(zlib.crc32(str(i).encode()) % 4 == 2 for i in range(300))
    # a row's own language and source say nothing
    other = {r["doc_id"]: r for r in langid.identified(docs([(*h, "zz") if h[2] is None else h for h in hidden]), model_path).collect()}
    assert other == found


def test_gradient_of_the_network():
    net = toxicity.Network(["ab", "cd"])
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rng = np.random.default_rng(0)
    words, at = ["ab", "cd", "zzz", "q", ""], rng.integers(0, 5, (6, 3))
    mask = np.arange(6)[:, None] < np.array([6, 4, 3])
    label = np.array([1.0, 0, 1])
    _, g = net.gradient(words, at, mask, label)
    for name, value in net.p.items():
        spots = np.argwhere(np.abs(g[name]) > 1e-5)[:3]
        for spot in map(tuple, spots):
            kept, value[spot] = value[spot], value[spot] + 1e-3
            up = net.gradient(words, at, mask, label)[0]
            value[spot] = kept - 1e-3
            down = net.gradient(words, at, mask, label)[0]
            value[spot] = kept
            assert g[name][spot] == pytest.approx((up - down) / 2e-3, rel=0.03, abs=2e-6), name


def test_windows_cover_every_word():
    for n in (0, 1, 31, 32, 33, 56, 57, 500):
        starts = toxicity.window_starts(n)
        assert {w for s in starts for w in range(s, min(n, s + toxicity.WINDOW))} == set(range(n))
        assert all(b - a <= toxicity.STRIDE for a, b in itertools.pairwise(starts))


def test_toxicity_of_held_out_rows(docs, spark):
    rng = random.Random(6)
    bad = ["scoundrel", "vermin", "rotter"]
    rows, marks = [], []
    for i in range(500):
        words = invented(rng, ["th", "ing", "er", "on", "ly", "re"], rng.randint(1, 150)).split()
        toxic = int(i % 5 == 0)
        for _ in range(3 * toxic):
            words.insert(rng.randint(0, len(words)), rng.choice(bad))
        rows.append((i, " ".join(words)))
        marks.append((i, 1 - toxic, toxic))
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")
    found = [(r["score"], marks[r["doc_id"]][2], r["predicted"]) for r in toxicity.scored(docs(rows), labels).collect() if r["held_out"]]
    pairs = [(a > b) + 0.5 * (a == b) for a, x, _ in found for b, y, _ in found if x > y]
    assert sum(pairs) / len(pairs) > 0.95
    assert all(p == (s >= 0.3) for s, _, p in found)


def test_no_labels_give_a_constant(docs, spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {r["score"] for r in toxicity.scored(docs([(1, "a"), (2, None)]), labels).collect()} == {0.5}


@pytest.fixture
def small(docs):
    rng = random.Random(8)
    words = ["aa", "Bb", "cc", "dd", "ee", "ff"]
    return [(i, " ".join(rng.choices(words + [f"w{rng.randint(0, 60)}"], k=rng.randint(0, 25)))) for i in range(150)] + [(200, None)]


def tokens_of(rows):
    return {i: re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(ASCII)) + ["</s>"] for i, t in rows}


def test_katz_scores(docs, small):
    text = tokens_of(small)
    train = [i for i in text if zlib.crc32(str(i).encode()) % 7 != 2]
    one = collections.Counter(w for i in train for w in text[i])
    two = collections.Counter(p for i in train for p in zip(["<s>", *text[i]], text[i]))
    total = sum(one.values())

    def factors(counts):
        return katz.discounts([sum(c == r for c in counts.values()) for r in range(1, 7)])

    d1, d2 = factors(one), factors(two)
    p = {w: d1[min(c, 6)] * c / total for w, c in one.items()}
    unknown = 1 - sum(p.values())
    context = collections.Counter()
    for (h, _), c in two.items():
        context[h] += c
    kept, lower = collections.Counter(), collections.Counter()
    for (h, w), c in two.items():
        kept[h] += d2[min(c, 6)] * c / context[h]
        lower[h] += p[w]

    def prob(h, w):
        if (h, w) in two:
            return d2[min(two[h, w], 6)] * two[h, w] / context[h]
        return p.get(w, unknown) * ((1 - kept[h]) / (1 - lower[h]) if h in context else 1)

    for h in [*context, "never"]:
        assert sum(prob(h, w) for w in one) + prob(h, None) == pytest.approx(1)
    found = {r["doc_id"]: r for r in katz.scored(docs(small).repartition(3)).collect()}
    for i, words in text.items():
        r = found[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (i not in train, len(words), sum(w in one for w in words), total)
        assert r["base_score"] == pytest.approx(sum(math.log10((one[w] + 1) / (total + len(one) + 1)) for w in words))
        assert r["score"] == pytest.approx(sum(math.log10(prob(h, w)) for h, w in zip(["<s>", *words], words)))


def test_katz_tables(docs, spark, small):
    text = tokens_of(small)
    train = [i for i in text if zlib.crc32(str(i).encode()) % 7 != 2]
    scores, counts, weights = katz.fit_and_score(docs(small))
    grams, back = katz.tables(spark, counts, weights)
    assert sorted(grams[1].values()) == sorted(collections.Counter(w for i in train for w in text[i]).values())
    assert sorted(grams[2].values()) == sorted(collections.Counter(p for i in train for p in zip(["<s>", *text[i]], text[i])).values())
    # every word but the end, and the start, is a context
    assert len(back) >= len(grams[1]) and scores.count() == len(small)


def test_nothing_to_learn_from(docs):
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2]
    for r in katz.scored(docs([(i, "a b") for i in held])).collect():
        assert (r["score"], r["base_score"], r["n_known"], r["train_tokens"]) == (0, 0, 0, 0)
