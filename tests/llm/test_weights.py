"""Token counts, importance resampling and whitening against the library, brute force and exact arithmetic."""

import hashlib
import math
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sft_tables.llm import importance, token_counts, whitening

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def word_path():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def words(word_path):
    return token_counts.Vocabulary(word_path)


@pytest.fixture(scope="module")
def library(word_path):
    from tokenizers import Tokenizer

    known = Tokenizer.from_file(word_path)
    return lambda texts: [len(e.ids) for e in known.encode_batch(texts, add_special_tokens=False)]


PARTS = ["'s", "'S", "''", "'ll", "'re", "don't", " ", "\n", "\t", "\x85", "\u3000", "\x1c", "12", "\u00bd", "!?", "e\u0301", "\u00c9", "\u03a3", "\u03c2",
         "\u0130", "\u00c5", "\u65e5\u672c", "\U0001f600", "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|", "\u1c89", "\U00010d40", "\u0378", "the", "Aab", "_"]


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.lists(st.one_of(st.sampled_from(PARTS), st.text(max_size=6)), max_size=25).map("".join), min_size=1, max_size=8))
def test_counts_are_the_librarys(words, library, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert words.counted(texts).tolist() == library(texts)


def test_long_words_and_texts(words, library):
    rng = random.Random(4)
    texts = ["a" * 5001, "ab" * 3000, "".join(rng.choice("aabc") for _ in range(4000)), "".join(rng.choice("etaoin") for _ in range(6000)),
             "x" * token_counts.LONG, "x" * (token_counts.LONG + 1), "\u65e5\u672c" * 700]
    assert words.counted(texts).tolist() == library(texts)
    for text in texts:
        raw = np.frombuffer(text.encode(), np.uint8)
        symbols = words.symbol[[*[0] * (len(raw) - 1), 1], raw]
        assert words.merged(symbols, np.array([len(raw)]))[0] == words.merged_long(symbols)


def test_parts_of_long_texts_do_not_matter(words, library, monkeypatch):
    text = "It's one text, in parts;\nno word is cut \u00e9 <|endoftext|> " * 40
    monkeypatch.setattr(token_counts.chunks, "__defaults__", (7,))
    assert words.counted([text]).tolist() == library([text])


def test_merges_whose_product_merges_earlier(words):
    """A product that an earlier rank takes up again: one place at a time, as by the definition."""
    late = object.__new__(token_counts.Vocabulary)
    pairs = [(4, 1), (2, 3), (1, 5)]  # abc + a, b + c, a + bc = abc
    late.product = np.array([6, 5, 4], np.int32)
    keys = np.array([a << 16 | b for a, b in pairs], np.uint32)
    order = np.argsort(keys)
    late.keys, late.rank_of, late.late = keys[order], order.astype(np.int32), np.array([False, False, True])
    # a b c a b c: (abc)(a)(bc) -> abca, bc
    symbols = np.array([1, 2, 3, 1, 2, 3], np.int32)
    assert late.merged(symbols.copy(), np.array([6]))[0] == 2 == late.merged_long(symbols)


def test_token_counts_table(docs, word_path, library):
    rows = [(1, "Hello, world's end"), (1, "Hello, world's end"), (None, "x"), (3, None), (4, ""), (5, "word " * 3000)]
    found = token_counts.token_counts(docs(rows).repartition(3), word_path).collect()
    want = [(i, len((t or "").encode()), n, n > 2048) for (i, t), n in zip(rows, library([t or "" for _, t in rows]))]
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)


def features(text):
    found = importance_words(text)
    return [*found, *(f"{a} {b}" for a, b in zip(found, found[1:]))]


def importance_words(text):
    out, word = [], []
    for b in (text or "").translate(ASCII).encode():
        if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128:
            word.append(b)
        elif word:
            out.append(bytes(word).decode())
            word = []
    return [*out, bytes(word).decode()] if word else out


def resampled_by_definition(rows, target, percent, least):
    s, t = Counter(), Counter()
    for out, texts in ((s, [x for _, x in rows]), (t, target)):
        for text in texts:
            out.update(zlib.crc32(f.encode()) % 10000 for f in features(text))
    ss, tt = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (ss + 10000) / ((s[b] + 1) * (tt + 10000)))) for b in range(10000)]
    found = []
    for i, text in rows:
        mine = [gain[zlib.crc32(f.encode()) % 10000] for f in features(text)]
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(mine) // len(mine) if mine else 0
        found.append([i, len(mine), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = [f for f, (_, text) in zip(found, rows) if len(importance_words(text)) >= least]
    for place, f in enumerate(sorted(able, key=lambda f: (-f[3], f[0] is None, f[0] or 0, f[1], f[2])), 1):
        if place <= percent * len(able) // 100:
            f[4] = place
    return sorted(map(tuple, found), key=str)


@pytest.fixture
def crowd():
    rng = random.Random(8)
    pool = ["alpha", "Beta", "gamma9", "\u00e9t\u00e9", "x" * 40, "y" * 16, "z" * 17, "d" * 8, "e" * 9, "\u65e5\u672c\u8a9e"]
    rows = [(i, (" " if i % 3 else "--").join(rng.choice(pool) for _ in range(rng.choice([0, 1, 3, 30])))) for i in range(120)]
    return rows + [(None, "alpha beta " * 20), (None, None), (500, "same text " * 15), (500, "same text " * 15), (500, "same text " * 15), (501, "")]


@pytest.mark.parametrize("head", [(1 << 15, 1 << 16), (2, 1), (0, 0)])
def test_importance_by_definition(docs, spark, crowd, monkeypatch, head):
    """Whatever the head holds, results are the same."""
    monkeypatch.setattr(importance, "HEAD_WORDS", head[0] or 1)
    monkeypatch.setattr(importance, "HEAD_PAIRS", head[1] or 1)
    if not head[0]:
        monkeypatch.setattr(importance, "head_of", lambda d, buckets: importance.Head.of([], [], buckets))
    target = ["Alpha beta", "alpha x", None, "\u00e9t\u00e9 gamma9 gamma9"]
    aim = spark.createDataFrame([(t, i) for i, t in enumerate(target)], "text string, words int")
    found = importance.resampled(docs(crowd).repartition(4), aim, percent=30, least_words=3).collect()
    assert sorted(map(tuple, found), key=str) == resampled_by_definition(crowd, target, 30, 3)


def test_empty_target(docs, spark, crowd):
    found = importance.resampled(docs(crowd), spark.createDataFrame([], "text string")).collect()
    assert sorted(map(tuple, found), key=str) == resampled_by_definition(crowd, [], 25, 20)


def test_parts_and_forgotten_words(docs, spark, crowd, monkeypatch):
    crowd = [*crowd, (900, " ".join(f"w{i % 91}" for i in range(4000))), (901, "q" * 900 + " " + "r" * 900 + " tail")]
    monkeypatch.setattr(importance, "REMEMBERED", 8)
    # functions sent to tasks take the values of their module there, so the parts are tested on the driver
    data = np.frombuffer(crowd[-2][1].encode(), np.uint8)
    whole = importance.Head.of([b"w1"], [], 10000).buckets_of(data, np.array([0, len(data)]), 10000)
    words, pairs = [], []
    for part, lead in importance.in_parts(data, 50):
        one = importance.Head.of([b"w1"], [], 10000).buckets_of(part, np.array([0, len(part)]), 10000)
        words.append(one[0][lead:])
        pairs.append(one[1])
    assert np.concatenate(words).tolist() == whole[0].tolist() and np.concatenate(pairs).tolist() == whole[1].tolist()
    found = importance.Frequent(1)
    for _ in range(50):
        found.add(np.array([1, 2, 3, 99], np.uint64), np.array([[1], [2], [3], [99]], np.uint64))
    found.trim(4)
    assert len(found.hashes) == 4 and importance.cut(data, 0, 50) <= 50
    long = np.frombuffer(crowd[-1][1].encode(), np.uint8)
    assert importance.cut(long, 0, 50) == 901


def exact_covariance(x):
    n, size = len(x), len(x[0])
    total = [sum(r[i] for r in x) for i in range(size)]
    return [[Fraction(n * sum(r[i] * r[j] for r in x) - total[i] * total[j], n * n) for j in range(size)] for i in range(size)], total


def vector_rows(spark, rows):
    return spark.createDataFrame([(i, v, str(i), 1) for i, v in rows], "vec_id bigint, embedding array<float>, component string, n int")


def test_whitening_by_exact_covariance(spark):
    rng = np.random.default_rng(2)
    mix = rng.normal(size=(12, 12)) * np.geomspace(1, 1e-2, 12)
    good = [(i, [float(v) for v in np.float32(rng.normal(size=12) @ mix + 3)]) for i in range(300)]
    nan, inf = float("nan"), float("inf")
    bad = [(900, None), (901, [nan] * 12), (902, [inf] * 12), (903, [None] * 12), (904, [1.0] * 11), (905, [1.0] * 13), (906, []), (907, [1e30] * 12)]
    found = whitening.whitened(vector_rows(spark, good + bad + [good[0], (None, good[1][1])]).repartition(5)).collect()
    given_rows = [*good, good[0], (None, good[1][1])]
    x = [[math.floor(1024 * np.float64(np.float32(c))) + 100000 for c in v] for _, v in given_rows]
    v, total = exact_covariance(x)
    n = len(x)
    values, vectors = np.linalg.eigh(np.array([[float(c) for c in r] for r in v]))
    values, vectors = values[::-1], vectors[:, ::-1]
    assert len(found) == 8 * n and {r["component"] for r in found} == set(range(1, 9)) and {r["n"] for r in found} == {n}
    assert sorted({(str(i), sum((n * a - s) ** 2 for a, s in zip(r, total))) for (i, _), r in zip(given_rows, x)}) == sorted({(str(r["vec_id"]), r["deviation"]) for r in found})
    assert max(r["identity_error"] for r in found) < 1e-9
    by = {}
    for r in found:
        by.setdefault(r["vec_id"], {})[r["component"]] = r
    for c in range(1, 9):
        assert by[5][c]["explained"] == pytest.approx(values[c - 1] / values.sum(), rel=1e-9)
        mine = np.array([by[i][c]["whitened"] for i, _ in good])
        want = np.array([[float(a - Fraction(s, n)) for a, s in zip(r, total)] for r in x[:300]]) @ vectors[:, c - 1] / values[c - 1] ** 0.5
        assert min(np.abs(mine - want).max(), np.abs(mine + want).max()) < 1e-8


def test_factor_and_rotations():
    rng = np.random.default_rng(1)
    for size, rank in [(1, 1), (2, 2), (7, 3), (30, 30), (9, 0)]:
        half = rng.normal(size=(size, rank)) * 10.0 ** rng.integers(-3, 4, size=(1, rank))
        matrix = half @ half.T
        factor, order = whitening.triangular_factor(matrix)
        assert factor.shape[1] == rank and np.allclose(factor @ factor.T, matrix[np.ix_(order, order)])
        assert np.allclose(factor, np.tril(factor))
        turned = whitening.orthogonal_columns(factor)
        norms = (turned ** 2).sum(axis=0)
        assert np.allclose(np.sort(norms), np.linalg.eigvalsh(matrix)[size - rank:], rtol=1e-9, atol=1e-12 * max(1, norms.max(initial=0)))
        product = turned.T @ turned / np.sqrt(np.outer(norms, norms))
        assert np.abs(product - np.eye(rank)).max(initial=0) < 1e-13


def test_tournament_meets_every_pair_once():
    for columns in range(2, 9):
        met = [(int(a), int(b)) for p, q in whitening.rounds(columns) for a, b in zip(p, q)]
        assert sorted(met) == [(a, b) for a in range(columns) for b in range(a + 1, columns)]
        assert all(len({*p, *q}) == 2 * len(p) for p, q in whitening.rounds(columns))


def test_products_of_any_size():
    for top in (3, 2**20, 2**27, 2**50):
        z = np.random.default_rng(top).integers(-top, top, size=(50, 3))
        wide = z.astype(object)
        assert (whitening.products(z) == wide.T @ wide).all()


def test_few_directions_and_no_rows(spark):
    line = [(i, [float(i), 2.0 * i, 0.0]) for i in range(10)]
    found = whitening.whitened(vector_rows(spark, line)).collect()
    assert {r["component"] for r in found} == {1} and found[0]["explained"] == pytest.approx(1.0) and found[0]["identity_error"] < 1e-9
    for rows in ([], [(1, None)], [(1, [])], [(i, [1.0, 2.0]) for i in range(3)]):
        none = whitening.whitened(vector_rows(spark, rows))
        assert none.collect() == [] and none.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_deviation_beyond_a_long_is_null(spark):
    rows = [(i, [float((-1) ** i) * 2.0**30, float(i)]) for i in range(100)]
    found = whitening.whitened(vector_rows(spark, rows)).collect()
    assert len(found) == 200 and {r["deviation"] for r in found} == {None}
