"""Repeats, near copies and the pipeline against brute force."""

import hashlib
import random
import re
import sys
from pathlib import Path

import numpy as np
import pytest

from sft_tables.llm import exact_dedup, langid, mixing, near_dedup, pieces, repeats
from tests.llm.test_texts import ASCII

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))


def removed(rows, length=50):
    """By the definition: for each row its bytes, and which of them go."""
    first = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        for p in range(len(b) - length + 1):
            s = b[p:p + length]
            first[s] = min(first.get(s, i), i)
    for i, b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p:p + length]] < i:
                gone[p:p + length] = b"\1" * length
        yield i, b, gone


@pytest.mark.parametrize("often", [0, 3, repeats.OFTEN])
def test_repeats(docs, often):
    rng = random.Random(9)

    def prose(n):
        return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(n))

    passages = [prose(n) for n in (11, 12, 20, 60)] + ["x" * 300, "ab" * 90, "\x00" * 70]
    rows = []
    for i in range(120):
        parts = [prose(rng.randint(0, 30)) for _ in range(rng.randint(1, 3))]
        for _ in range(rng.randint(0, 2)):
            p = rng.choice(passages)
            parts.insert(rng.randint(0, len(parts)), p[rng.randint(0, len(p) // 3):])
        rows.append((i * 7 % 120, rng.choice(["", " "]).join(parts)))
    rows += [(500, rows[0][1]), (501, rows[0][1][5:]), (502, None), (503, ""), (3, rows[5][1])]
    got = sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"], bytes(r["kept"]))
                 for r in repeats.without_repeats(docs(rows).repartition(3), keep_text=True, often=often).collect())
    want = []
    for i, b, gone in removed(rows):
        kept = bytes(x for x, g in zip(b, gone) if not g)
        want.append((i, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest(), kept))
    assert got == sorted(want) and sum(w[2] for w in want) > 1000


def test_borders_have_the_common_prefixes():
    rng = np.random.default_rng(1)
    for depth in (1, 3, 7):
        codes = np.concatenate([rng.integers(1, 4, 200), [0], rng.integers(1, 3, 80), [0], np.ones(40, int), [0]])
        order = repeats.sorted_suffixes(codes, depth)
        twice = np.concatenate([codes, codes, codes])
        prefix = [tuple(twice[p:p + depth]) for p in order]
        assert prefix == sorted(prefix)
        found = repeats.bounded_borders(codes[order - 1].astype(np.int16), depth)
        assert found[1:-1].tolist() == [a != b for a, b in zip(prefix, prefix[1:])]


def shingle_sets(rows, words):
    out = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(ASCII))
        out[i] = frozenset(zip(*(w[k:] for k in range(words)))) if len(w) >= words else frozenset([tuple(w)] if w else [])
    return out


def brute_components(rows, words, percent):
    sets = shingle_sets(rows, words)
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, i in enumerate(ids):
        for j in ids[:k]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}, sets


def near_rows(rng, families=12, members=9):
    rows, n = [], 0
    for _ in range(families):
        base = [f"w{rng.randint(0, 10**6)}" for _ in range(rng.choice([3, 30, 120, 400]))]
        for _ in range(rng.randint(1, members)):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                text[rng.randrange(len(text))] = f"x{rng.randint(0, 10**6)}"
            rows.append((n, " ".join(text).upper() if rng.random() < 0.3 else "\t".join(text)))
            n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, "one two"), (n + 3, "One  two"), (n + 4, "one"), (n + 5, " \n")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("words, percent, group", [(3, 85, 512), (3, 85, 2), (5, 80, 3), (1, 100, 512)])
def test_near_groups(docs, words, percent, group):
    rows = near_rows(random.Random(words * percent))
    want, sets = brute_components(rows, words, percent)
    found = {r["doc_id"]: r for r in near_dedup.near_groups(docs(rows).repartition(3), words, percent, group).collect()}
    for i, root in want.items():
        r = found[i]
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[i]), root, root == i), i
    assert len(set(want.values())) < len(rows) - 10


def test_star_around_a_hidden_centre(docs):
    """Copies of one text, each changed elsewhere, are linked to the text but not to each other."""
    rng = random.Random(1)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(60):
        text = list(base)
        for k in rng.sample(range(0, 200, 4), 4):
            text[k] = f"c{i}-{k}"
        rows.append((i, " ".join(text)))
    rows.append((99, " ".join(base)))
    want, _ = brute_components(rows, 3, 85)
    found = {r["doc_id"]: r["component_id"] for r in near_dedup.near_groups(docs(rows), 3, 85, group=16).collect()}
    assert found == want


def test_chains_become_one_component(spark):
    pairs = [(bytes([i]), bytes([i + 1])) for i in range(40)] + [(b"y", b"z")]
    random.Random(2).shuffle(pairs)
    found = {r["node"]: r["root"] for r in near_dedup.components(spark.createDataFrame(pairs, "left binary, right binary")).collect()}
    assert {bytes(found[bytes([i])]) for i in range(41)} == {bytes([0])} and bytes(found[b"z"]) == b"y"


def test_sub_keys_meet_the_bound():
    for percent in (50, 80, 85, 95):
        m = near_dedup.sub_keys_needed(percent)
        s = (percent / 100) ** near_dedup.ROWS
        assert 1 - (1 - (1 - s) ** m) ** 2 <= near_dedup.MISSED < (1 - (1 - (1 - s) ** (m - 1)) ** 2 if m > 1 else 1)


def test_sub_keys_collide_as_often_as_sets_agree():
    rng = np.random.default_rng(3)
    same = 0
    for _ in range(300):
        both, a, b = (rng.integers(0, 2**56, n, dtype=np.uint64) for n in (80, 10, 10))
        x, y = np.sort(np.concatenate([both, a])), np.sort(np.concatenate([both, b]))
        keys = near_dedup.sub_keys(np.concatenate([x, y]), np.array([0, 90, 180]), 7)
        same += (keys[0] == keys[1]).sum()
    assert same / (300 * 14) == pytest.approx(0.8**2, abs=0.03)


def test_pipeline(docs, spark, tmp_path, model_path):
    import corpus_pipeline
    import sentencepiece

    rng = random.Random(11)
    rows = [(i, t, "en", rng.choice(["a", "a", "b", "c", None])) for i, t in near_rows(rng)] + [(900, "w1 w2 w3 12", "en", "a"), (901, "W1 w2 w3 12", "en", "b"),
                                                                                          (902, "12 34", "en", "a")]
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(0, 60)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = sorted((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())

    texts = {i: t for i, t, *_ in rows if t and any(map(str.isalpha, t))}
    last = {}
    for i, t in texts.items():
        last[t.translate(ASCII)] = max(i, last.get(t.translate(ASCII), -1))
    texts = {i: texts[i] for i in last.values()}
    roots, _ = brute_components(list(texts.items()), 5, 80)
    kept = docs([r for r in rows if r[0] in texts and roots[r[0]] == r[0]])
    mixed = mixing.mixed_documents(kept, spark.read.parquet(f"{tmp_path}/labels.parquet")).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=model_path)
    want = []
    for r in mixed:
        ids = library.encode(r["text"])
        want.append((r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert got == sorted(want) and len(corpus_pipeline.STAGES) == 5
    assert (langid, exact_dedup, pieces) and all(callable(f) for _, f in corpus_pipeline.STAGES)
