"""Passages that training texts share with a benchmark, against brute force."""

import random

import pytest

from sft_tables.operators import passages


def brute(train, bench, words):
    lower = str.maketrans(passages.UPPER, passages.LOWER)
    runs = lambda text: [tuple(w[i:i + words]) for w in [(text or "").translate(lower).split()] for i in range(len(w) - words + 1)]
    wanted = {r for _, t in bench for r in runs(t)}
    out = {}
    for key, text in train:
        covered, found = set(), 0
        spans = []
        for i, r in enumerate(runs(text)):
            if r in wanted:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + words
                else:
                    spans.append([i, i + words])
        if spans:
            sizes = [b - a for a, b in spans]
            out[key] = (len(sizes), sum(sizes), max(sizes))
    held = {r for _, t in train for r in runs(t)}
    items = {k: (len(set(runs(t))), len(set(runs(t)) & held)) for k, t in bench if runs(t)}
    return out, items


@pytest.mark.parametrize("words, stretch, most", [(3, 5, 1 << 25), (4, 1024, 0)])
def test_passages(spark, monkeypatch, words, stretch, most):
    """Whatever the stretches, with the filter and without."""
    monkeypatch.setattr(passages, "STRETCH", stretch)
    monkeypatch.setattr(passages, "MOST_BITS", most)
    rng = random.Random(words)
    text = lambda n: " ".join(rng.choice(["a", "B", "c", "d", "e\u00e9", "F"]) for _ in range(n))
    bench = [(i, text(rng.choice([0, 2, 6, 12]))) for i in range(12)] + [(50, None)]
    train = [(i, text(rng.choice([0, 1, 5, 60]))) for i in range(40)] + [(100, None), (101, " ".join([text(30), bench[3][1], text(9)])), (102, "x y z " * 20)]
    train_table = spark.createDataFrame(train, "doc_id bigint, text string").repartition(3)
    bench_table = spark.createDataFrame(bench, "item_id bigint, text string")
    documents, items = brute(train, bench, words)
    found = passages.passage_overlap(train_table, bench_table, "doc_id", words=words).collect()
    assert {r["doc_id"]: (r["n_passages"], r["n_words"], r["longest"]) for r in found} == documents
    found = passages.benchmark_exposure(train_table, bench_table, "item_id", words=words).collect()
    assert {r["item_id"]: (r["n_runs"], r["n_found"]) for r in found} == items


def test_filter_keeps_what_it_holds(spark):
    runs = spark.range(3000).selectExpr("concat('run ', id) AS run")
    held = runs.filter("run LIKE '%7'")
    condition = passages.run_filter(held, 1 << 13)
    assert held.filter(condition).count() == 300
    assert runs.filter(condition).count() < 600


def test_nothing_to_share(spark):
    none = spark.createDataFrame([], "id bigint, text string")
    some = spark.createDataFrame([(1, "one two three four five six seven eight nine")], "id bigint, text string")
    assert passages.passage_overlap(some, none, "id").collect() == passages.passage_overlap(none, some, "id").collect() == []
    assert [tuple(r) for r in passages.benchmark_exposure(none, some, "id").collect()] == [(1, 2, 0)]
