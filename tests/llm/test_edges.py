"""Every operator on odd rows and on no rows."""

import hashlib

import pytest

from sft_tables.llm import (
    exact_dedup, fingerprints, importance, katz, langid, mixing, near_dedup, pieces, repeats, token_counts, toxicity, warc,
)


def labels_of(df):
    return df.selectExpr("doc_id", "1 AS quality", "cast(doc_id % 2 AS int) AS toxic").unionByName(
        df.limit(3).selectExpr("doc_id", "cast(null AS int) AS quality", "cast(null AS int) AS toxic"))


def word_path():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


OPERATORS = {
    "toxicity": lambda d, m: toxicity.scored(d, labels_of(d)),
    "mixture": lambda d, m: mixing.mixture(d, labels_of(d)),
    "fingerprints": lambda d, m: fingerprints.fingerprinted(d),
    "pieces": lambda d, m: pieces.encoded(d, m),
    "katz": lambda d, m: katz.scored(d),
    "repeats": lambda d, m: repeats.without_repeats(d),
    "langid": lambda d, m: langid.identified(d, m),
    "near": lambda d, m: near_dedup.near_groups(d, 3, 85),
    "exact": lambda d, m: exact_dedup.exact_groups(d),
    "counts": lambda d, m: token_counts.token_counts(d, word_path()),
    "importance": lambda d, m: importance.resampled(d, d.limit(4)),
}
FILTERS = {
    "langid": lambda d, m: langid.accepted(d, m),
    "exact": lambda d, m: exact_dedup.drop_exact_copies(d, keep="largest"),
    "near": lambda d, m: near_dedup.drop_near_copies(d),
    "mix": lambda d, m: mixing.mixed_documents(d, labels_of(d)),
    "importance": lambda d, m: importance.drawn_documents(d, d.limit(4), least_words=1, percent=50),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_odd_row(odd, model_path, name):
    found = OPERATORS[name](odd, model_path).collect()
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(r["doc_id"]) for r in odd.collect())


@pytest.mark.parametrize("name", OPERATORS)
def test_no_rows(odd, model_path, name):
    assert OPERATORS[name](odd.filter("false"), model_path).collect() == []


@pytest.mark.parametrize("name", FILTERS)
def test_filters_keep_columns(odd, model_path, name):
    found = FILTERS[name](odd, model_path)
    assert found.columns == odd.columns
    given = {tuple(r[c] for c in odd.columns if c not in ("text", "n_chars")) for r in odd.collect()}
    assert {tuple(r[c] for c in odd.columns if c not in ("text", "n_chars")) for r in found.collect()} <= given
    assert FILTERS[name](odd.filter("false"), model_path).collect() == []


def test_defined_results(odd, model_path):
    by = {}
    for r in langid.identified(odd, model_path).collect():
        by.setdefault(r["doc_id"], r)
    assert [by[i]["lang_pred"] for i in (5, 6, 7, 10)] == ["und"] * 4 and by[6]["score"] == 0
    near = {r["doc_id"]: r for r in near_dedup.near_groups(odd, 3, 85).collect()}
    assert [(near[i]["n_shingles"], near[i]["component_id"], near[i]["kept"]) for i in (5, 6, 7)] == [(0, 5, True), (0, 6, True), (0, 7, True)]
    assert near[9]["component_id"] == 8 and near[12]["n_shingles"] == 1
    tokens = {r["doc_id"]: r for r in pieces.encoded(odd, model_path).collect()}
    assert tokens[6]["n_tokens"] == tokens[5]["n_tokens"] == 0 and tokens[6]["ids_sha256"] == hashlib.sha256(b"").hexdigest()
    lm = {r["doc_id"]: r for r in katz.scored(odd).collect()}
    assert lm[6]["n_tokens"] == 1 and lm[8]["n_tokens"] == 120_001
    prints = {r["doc_id"]: r for r in fingerprints.fingerprinted(odd).collect()}
    assert prints[6]["n_chars"] == 0 and prints[6]["near_edited"] == 1.0
    assert {r["score"] for r in toxicity.scored(odd, labels_of(odd)).collect() if not 0 <= r["score"] <= 1} == set()


def test_warc_odd_pages(spark):
    rows = [(1, "http://a/b c", "x" * 200, "n"), (2, None, "x" * 200, "n"), (2, "http://a", "x" * 200, "n"), (None, "", "x" * 200, "n"),
            (4, "http://é/", None, "n"), (5, "http://a\n", "", "n"), (6, "u", "short", "n"), (7, "u", "short", "n"),
            (8, "u", "a\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n" * 9, "n"), (9, "u", "é" * 50, "n"), (10, "u", "é" * 50, "n"),
            (11, "u", "y" * 3_000_000, None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, path string").repartition(3)
    found = sorted((tuple(r)[:5] for r in warc.round_trip(pages).collect()), key=str)
    want = []
    first = {}
    for page, _, html, _ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        body = (html or "").encode()
        sha = hashlib.sha256(body).hexdigest()
        same = len(body) >= 100 and sha in first
        want.append((page, len(body), sha, "revisit" if same else "response", first[sha] if same else None))
        if len(body) >= 100:
            first.setdefault(sha, page)
    assert found == sorted(want, key=str)
    assert warc.round_trip(pages.filter("false")).collect() == []
