import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs(spark):
    """A documents table from (doc_id, text[, lang[, source]])."""
    def build(rows, schema=SCHEMA):
        full = [(i, t, *(rest[0:1] or ["en"]), *(rest[1:2] or ["a"]), None if t is None else len(t)) for i, t, *rest in rows]
        return spark.createDataFrame(full, schema)

    return build


@pytest.fixture
def odd(spark):
    """Nulls in any column, empty and very long texts, ties and repeated rows, columns whose names operators use themselves."""
    long = " ".join(f"word{i % 977} thing{i % 31}" for i in range(60_000))
    rows = [
        (1, "Alpha beta gamma delta epsilon zeta", "en", "a", 1), (2, "ALPHA beta gamma delta epsilon zeta", "en", "a", 2),
        (2, "ALPHA beta gamma delta epsilon zeta", "en", "a", 2), (2, "another text under the same id", "en", "b", 3),
        (None, "a text without an id, but with words", "de", None, 4), (None, None, None, None, None), (5, None, "en", "a", 0),
        (6, "", "fr", "b", 0), (7, "   \n\t ", "fr", None, 5), (8, long, None, "c", len(long)), (9, long + " end", "en", "c", 1),
        (10, "12 34 56 !!", "en", "c", 1), (11, "日本語のテキスト \U0001f600 é", "ja", "é", 1), (12, "x", "en", "", 1),
    ]
    names = ["_h", "_norm", "_id", "_tie", "_source", "key", "part", "node", "row", "words", "size", "taken", "score", "held_out", "table", "block", "_u"]
    data = [(*r, *[f"{n}{i}" for n in names]) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{n}` string" for n in names))


@pytest.fixture
def model_path():
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")
