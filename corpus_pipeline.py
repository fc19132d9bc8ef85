"""From raw documents to a training mix: language ID, exact dedup, near-dedup, mixing of sources, tokenization.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and reread as the next stage's
documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sft_tables.llm import exact_dedup, langid, mixing, near_dedup, pieces
from sft_tables.llm.common import read_table, stored
from sft_tables.session import configure


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: null texts, texts without a letter and undecided ones go."""
    configure(spark)
    return langid.accepted(docs, model_path())


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal after lower-casing A-Z, the row with the largest id stays."""
    configure(spark)
    return exact_dedup.drop_exact_copies(docs, keep="largest")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by a similarity of 0.8 on five-word shingles, the one with the smallest id stays."""
    configure(spark)
    return near_dedup.drop_near_copies(docs, words=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: 150 % of all words, sources weighing 3, 1, 2 in turn, two epochs at most."""
    return mixing.mixed_documents(docs, read_table(spark, sf_dir, "labels"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per row of the mix: number and digest of its ids, and the digest of the text decoded from them."""
    configure(spark)
    return pieces.encoded(docs, model_path())


STAGES = [("language", language), ("exact", exact), ("near", near), ("mix", mix), ("tokens", tokens)]

#: Minima of hashes, a trained model and a merge vocabulary are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
