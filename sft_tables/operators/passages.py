"""Benchmark passages inside training texts: runs of words that both sides hold.

Every run of ``words`` words is looked at on both sides. The benchmark's runs become a Bloom filter, built by an aggregation
of its bits; training runs that it excludes are dropped where they are made, so little of the training text is shuffled. The
rest is compared as text, not by hash, with the distinct runs of the benchmark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sft_tables.functions.text import NOT_SPACE
from sft_tables.session import written

WORDS = 8
#: Words of a text that one row holds while its runs are made.
STRETCH = 1024
#: Bits per benchmark run, and the largest filter (4 MB); beyond it runs are shuffled without one.
BITS_PER_RUN, MOST_BITS = 16, 1 << 25
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_runs(texts: DataFrame, keys: list[str], text: str = "text", words: int = WORDS) -> DataFrame:
    """(keys..., at, run): every run of so many words, A-Z lower-cased, with the number of its first word (from 0).

    Words are cut into overlapping stretches first, so that a long text is never repeated for each of its words.
    """
    found = F.regexp_extract_all(F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER), F.lit(f"(?U)({NOT_SPACE}+)"), F.lit(1))
    numbered = texts.select(*keys, found.alias("_words")).filter(F.size("_words") >= words)
    starts = F.sequence(F.lit(0), F.size("_words") - words, F.lit(STRETCH))
    stretch = F.transform(starts, lambda s: F.struct(s.alias("base"), F.slice("_words", s + 1, STRETCH + words - 1).alias("part")))
    cut = numbered.select(*keys, F.inline(stretch))
    runs = F.transform(F.sequence(F.lit(1), F.size("part") - words + 1), lambda i: F.array_join(F.slice("part", i, words), " "))
    return cut.select(*keys, "base", F.posexplode(runs).alias("_i", "run")).select(*keys, (F.col("base") + F.col("_i")).cast("bigint").alias("at"), "run")


def _bits(run: Column, size: int) -> list[Column]:
    hashed = F.xxhash64(run)
    return [F.pmod(hashed, F.lit(size)), F.pmod(F.shiftright(hashed, 32), F.lit(size))]


def run_filter(runs: DataFrame, size: int) -> Column:
    """A condition that holds for every run of the table (column ``run``), and for few others.

    The filter is an array of ``size`` / 64 numbers, aggregated by number and then into one row.
    """
    bit = runs.select(F.explode(F.array(*_bits(F.col("run"), size))).alias("bit"))
    words = bit.groupBy((F.col("bit") / 64).cast("bigint").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 AS int))")).alias("v"))
    filled = runs.sparkSession.range(size // 64).select(F.col("id").alias("w")).join(words, "w", "left")
    table = filled.agg(F.transform(F.array_sort(F.collect_list(F.struct("w", F.coalesce("v", F.lit(0)).alias("v")))), lambda x: x["v"])).scalar()
    set_ = lambda b: F.getbit(F.get(table, (b / 64).cast("int")), (b % 64).cast("int")) == 1
    first, second = _bits(F.col("run"), size)
    return set_(first) & set_(second)


def benchmark_runs(bench: DataFrame, key: str, text: str = "text", words: int = WORDS) -> DataFrame:
    """(key, run): distinct runs of each benchmark item."""
    return word_runs(bench, [key], text, words).select(key, "run").distinct()


def shared_runs(train: DataFrame, bench: DataFrame, key: str, text: str = "text", words: int = WORDS) -> DataFrame:
    """(key, at, run): the training runs that occur in the benchmark."""
    wanted = written(word_runs(bench, [], text, words).select("run").distinct(), "benchmark-runs")
    size = 1 << max(10, (wanted.count() * BITS_PER_RUN - 1).bit_length())
    runs = word_runs(train, [key], text, words)
    if size <= MOST_BITS:
        runs = runs.filter(run_filter(wanted, size))
    return runs.join(wanted, "run", "left_semi").select(key, "at", "run")


def passages(shared: DataFrame, key: str, words: int = WORDS, block: int = STRETCH) -> DataFrame:
    """(key, first_word, n_words): the stretches of a text that are covered by shared runs, as long as they go.

    Neighbouring runs are joined inside blocks of positions first; what crosses borders is joined from one row per
    stretch, so a text of any length is not sorted as a whole.
    """
    from pyspark.sql import Window

    at = F.col("at")
    inside = Window.partitionBy(key, "_block").orderBy("at")
    rows = shared.select(key, "at").distinct().withColumn("_block", F.floor(at / block))
    gap = F.coalesce(F.lag("at").over(inside) < at - words, F.lit(True))
    local = rows.withColumn("_new", gap.cast("int")).withColumn("_n", F.sum("_new").over(inside)).groupBy(key, "_block", "_n").agg(
        F.min("at").alias("_from"), F.max("at").alias("_to"))
    ordered = Window.partitionBy(key).orderBy("_from")
    far = F.coalesce(F.lag("_to").over(ordered) < F.col("_from") - words, F.lit(True))
    whole = local.withColumn("_new", far.cast("int")).withColumn("_n", F.sum("_new").over(ordered)).groupBy(key, "_n").agg(
        F.min("_from").alias("first_word"), F.max("_to").alias("_last"))
    return whole.select(key, "first_word", (F.col("_last") - F.col("first_word") + words).alias("n_words"))


def passage_overlap(train: DataFrame, bench: DataFrame, key: str, text: str = "text", words: int = WORDS) -> DataFrame:
    """(key, n_passages, n_words, longest) per training text that shares a passage with the benchmark: how many stretches,
    how many of its words they cover, and the words of the longest. Texts that share nothing have no row."""
    found = passages(shared_runs(train, bench, key, text, words), key, words)
    return found.groupBy(key).agg(F.count(F.lit(1)).alias("n_passages"), F.sum("n_words").alias("n_words"), F.max("n_words").alias("longest"))


def benchmark_exposure(train: DataFrame, bench: DataFrame, key: str, text: str = "text", words: int = WORDS) -> DataFrame:
    """(key, n_runs, n_found) per benchmark item with at least one run: its distinct runs, and how many occur in training texts.

    Training runs are reduced to distinct ones before they meet the items, so a passage in many texts counts once.
    """
    seen = shared_runs(train.select(F.lit(0).alias("_id"), text), bench, "_id", text, words).select("run").distinct().withColumn("_seen", F.lit(1))
    return benchmark_runs(bench, key, text, words).join(seen, "run", "left").groupBy(key).agg(
        F.count(F.lit(1)).alias("n_runs"), F.count("_seen").alias("n_found"))
