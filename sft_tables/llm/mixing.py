"""Mixing sources to target weights by Efraimidis-Spirakis sampling (DataFrame functions only).

Every document draws an exponential key divided by its quality weight. Within a source, documents are taken in key
order until the source's word budget is used up; budgets beyond the source's size take complete epochs first, so only
the rest is selected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sft_tables.llm.common import WORD, read_table, stored, uniform

#: A source's documents are cut into this many blocks of keys; only the block that the budget ends in is sorted.
BLOCKS = 1024
QUALITY = {1: 2.0, 0: 0.5}


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def sized(docs: DataFrame, quality: DataFrame | None, seed: str) -> DataFrame:
    """(doc_id, _source, size, _key, _tie) per row: no text."""
    rows = docs.select(
        "doc_id", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("_source"), word_count(F.col("text")).alias("size"),
        F.md5(F.coalesce("text", F.lit(""))).alias("_tie"),
    )
    weight = F.lit(1.0)
    if quality is not None:
        marks = quality.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("_quality"))
        rows = rows.join(marks, "doc_id", "left")
        weight = F.when(F.col("_quality") == 1, QUALITY[1]).when(F.col("_quality") == 0, QUALITY[0]).otherwise(1.0)
    return rows.select("doc_id", "_source", "size", (-F.log(uniform(F.col("doc_id"), seed)) / weight).alias("_key"), "_tie")


def source_targets(rows: DataFrame, weights: tuple[float, ...], share: float, epochs: float) -> DataFrame:
    """(_source, source_size, target) per source: shares by weight, none above ``epochs`` times the source's size.

    What a full source cannot take is shared among the others by weight until none is above its limit. Sorted by limit
    over weight, the full sources come first, so running sums find them at once. One row per source is sorted here.
    """
    by_name = Window.orderBy(F.col("_source") == "", "_source")
    sources = rows.groupBy("_source").agg(F.sum("size").alias("source_size")).select(
        "*", (F.col("source_size") * float(epochs)).alias("_limit"),
        F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")).alias("_w"),
    )
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy(F.col("_limit") / F.col("_w"), "_source").rowsBetween(Window.unboundedPreceding, -1)
    budget = F.sum("source_size").over(everything) * float(share)
    level = F.col("_limit") / F.col("_w")
    past_limit, past_w = F.coalesce(F.sum("_limit").over(before), F.lit(0.0)), F.coalesce(F.sum("_w").over(before), F.lit(0.0))
    marked = sources.select("*", budget.alias("_budget"), F.sum("_w").over(everything).alias("_all"), past_limit.alias("_pl"), past_w.alias("_pw")
                            ).withColumn("_full", F.col("_pl") + level * (F.col("_all") - F.col("_pw")) <= F.col("_budget"))
    left = F.col("_budget") - F.sum(F.when(F.col("_full"), F.col("_limit")).otherwise(0.0)).over(everything)
    open_w = F.sum(F.when(F.col("_full"), 0.0).otherwise(F.col("_w"))).over(everything)
    target = F.when(F.col("_full"), F.col("_limit")).otherwise(F.col("_w") * left / open_w)
    return marked.select("_source", "source_size", target.alias("target"))


def mixture(docs: DataFrame, quality: DataFrame | None = None, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5,
            epochs: float = 2, seed: str = "mix-1") -> DataFrame:
    """One row per row of ``docs``: (doc_id, size, source_size, target, taken, _source, _tie).

    ``size`` counts words (null text: 0), ``taken`` the words of this row that the mix takes, repeats counted: complete
    epochs times size, plus the whole size for rows before the source's cut, plus the words left at the cut. A source's
    ``taken`` sums to its rounded target; repeated rows (same id and text) that lie at a cut share what is left evenly,
    rounded down. Sources go by code point, null last; null ids draw one key. Texts without words take nothing; an
    empty table gives no rows. ``quality`` holds (doc_id, quality 1 or 0): weight 2 or 0.5; without a mark 1.

    Order within a source is never one sort: keys fall into BLOCKS blocks per source, block sums say where the budget
    ends, and only that block is ordered. The decision per source is one row, joined by measured size.
    """
    rows = stored(sized(docs, quality, seed), "mix-sizes")
    targets = stored(source_targets(rows, weights, share, epochs), "mix-targets")
    full = F.when(F.col("source_size") == 0, 0).otherwise(F.floor(F.round("target") / F.col("source_size"))).cast("bigint")
    plan = targets.withColumn("_epochs", full).withColumn("_rest", F.round("target").cast("bigint") - F.col("_epochs") * F.col("source_size"))

    block = F.least(F.floor(BLOCKS * (1 - F.exp(-F.col("_key")))).cast("int"), F.lit(BLOCKS - 1)).alias("_block")
    sums = rows.groupBy("_source", block).agg(F.sum("size").alias("_sum"))
    upto = F.sum("_sum").over(Window.partitionBy("_source").orderBy("_block"))
    ends = sums.select("*", (upto - F.col("_sum")).alias("_before")).join(plan.select("_source", "_rest"), "_source").filter(
        (F.col("_before") < F.col("_rest")) & (F.col("_rest") <= F.col("_before") + F.col("_sum"))).select("_source", "_block", "_before", "_rest")
    place = F.struct("_key", F.coalesce("doc_id", F.lit(-(2**63))).alias("_id"), "_tie").alias("_place")
    last = rows.select("_source", block, place, "size").groupBy("_source", "_block", "_place").agg(
        F.sum("size").alias("_sum"), F.count(F.lit(1)).alias("_rows")).join(ends, ["_source", "_block"])
    upto = F.col("_before") + F.sum("_sum").over(Window.partitionBy("_source", "_block").orderBy("_place"))
    cuts = last.select("_source", "_place", "_sum", "_rows", "_rest", upto.alias("_upto")).filter(
        (F.col("_upto") - F.col("_sum") < F.col("_rest")) & (F.col("_rest") <= F.col("_upto"))).select(
        "_source", F.col("_place").alias("_cut"), F.floor((F.col("_rest") - F.col("_upto") + F.col("_sum")) / F.col("_rows")).alias("_part"))
    plan = stored(plan.join(cuts, "_source", "left"), "mix-plan")

    extra = F.when(place < F.col("_cut"), F.col("size")).when(place == F.col("_cut"), F.col("_part")).otherwise(0)
    return rows.join(plan, "_source").select(
        "doc_id", "size", "source_size", "target",
        (F.col("_epochs") * F.col("size") + F.coalesce(extra, F.lit(0))).cast("bigint").alias("taken"), "_source", "_tie",
    )


def mixed_documents(docs: DataFrame, quality: DataFrame | None = None, **options) -> DataFrame:
    """The documents of the mix, columns as given: each row as often as it is taken, its last part cut after a word.

    Only the row at a source's cut appears in part: its first words with the white space between them, ``n_chars``
    (where there is such a column) set to the new length. Rows that the mix does not take go, and so do null and empty
    texts, which have no words. Repeated rows are each taken alike; an empty table gives none; columns of any name are kept.
    """
    taken = mixture(docs, quality, **options).filter("taken > 0").groupBy(
        F.coalesce("doc_id", F.lit(-(2**63))).alias("_id"), "_source", "_tie").agg(F.max("size").alias("_size"), F.max("taken").alias("_taken"))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce("doc_id", F.lit(-(2**63))).alias("_id"),
                        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("_source"), F.md5(F.coalesce("text", F.lit(""))).alias("_tie"))
    copies = F.floor(F.col("_taken") / F.col("_size")).cast("int")
    part = (F.col("_taken") % F.col("_size")).cast("int")
    words = F.concat(F.array_repeat(F.lit(0), copies), F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<int>")))
    out = keyed.join(taken, ["_id", "_source", "_tie"]).select("row", F.explode(words).alias("words"))
    pieces = F.split("row.text", r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    text = F.when(F.col("words") == 0, F.col("row.text")).otherwise(F.array_join(F.slice(pieces, 1, F.greatest("words", F.lit(1))), ""))
    columns = {"text": text}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(F.col("words") == 0, F.col("row.n_chars")).otherwise(F.length(text)).cast(docs.schema["n_chars"].dataType)
    return out.select(*[columns.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    return mixture(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")).drop("_source", "_tie")


SQL = """
WITH q AS (SELECT doc_id, max(quality) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
d AS (SELECT d.doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size, md5(coalesce(text, '')) AS tie,
             -ln((CAST('0x' || substr(md5('mix-1' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0)
               / CASE quality WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 ELSE 1.0 END AS k
      FROM documents d LEFT JOIN q ON d.doc_id = q.doc_id),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST([3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS w, 2.0 * source_size AS cap FROM s),
m AS (SELECT *, 1.5 * sum(source_size) OVER () AS budget, sum(w) OVER () AS all_w,
             coalesce(sum(cap) OVER b, 0) AS pl, coalesce(sum(w) OVER b, 0) AS pw
      FROM w WINDOW b AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, pl + cap / w * (all_w - pw) <= budget AS filled FROM m),
t AS (SELECT source, source_size, CASE WHEN filled THEN cap ELSE w * (budget - sum(CASE WHEN filled THEN cap ELSE 0 END) OVER ())
             / sum(CASE WHEN filled THEN 0 ELSE w END) OVER () END AS target FROM f),
e AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE CAST(floor(round(target) / source_size) AS BIGINT) END AS epochs FROM t),
r AS (SELECT d.doc_id, d.size, e.source_size, e.target, e.epochs, CAST(round(e.target) AS BIGINT) - e.epochs * e.source_size AS rest,
             CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY k, d.doc_id, tie ROWS UNBOUNDED PRECEDING) AS BIGINT) - d.size AS past
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, rest - past)) AS BIGINT) AS taken FROM r
"""
