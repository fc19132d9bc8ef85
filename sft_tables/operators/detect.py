"""Which record format does each dataset use? All formats are scored in one aggregation.

The input is the 25-row sample per dataset; scores, ranks and the choice are one row per
(dataset, format), so nothing after the sample grows with the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sft_tables.operators.formats import (
    AMBIGUITY_MARGIN, QA_PAIRS, SAMPLE_ROWS, SCHEMA_ALIASES, SCHEMA_PRIORITY, FieldFormat,
    known_formats, lookup_column, resolve_format,
)
from sft_tables.operators.rows import JsonRow, sample_rows

SCORE = "decimal(4,3)"
PENALTY = "0.120"
PARTIAL_WEIGHT = 0.6
MARK_START, MARK_END = "<|im_start|>", "<|im_end|>"


def _halves_going_down() -> dict[int, list[int]]:
    """total -> present counts whose score lies halfway between two thousandths and rounds down, because the
    binary product 0.6 * present / total falls just below the half."""
    low: dict[int, list[int]] = {}
    for t in sorted({n * k for n in range(1, SAMPLE_ROWS + 1) for k in (2, 3)}):
        for p in range(1, t):
            thousandths = Fraction(600 * p, t)
            if thousandths.denominator == 2 and round(PARTIAL_WEIGHT * p / t, 3) * 1000 < float(thousandths):
                low.setdefault(t, []).append(p)
    return low


def _partial_score(present: str, total: str) -> Column:
    """0.6 * present / total to three places."""
    down = " OR ".join(f"({total} = {t} AND {present} IN ({', '.join(map(str, ps))}))" for t, ps in _halves_going_down().items())
    return F.expr(
        f"CAST(round(CAST(0.6 * {present} AS DECIMAL(20,1)) / {total}, 3) AS DECIMAL(4,3)) "
        f"- CASE WHEN {down} THEN 0.001 ELSE 0.000 END"
    ).cast(SCORE)


def _all(condition: Column) -> Column:
    return F.min(F.coalesce(condition, F.lit(False)))


def _chat_shape(row: JsonRow, field: str, role: str, content: str) -> Column:
    items = row.items(field)
    has = lambda m, k: F.try_variant_get(m, f"$.{k}", "variant").isNotNull()
    return row.is_object & (F.size(items) > 0) & F.forall(items, lambda m: has(m, role) & has(m, content))


def score_formats(sample: DataFrame, penalty_fields: dict[str, tuple[str, ...]] | None = None, extra: Sequence[FieldFormat] = ()) -> DataFrame:
    """One row per (dataset_id, format): confidence, matched, reason, fields. ``extra``: field formats of the caller."""
    row = JsonRow()
    field_formats = known_formats(extra)
    fields = sorted({f for fmt in field_formats for f in fmt.required} | {f for p in QA_PAIRS for f in p} | {"context", "messages", "conversations"})
    penalties = penalty_fields or {}
    text = F.coalesce(row.whole_text(), row.text("text"))
    flags = sample.select(
        "dataset_id", "keys",
        *[row.present(f).alias(f"has_{f}") for f in fields],
        _chat_shape(row, "messages", "role", "content").alias("openai_shape"),
        _chat_shape(row, "conversations", "from", "value").alias("sharegpt_shape"),
        (text.contains(MARK_START) & text.contains(MARK_END)).alias("marked"),
    )
    has = {f: F.col(f"has_{f}") for f in fields}
    both = {pair: has[pair[0]] & has[pair[1]] for pair in QA_PAIRS}
    aggs = [F.count(F.lit(1)).alias("n"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("keys")))).alias("fields")]
    aggs += [F.max(has[f]).alias(f"any_{f}") for f in fields]
    for fmt in field_formats:
        complete = has[fmt.required[0]]
        for f in fmt.required[1:]:
            complete = complete & has[f]
        aggs.append(F.count_if(complete).alias(f"full_{fmt.name}"))
        aggs.append(F.sum(sum((has[f].cast("int") for f in fmt.required), F.lit(0))).alias(f"present_{fmt.name}"))
    qa_row = both[QA_PAIRS[0]] | both[QA_PAIRS[1]]
    aggs += [_all(qa_row).alias("qa_all"), _all(F.col("openai_shape")).alias("openai_all"),
             _all(F.col("sharegpt_shape")).alias("sharegpt_all"), _all(F.col("marked")).alias("chatml_all")]
    stats = flags.groupBy("dataset_id").agg(*aggs)

    def any_of(f: str) -> Column:
        return F.col(f"any_{f}")

    def result(name: str, confidence: Column, matched: Column, reason: Column) -> Column:
        return F.struct(
            F.lit(name).alias("format"), confidence.cast(SCORE).alias("confidence"),
            matched.alias("matched"), reason.alias("reason"),
        )

    def field_result(fmt: FieldFormat) -> Column:
        known = F.size("fields") > 0
        matched = known & (F.col(f"full_{fmt.name}") == F.col("n"))
        partial = _partial_score(f"present_{fmt.name}", f"(n * {len(fmt.required)})")
        full = F.lit(fmt.confidence).cast(SCORE)
        elsewhere = [f for f in (*fmt.penalty_fields, *penalties.get(fmt.name, ()))]
        reason = F.lit(f"required fields present: {list(fmt.required)}")
        if elsewhere:
            hit = F.arrays_overlap("fields", F.array(*[F.lit(f) for f in elsewhere]))
            full = F.when(hit, F.greatest(full - F.lit(PENALTY).cast(SCORE), F.lit(0).cast(SCORE))).otherwise(full)
        incomplete = F.concat(F.lit("required fields are complete in "), F.col(f"full_{fmt.name}"), F.lit("/"),
                              F.col("n"), F.lit(" sampled rows"))
        return result(
            fmt.name,
            F.when(~known, F.lit("0")).when(matched, full).otherwise(partial),
            matched,
            F.when(~known, "no recognizable object fields").when(matched, reason).otherwise(incomplete),
        )

    pair_share = F.greatest(*[
        (any_of(a).cast("int") + any_of(b).cast("int")) * F.lit("0.3").cast(SCORE) for a, b in QA_PAIRS
    ])
    qa = result(
        "qa_json",
        F.when(F.col("qa_all") & any_of("context"), F.lit("0.860")).when(F.col("qa_all"), F.lit("0.980"))
        .otherwise(pair_share.cast("string")),
        F.col("qa_all"),
        F.when(F.col("qa_all"), "rows contain question/answer or prompt/response fields")
        .otherwise("some rows lack a supported Q&A field pair"),
    )

    def chat_result(name: str, field: str, ok: str, pair: str) -> Column:
        seen = F.coalesce(any_of(field), F.lit(False))
        matched = seen & F.col(ok)
        return result(
            name, F.when(matched, F.lit("1")).when(seen, F.lit("0.550")).otherwise(F.lit("0")), matched,
            F.when(matched, f"{field} contain {pair} objects")
            .when(seen, f"{field} field does not contain {pair} objects").otherwise(f"missing {field} field"),
        )

    chatml = result("chatml", F.when(F.col("chatml_all"), F.lit("1")).otherwise(F.lit("0")), F.col("chatml_all"),
                    F.when(F.col("chatml_all"), "ChatML start/end markers").otherwise("ChatML markers not found"))
    results = F.array(
        *[field_result(fmt) for fmt in field_formats], qa,
        chat_result("openai_chat", "messages", "openai_all", "role/content"),
        chat_result("sharegpt", "conversations", "sharegpt_all", "from/value"), chatml,
    )
    return stats.select("dataset_id", "fields", F.explode(results).alias("r")).select("dataset_id", "fields", "r.*")


def rank_candidates(scores: DataFrame, key: str = "dataset_id", name: str = "format",
                    priority: dict[str, int] | None = None) -> DataFrame:
    """Add ``rank``: by confidence, priority and name, all descending (nine rows per key)."""
    order = F.coalesce(lookup_column(F.col(name), priority or SCHEMA_PRIORITY, "int"), F.lit(0))
    w = Window.partitionBy(key).orderBy(F.desc("confidence"), F.desc("_priority"), F.desc(name))
    return scores.withColumn("_priority", order).withColumn("rank", F.row_number().over(w).cast("bigint")).drop("_priority")


def select_format(ranked: DataFrame, requests: DataFrame | None = None, key: str = "dataset_id",
                  name: str = "format", stage: str = "schema", extra: Sequence[FieldFormat] = ()) -> DataFrame:
    """One row per dataset: the chosen format with its confidence, or an error code.

    ``requests`` (key, requested) holds explicit choices; datasets without one are detected.
    """
    match = F.col("matched")
    best = F.struct((-F.col("rank")).alias("o"), name, "confidence")
    summary = ranked.groupBy(key).agg(
        F.max(F.when(match, best)).alias("best"),
        F.count_if(match).alias("n_matched"),
        # second best: the two highest matched confidences of at most nine candidates
        F.slice(F.sort_array(F.collect_list(F.when(match, F.col("confidence"))), asc=False), 1, 2).alias("top"),
        F.map_from_entries(F.collect_list(F.struct(name, "confidence"))).alias("all"),
    )
    if requests is not None:
        summary = summary.join(requests.select(key, "requested"), key, "left")
    else:
        summary = summary.withColumn("requested", F.lit(None).cast("string"))
    summary = resolve_format(summary, "requested", stage, extra)
    margin = F.try_element_at("top", F.lit(1)) - F.try_element_at("top", F.lit(2))
    auto = F.col("format") == "auto"
    error = (
        F.when(F.col("format").isNull(), "UNKNOWN_FORMAT")
        .when(auto & F.col("best").isNull(), "NOT_RECOGNIZED")
        .when(auto & (F.col("n_matched") > 1) & (margin <= F.lit(AMBIGUITY_MARGIN).cast(SCORE)), "AMBIGUOUS")
    )
    chosen = F.when(error.isNull(), F.when(auto, F.col(f"best.{name}")).otherwise(F.col("format")))
    return summary.select(
        key, chosen.alias("chosen"),
        F.when(error.isNull(), F.when(auto, F.col("best.confidence")).otherwise(F.try_element_at("all", F.col("format"))))
        .alias("confidence"),
        error.alias("code"),
    ).select(key, F.col("chosen").alias(name), "confidence", "code")


def detection_report(ranked: DataFrame, selected: DataFrame, key: str = "dataset_id", name: str = "format",
                     config_key: str = "format") -> DataFrame:
    """Readable explanation per dataset whose format could not be chosen.

    Not recognized: the five best candidates above zero. Ambiguous: matched candidates only.
    """
    failed = selected.filter(F.col("code").isin("NOT_RECOGNIZED", "AMBIGUOUS")).select(key, "code")
    shown = ranked.join(failed, key).filter(
        (F.col("confidence") > 0) & (F.col("matched") | (F.col("code") == "NOT_RECOGNIZED"))
    )
    w = Window.partitionBy(key).orderBy("rank")
    line = F.concat(F.lit("- "), F.col(name), F.lit(": confidence "), F.format_string("%.2f", F.col("confidence").cast("double")),
                    F.lit(" ("), F.col("reason"), F.lit(")"))
    lines = (
        shown.withColumn("_pos", F.row_number().over(w)).filter("_pos <= 5").withColumn("_line", line)
        .groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_pos", "_line"))).alias("_lines"))
    )
    fields = ranked.filter("rank = 1").select(key, "fields")
    heading = F.when(F.col("code") == "AMBIGUOUS", "Dataset format is ambiguous.").otherwise("Dataset format not recognized.")
    field_list = F.concat(F.lit("["), F.array_join(F.transform("fields", lambda f: F.concat(F.lit("'"), f, F.lit("'"))), ", "),
                          F.lit("]"))
    return failed.join(fields, key).join(lines, key, "left").select(
        key, "code",
        F.concat_ws(
            "\n", heading, F.concat(F.lit("Detected fields: "), field_list), F.lit(""), F.lit("Candidate formats:"),
            F.coalesce(F.array_join(F.col("_lines._line"), "\n"), F.lit("- none")),
            F.lit(""), F.lit(f"Set dataset.{config_key} explicitly to override detection."),
        ).alias("report"),
    )


def detect_dataset_format(rows: DataFrame, n: int = SAMPLE_ROWS, extra: Sequence[FieldFormat] = ()) -> DataFrame:
    """Ranked scores of every format for every dataset."""
    return rank_candidates(score_formats(sample_rows(rows, n), extra=extra))


assert set(SCHEMA_ALIASES) == set(SCHEMA_PRIORITY)
