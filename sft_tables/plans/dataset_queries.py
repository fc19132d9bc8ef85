"""Row model, detection, validation and conversion over datasets derived from ``documents`` and ``pages``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sft_tables.functions import text as tx
from sft_tables.operators import chat, convert, detect, formats, passages
from sft_tables.operators import rows as rw
from sft_tables.operators.rows import to_row_model
from sft_tables.plans import fixtures
from sft_tables.plans.fixtures import ROWS_SQL, row_model

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def keep(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


# ---- oracle building blocks: the same rows by their logical columns -------------------------------------
ANSWER_KEY = """CASE fmt WHEN 0 THEN 'output' WHEN 1 THEN 'response' WHEN 2 THEN 'completion' WHEN 3 THEN 'answer'
  WHEN 4 THEN 'answer' WHEN 8 THEN 'chosen' END"""
BASE = f"""
r AS ({ROWS_SQL}),
kr AS MATERIALIZED (
  SELECT *, fault = 'missing_answer' AS missing, ds >= 9 AND row_index % 2 = 0 AS qa_ctx, {ANSWER_KEY} AS answer_key,
    list_filter(CASE fmt WHEN 0 THEN ['instruction', 'input'] WHEN 1 THEN ['instruction', 'input'] WHEN 2 THEN ['prompt', 'input']
      WHEN 3 THEN ['question', CASE WHEN ds >= 9 AND row_index % 2 = 0 THEN 'context' END]
      WHEN 4 THEN ['context', 'question'] WHEN 5 THEN ['messages'] WHEN 6 THEN ['conversations'] WHEN 7 THEN ['text']
      ELSE ['prompt', 'rejected'] END || [CASE WHEN fmt NOT IN (5, 6, 7) AND fault <> 'missing_answer' THEN {ANSWER_KEY} END],
      lambda x: x IS NOT NULL) AS keys
  FROM r),
sample AS MATERIALIZED (SELECT * FROM kr WHERE row_index <= 25),
sk AS (SELECT dataset_id, unnest(keys) AS key FROM sample),
ds_fields AS MATERIALIZED (SELECT dataset_id, list_sort(list_distinct(list(key))) AS fields FROM sk GROUP BY dataset_id)
"""


def _has(*names: str) -> str:
    return " AND ".join(f"list_contains(keys, '{n}')" for n in names)


def _field_score(fmt: formats.FieldFormat, penalty: str = "0") -> str:
    full = f"count(*) FILTER (WHERE {_has(*fmt.required)})"
    present = "sum(" + " + ".join(f"CAST(list_contains(keys, '{n}') AS INT)" for n in fmt.required) + ")"
    wanted = str(list(fmt.required)).replace("'", "''")
    return f"""SELECT dataset_id, '{fmt.name}' AS format,
      CASE WHEN {full} = count(*) THEN {fmt.confidence} - {penalty} ELSE round(0.6 * {present} / (count(*) * {len(fmt.required)}), 3) END AS confidence,
      {full} = count(*) AS matched,
      CASE WHEN {full} = count(*) THEN 'required fields present: {wanted}'
        ELSE 'required fields are complete in ' || {full} || '/' || count(*) || ' sampled rows' END AS reason
      FROM sample GROUP BY dataset_id"""


QA_SCORE = f"""SELECT dataset_id, 'qa_json' AS format,
   CASE WHEN ok THEN CASE WHEN list_contains(fields, 'context') THEN 0.86 ELSE 0.98 END
     ELSE round(0.6 * greatest(
       (CAST(list_contains(fields, 'question') AS INT) + CAST(list_contains(fields, 'answer') AS INT)) / 2.0,
       (CAST(list_contains(fields, 'prompt') AS INT) + CAST(list_contains(fields, 'response') AS INT)) / 2.0), 3) END AS confidence,
   ok AS matched,
   CASE WHEN ok THEN 'rows contain question/answer or prompt/response fields' ELSE 'some rows lack a supported Q&A field pair' END AS reason
  FROM (SELECT dataset_id, bool_and(({_has('question', 'answer')}) OR ({_has('prompt', 'response')})) AS ok FROM sample GROUP BY dataset_id)
  JOIN ds_fields USING (dataset_id)"""


def _chat_score(name: str, field: str, fmt: int, pair: str) -> str:
    return f"""SELECT dataset_id, '{name}' AS format,
      CASE WHEN bool_and(fmt = {fmt} AND NOT missing) THEN 1 WHEN bool_or(fmt = {fmt}) THEN 0.55 ELSE 0 END AS confidence,
      bool_and(fmt = {fmt} AND NOT missing) AS matched,
      CASE WHEN bool_and(fmt = {fmt} AND NOT missing) THEN '{field} contain {pair} objects'
        WHEN bool_or(fmt = {fmt}) THEN '{field} field does not contain {pair} objects' ELSE 'missing {field} field' END AS reason
      FROM sample GROUP BY dataset_id"""


CHATML_SCORE = """SELECT dataset_id, 'chatml' AS format, CASE WHEN bool_and(fmt = 7) THEN 1 ELSE 0 END AS confidence,
  bool_and(fmt = 7) AS matched,
  CASE WHEN bool_and(fmt = 7) THEN 'ChatML start/end markers' ELSE 'ChatML markers not found' END AS reason
  FROM sample GROUP BY dataset_id"""

SCORE_SQL = {
    **{f.name: _field_score(f) for f in formats.FIELD_FORMATS}, "qa_json": QA_SCORE,
    "openai_chat": _chat_score("openai_chat", "messages", 5, "role/content"),
    "sharegpt": _chat_score("sharegpt", "conversations", 6, "from/value"), "chatml": CHATML_SCORE,
}
SCORES = BASE + ", scores AS MATERIALIZED (" + "\nUNION ALL\n".join(SCORE_SQL.values()) + """),
ranked AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY dataset_id ORDER BY confidence DESC,
    CASE WHEN format IN ('openai_chat', 'sharegpt', 'chatml') THEN 20 ELSE 0 END DESC, format DESC) AS rank
  FROM scores),
best AS (
  SELECT dataset_id, arg_min(format, rank) FILTER (WHERE matched) AS format,
         arg_min(confidence, rank) FILTER (WHERE matched) AS confidence,
         list_sort(list(CAST(confidence AS DECIMAL(4,3))) FILTER (WHERE matched), 'DESC') AS top
  FROM ranked GROUP BY dataset_id),
picked AS (
  SELECT dataset_id, CASE WHEN format IS NULL THEN 'NOT_RECOGNIZED' WHEN top[1] - top[2] <= 0.030 THEN 'AMBIGUOUS' END AS code,
         format AS best_format, confidence AS best_confidence FROM best),
chosen AS MATERIALIZED (
  SELECT dataset_id, CASE WHEN code IS NULL THEN best_format END AS format,
         CASE WHEN code IS NULL THEN CAST(best_confidence AS DOUBLE) END AS confidence, code FROM picked)
"""

FAULTS = """
faults AS (
  SELECT kr.dataset_id, row_index, fmt, c.format, q, ctx, ans, fault,
    CASE WHEN fault IN ('blank_answer', 'number_answer') AND fmt IN (5, 6) THEN 'CONTENT_BLANK'
         WHEN fault = 'blank_answer' AND fmt = 7 THEN 'CONTENT_BLANK'
         WHEN fault IN ('blank_answer', 'number_answer') AND fmt <> 7 THEN 'BLANK_OR_NOT_STRING'
         WHEN missing AND fmt IN (5, 6) THEN 'CONTENT_BLANK'
         WHEN missing AND fmt = 7 THEN 'CHATML_MALFORMED'
         WHEN missing AND fmt = 3 THEN 'QA_NO_PAIR'
         WHEN missing THEN 'MISSING_FIELDS'
         WHEN fault = 'null_context' AND fmt IN (0, 1, 2) THEN 'OPTIONAL_NOT_STRING'
         WHEN fault = 'null_context' AND fmt = 3 AND qa_ctx THEN 'CONTEXT_NOT_STRING'
         WHEN fault = 'null_context' AND fmt = 4 THEN 'BLANK_OR_NOT_STRING'
         WHEN fault = 'null_context' AND fmt IN (5, 6, 7) THEN 'CONTENT_BLANK' END AS code,
    CASE WHEN fmt IN (5, 6, 7) AND fault = 'null_context' THEN 1
         WHEN fmt IN (5, 6) AND fault <> 'ok' THEN 3 WHEN fmt = 7 AND fault = 'blank_answer' THEN 3 END AS turn,
    CASE WHEN fmt IN (5, 6, 7) OR (missing AND fmt = 3) OR fault = 'ok' THEN NULL
         WHEN fault = 'null_context' AND fmt IN (0, 1, 2) THEN 'input'
         WHEN fault = 'null_context' AND (fmt = 4 OR (fmt = 3 AND qa_ctx)) THEN 'context'
         WHEN fault <> 'null_context' THEN answer_key END AS detail, qa_ctx, answer_key
  FROM kr JOIN chosen c ON c.dataset_id = kr.dataset_id AND c.code IS NULL)
"""
CONVERTED = f"WITH {SCORES}, {FAULTS}"
SPACE_CLASS = (r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")


def sql_strip(expr: str) -> str:
    return f"regexp_replace(regexp_replace({expr}, '^{SPACE_CLASS}+', ''), '{SPACE_CLASS}+$', '')"


# ---- row model and small text rules ---------------------------------------------------------------------
@register("row_model", f"WITH {BASE} SELECT dataset_id, row_index, 'object' AS kind, "
          "array_to_string(list_sort(keys), ',') AS keys FROM kr")
def q_row_model(spark, sf_dir):
    return row_model(spark, sf_dir).select("dataset_id", "row_index", "kind", F.array_join(F.array_sort("keys"), ",").alias("keys"))


@register("map_columns", f"""WITH {BASE} SELECT dataset_id, row_index,
   CASE WHEN list_contains(keys, 'prompt') AND list_contains(keys, 'completion') THEN NULL ELSE 'MAP_MISSING_SOURCE' END AS map_error,
   CASE WHEN list_contains(keys, 'prompt') AND list_contains(keys, 'completion')
        THEN 'completion,input,instruction,output,prompt' ELSE array_to_string(list_sort(keys), ',') END AS keys,
   CASE WHEN fmt IN (0, 1) OR (fmt = 2 AND fault <> 'missing_answer') THEN q END AS instruction FROM kr""")
def q_map_columns(spark, sf_dir):
    mapped = rw.map_columns(row_model(spark, sf_dir), {"instruction": "prompt", "output": "completion"})
    return mapped.select("dataset_id", "row_index", "map_error", F.array_join(F.array_sort("keys"), ",").alias("keys"),
                         rw.JsonRow().text("instruction").alias("instruction"))


@register("map_table_columns", """SELECT doc_id, lang AS instruction, text AS output FROM documents""")
def q_map_table_columns(spark, sf_dir):
    docs = fixtures.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return rw.map_table_columns(docs, {"instruction": "lang", "output": "text"}).select("doc_id", "instruction", "output")


@register("detected_fields", f"WITH {BASE} SELECT dataset_id, array_to_string(fields, ',') AS fields FROM ds_fields")
def q_detected_fields(spark, sf_dir):
    return rw.detected_fields(rw.sample_rows(row_model(spark, sf_dir))).select(
        "dataset_id", F.array_join("fields", ",").alias("fields"))


PADDED = "chr(28) || chr(160) || chr(10) || text || chr(8195) || chr(9) || ' '"


@register("strip_text", f"""SELECT doc_id, md5({sql_strip(PADDED)}) AS stripped,
   regexp_matches(text, '[^' || substr('{SPACE_CLASS}', 2)) AS nonblank FROM documents""")
def q_strip_text(spark, sf_dir):
    docs = fixtures.table(spark, sf_dir, "documents")
    padded = F.concat(F.lit("\x1c \n"), "text", F.lit(" \t "))
    return docs.select("doc_id", F.md5(tx.strip(padded)).alias("stripped"), tx.nonblank("text").alias("nonblank"))


@register("normalize_format_name", """SELECT p_partkey, replace(lower(trim(p_type || '-' || p_brand)), '-', '_') AS format_key FROM part""")
def q_format_name(spark, sf_dir):
    part = fixtures.table(spark, sf_dir, "part")
    return part.select("p_partkey", tx.format_name(F.concat(F.lit(" "), "p_type", F.lit("-"), "p_brand", F.lit("\t"))).alias("format_key"))


REQUEST_CASE = """CASE p_size % 8 WHEN 0 THEN ' QA ' WHEN 1 THEN 'prompt-completion' WHEN 2 THEN 'Preference' WHEN 3 THEN 'messages'
  WHEN 4 THEN 'context-qa' WHEN 5 THEN 'auto' WHEN 6 THEN 'yaml' END"""


@register("resolve_format_aliases", f"""SELECT p_partkey, coalesce(replace(lower(trim({REQUEST_CASE})), '-', '_'), 'auto') AS requested_key,
  CASE p_size % 8 WHEN 0 THEN 'qa_json' WHEN 1 THEN 'prompt_completion' WHEN 2 THEN 'dpo' WHEN 3 THEN 'openai_chat'
  WHEN 4 THEN 'rag_qa' WHEN 6 THEN NULL ELSE 'auto' END AS format FROM part""")
def q_aliases(spark, sf_dir):
    part = fixtures.table(spark, sf_dir, "part").select("p_partkey", F.expr(REQUEST_CASE).alias("requested"))
    return formats.resolve_format(part, "requested").select("p_partkey", "requested_key", "format")


# ---- detection --------------------------------------------------------------------------------------------
@register("sample_rows", f"WITH {BASE} SELECT dataset_id, row_index FROM sample")
def q_sample_rows(spark, sf_dir):
    return rw.sample_rows(row_model(spark, sf_dir)).select("dataset_id", "row_index")


@register("first_rows", """SELECT source, doc_id FROM
  (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents) WHERE n <= 25""")
def q_first_rows(spark, sf_dir):
    docs = fixtures.table(spark, sf_dir, "documents").select("source", "doc_id")
    return rw.first_rows(docs, "doc_id", key="source")


def _scores(spark, sf_dir, penalty=None) -> DataFrame:
    scores = detect.score_formats(rw.sample_rows(row_model(spark, sf_dir)), penalty)
    return scores.withColumn("confidence", F.col("confidence").cast("double"))


def _register_scores(name: str) -> None:
    sql = f"WITH {BASE} SELECT dataset_id, CAST(confidence AS DOUBLE) AS confidence, matched, reason FROM ({SCORE_SQL[name]})"

    @register(f"score_{name}", sql)
    def one(spark, sf_dir):
        return _scores(spark, sf_dir).filter(F.col("format") == name).select("dataset_id", "confidence", "matched", "reason")


for _name in SCORE_SQL:
    _register_scores(_name)


@register("score_partial", f"""WITH {SCORES} SELECT dataset_id, format, CAST(confidence AS DOUBLE) AS confidence, reason FROM scores
  WHERE NOT matched AND reason LIKE 'required fields are complete%'""")
def q_partial(spark, sf_dir):
    return _scores(spark, sf_dir).filter("NOT matched AND reason LIKE 'required fields are complete%'").select(
        "dataset_id", "format", "confidence", "reason")


@register("score_with_penalty", f"""WITH {BASE} SELECT dataset_id, CAST(round(confidence, 3) AS DOUBLE) AS confidence, matched
  FROM ({_field_score(formats.ALPACA, "CASE WHEN bool_or(list_contains(keys, 'input')) THEN 0.12 ELSE 0 END")})""")
def q_penalty(spark, sf_dir):
    return _scores(spark, sf_dir, {"alpaca": ("input",)}).filter("format = 'alpaca'").select("dataset_id", "confidence", "matched")


@register("rank_candidates", f"WITH {SCORES} SELECT dataset_id, format, CAST(confidence AS DOUBLE) AS confidence, matched, rank FROM ranked")
def q_rank(spark, sf_dir):
    return detect.rank_candidates(_scores(spark, sf_dir)).select("dataset_id", "format", "confidence", "matched", "rank")


REQUESTS = """CASE CAST(substr(source, 4) AS INT) % 5 WHEN 0 THEN 'auto' WHEN 1 THEN ' Sharegpt ' WHEN 2 THEN 'yaml' END"""


@register("select_format", f"""WITH {SCORES}, req AS (SELECT DISTINCT source AS dataset_id, {REQUESTS} AS requested FROM documents)
  SELECT c.dataset_id,
    CASE coalesce(requested, 'auto') WHEN 'auto' THEN c.format WHEN 'yaml' THEN NULL ELSE 'sharegpt' END AS format,
    CASE coalesce(requested, 'auto') WHEN 'auto' THEN c.confidence WHEN 'yaml' THEN NULL ELSE CAST(s.confidence AS DOUBLE) END AS confidence,
    CASE coalesce(requested, 'auto') WHEN 'auto' THEN c.code WHEN 'yaml' THEN 'UNKNOWN_FORMAT' END AS code
  FROM chosen c JOIN req USING (dataset_id) JOIN scores s ON s.dataset_id = c.dataset_id AND s.format = 'sharegpt'""")
def q_select(spark, sf_dir):
    requests = fixtures.table(spark, sf_dir, "documents").select(
        F.col("source").alias("dataset_id"), F.expr(REQUESTS).alias("requested")).distinct()
    ranked = detect.detect_dataset_format(row_model(spark, sf_dir))
    return detect.select_format(ranked, requests).withColumn("confidence", F.col("confidence").cast("double"))


@register("detection_report", f"""WITH {SCORES}, failed AS (SELECT dataset_id, code FROM chosen WHERE code IS NOT NULL),
  lines AS (
    SELECT dataset_id, '- ' || format || ': confidence ' || printf('%.2f', CAST(confidence AS DOUBLE)) || ' (' || reason || ')' AS line, rank,
      row_number() OVER (PARTITION BY dataset_id ORDER BY rank) AS pos
    FROM ranked JOIN failed USING (dataset_id) WHERE confidence > 0 AND (matched OR code = 'NOT_RECOGNIZED'))
  SELECT f.dataset_id, f.code, CASE f.code WHEN 'AMBIGUOUS' THEN 'Dataset format is ambiguous.' ELSE 'Dataset format not recognized.' END
    || chr(10) || 'Detected fields: [' || array_to_string(list_transform(fields, lambda x: chr(39) || x || chr(39)), ', ') || ']' || chr(10) || chr(10)
    || 'Candidate formats:' || chr(10)
    || coalesce((SELECT string_agg(line, chr(10) ORDER BY pos) FROM lines l WHERE l.dataset_id = f.dataset_id AND pos <= 5), '- none')
    || chr(10) || chr(10) || 'Set dataset.format explicitly to override detection.' AS report
  FROM failed f JOIN ds_fields USING (dataset_id)""")
def q_report(spark, sf_dir):
    ranked = detect.detect_dataset_format(row_model(spark, sf_dir))
    return detect.detection_report(ranked, detect.select_format(ranked))


@register("detect_dataset_format", f"""WITH {SCORES} SELECT dataset_id, rank, format, CAST(confidence AS DOUBLE) AS confidence, matched, reason,
  array_to_string(fields, ',') AS fields FROM ranked JOIN ds_fields USING (dataset_id)""")
def q_detect(spark, sf_dir):
    ranked = detect.detect_dataset_format(row_model(spark, sf_dir))
    return ranked.select("dataset_id", "rank", "format", F.col("confidence").cast("double").alias("confidence"), "matched",
                         "reason", F.array_join("fields", ",").alias("fields"))


# ---- validation and conversion ------------------------------------------------------------------------------
def _lacking(required: tuple[str, ...]) -> str:
    return "list_filter([" + ", ".join(f"'{f}'" for f in required) + "], lambda x: NOT list_contains(keys, x))"


def _field_oracles(fmt: formats.FieldFormat, fmt_no: int, columns: str) -> tuple[str, str]:
    optional = "'OPTIONAL_NOT_STRING'" if "input" in fmt.output and fmt.output["input"] == "input" else "'BLANK_OR_NOT_STRING'"
    ctx_field = "'input'" if "input" in fmt.output and fmt.output["input"] == "input" else "'context'"
    null_ctx = "FALSE" if fmt.name == "dpo" else "fault = 'null_context'"
    fits = f"len({_lacking(fmt.required)}) = 0 AND fmt = {fmt_no}"
    bad = f"""SELECT dataset_id, row_index,
        CASE WHEN len({_lacking(fmt.required)}) > 0 THEN 'MISSING_FIELDS'
             WHEN fault IN ('blank_answer', 'number_answer') THEN 'BLANK_OR_NOT_STRING' WHEN {null_ctx} THEN {optional} END AS code,
        CASE WHEN len({_lacking(fmt.required)}) > 0 THEN array_to_string({_lacking(fmt.required)}, ',')
             WHEN fault IN ('blank_answer', 'number_answer') THEN answer_key WHEN {null_ctx} THEN {ctx_field} END AS detail FROM v"""
    # rag rows are also complete in the question/answer datasets that carry a context
    view = f"WITH {BASE}, v AS (SELECT * REPLACE (CASE WHEN fmt = 3 AND NOT qa_ctx AND fault = 'null_context' THEN 'ok' ELSE fault END AS fault) FROM kr)"
    good = f"{view} SELECT dataset_id, row_index, {columns} FROM v JOIN (SELECT dataset_id AS d, row_index AS i, code FROM ({bad}) b) ON d = dataset_id AND i = row_index WHERE code IS NULL"
    assert fits
    return f"{view} SELECT * FROM ({bad}) b WHERE code IS NOT NULL", good


def _register_fields(fmt: formats.FieldFormat, fmt_no: int, columns: str) -> None:
    bad, good = _field_oracles(fmt, fmt_no, columns)

    @register(f"validate_{fmt.name}", bad)
    def violations(spark, sf_dir):
        return convert.validate_fields(row_model(spark, sf_dir), fmt)

    @register(f"convert_{fmt.name}", good)
    def rows(spark, sf_dir):
        return convert.convert_fields(row_model(spark, sf_dir), fmt)


_SFT = "q AS instruction, ctx AS input, ans AS output"
_register_fields(formats.ALPACA, 0, _SFT)
_register_fields(formats.INSTRUCTION_RESPONSE, 1, _SFT)
_register_fields(formats.PROMPT_COMPLETION, 2, _SFT)
_register_fields(formats.RAG_QA, 4, _SFT)
_register_fields(formats.DPO, 8, "q AS prompt, ans AS chosen, q || ' ?' AS rejected")


@register("convert_qa", f"""WITH {BASE} SELECT dataset_id, row_index, q AS instruction,
   CASE WHEN fmt = 4 OR qa_ctx THEN ctx ELSE '' END AS input, ans AS output FROM kr
   WHERE fmt IN (3, 4) AND fault NOT IN ('missing_answer', 'blank_answer', 'number_answer')
     AND NOT (fault = 'null_context' AND (fmt = 4 OR qa_ctx))""")
def q_convert_qa(spark, sf_dir):
    return convert.convert_qa(row_model(spark, sf_dir))


@register("convert_rag_pages", """SELECT page_id, 'What is the title of ' || url AS instruction, html AS input,
   regexp_extract(html, '<title>(.*?)</title>', 1) AS output FROM pages
   WHERE trim(html) <> '' AND trim(regexp_extract(html, '<title>(.*?)</title>', 1)) <> ''""")
def q_rag_pages(spark, sf_dir):
    pages = fixtures.table(spark, sf_dir, "pages").select(
        "page_id", F.concat(F.lit("What is the title of "), "url").alias("question"), F.col("html").alias("context"),
        F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("answer"))
    return convert.convert_columns(pages, formats.RAG_QA, ["page_id"])


def _register_chat(name: str, fmt: int, output: str) -> None:
    bad = "'null_context', 'blank_answer', 'missing_answer'" + ("" if fmt == 7 else ", 'number_answer'")

    @register(f"convert_{name}", f"""WITH {BASE} SELECT dataset_id, row_index, CAST(3 AS BIGINT) AS turn, q AS instruction,
      'System: ' || ctx AS input, {output} AS output FROM kr WHERE fmt = {fmt} AND fault NOT IN ({bad})""")
    def rows(spark, sf_dir):
        return convert.convert_chat(row_model(spark, sf_dir), name)

    roles = "'system,user,assistant'" if fmt != 7 else "CASE WHEN fault = 'missing_answer' THEN 'system,user' ELSE 'system,user,assistant' END"

    @register(f"extract_{name}_messages", f"""WITH {BASE} SELECT dataset_id, row_index, {roles} AS roles, q AS question FROM kr WHERE fmt = {fmt}""")
    def messages(spark, sf_dir):
        found = convert.extract_messages(row_model(spark, sf_dir), name).filter(F.size("messages") > 0)
        return found.select("dataset_id", "row_index", F.array_join(F.col("messages.role"), ",").alias("roles"),
                            F.get(F.col("messages.content"), 1).alias("question"))


_register_chat("openai_chat", 5, "ans")
_register_chat("sharegpt", 6, "ans")
_register_chat("chatml", 7, f"CASE WHEN fault = 'number_answer' THEN '7' ELSE {sql_strip('ans')} END")


@register("task_gate", f"WITH {SCORES} SELECT dataset_id, format, 'preference' AS task, 'TASK_UNSUPPORTED' AS code FROM chosen WHERE format = 'dpo'")
def q_task_gate(spark, sf_dir):
    return convert.task_gate(detect.select_format(detect.detect_dataset_format(row_model(spark, sf_dir))))


@register("require_non_empty", """SELECT 'src' || p_partkey AS dataset_id, 'EMPTY_DATASET' AS code FROM part
  WHERE 'src' || p_partkey NOT IN (SELECT source FROM documents)""")
def q_non_empty(spark, sf_dir):
    expected = fixtures.table(spark, sf_dir, "part").select(F.concat(F.lit("src"), "p_partkey").alias("dataset_id"))
    present = fixtures.table(spark, sf_dir, "documents").select(F.col("source").alias("dataset_id"))
    return convert.require_non_empty(present, expected)


@register("validate_unified", f"""SELECT doc_id, CASE WHEN lang = 'de' OR {sql_strip('text')} = '' THEN 'UNIFIED_BLANK' ELSE 'UNIFIED_INPUT' END AS code
  FROM documents WHERE lang = 'de' OR lang = 'fr' OR {sql_strip('text')} = ''""")
def q_unified(spark, sf_dir):
    docs = fixtures.table(spark, sf_dir, "documents").select(
        "doc_id", F.when(F.col("lang") == "de", "  ").otherwise(F.col("lang")).alias("instruction"),
        F.when(F.col("lang") != "fr", F.col("source")).alias("input"), F.col("text").alias("output"))
    return convert.validate_unified(docs, ["doc_id"])


SFT_ORACLE = f"""
sft AS (
  SELECT dataset_id, row_index, CASE WHEN fmt IN (5, 6, 7) THEN CAST(3 AS BIGINT) END AS turn, q AS instruction,
    CASE WHEN fmt IN (5, 6, 7) THEN 'System: ' || ctx WHEN fmt = 3 THEN CASE WHEN qa_ctx THEN ctx ELSE '' END ELSE ctx END AS input,
    CASE WHEN fmt = 7 THEN CASE WHEN fault = 'number_answer' THEN '7' ELSE {sql_strip('ans')} END ELSE ans END AS output
  FROM faults WHERE code IS NULL AND format <> 'dpo'),
refused AS (
  SELECT dataset_id, code FROM chosen WHERE code IS NOT NULL
  UNION ALL SELECT dataset_id, 'TASK_UNSUPPORTED' FROM chosen WHERE format = 'dpo')
"""


@register("convert_dataset", f"{CONVERTED}, {SFT_ORACLE} SELECT * FROM sft")
def q_convert(spark, sf_dir):
    return convert.convert_dataset(row_model(spark, sf_dir)).rows


@register("conversion_violations", f"""{CONVERTED}
  SELECT dataset_id, row_index, CAST(turn AS BIGINT) AS turn, code, detail FROM faults WHERE code IS NOT NULL
  UNION ALL SELECT dataset_id, NULL, NULL, code, NULL FROM chosen WHERE code IS NOT NULL
  UNION ALL SELECT dataset_id, NULL, NULL, 'TASK_UNSUPPORTED', NULL FROM chosen WHERE format = 'dpo'""")
def q_violations(spark, sf_dir):
    return convert.convert_dataset(row_model(spark, sf_dir)).violations


@register("convert_preference", f"""{CONVERTED} SELECT dataset_id, row_index, q AS prompt, ans AS chosen, q || ' ?' AS rejected
  FROM faults WHERE code IS NULL AND format = 'dpo'""")
def q_preference(spark, sf_dir):
    return convert.convert_dataset(row_model(spark, sf_dir), require=None).preference


NEWS = formats.FieldFormat("news", ("headline", "body"), {"instruction": "headline", "input": "note", "output": "body"}, "0.970",
                           aliases=("article",), defaults={"input": ""})


@register("convert_own_format", """SELECT source AS dataset_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS row_index, CAST(NULL AS BIGINT) AS turn,
  'Item ' || doc_id AS instruction, CASE WHEN CAST(substr(source, 4) AS INT) % 2 = 0 THEN lang ELSE '' END AS input, text AS output FROM documents""")
def q_own_format(spark, sf_dir):
    """A format that the caller brings: found in datasets of even number by its fields, asked for by an alias in the others."""
    rows = fixtures.dataset_rows(spark, sf_dir)
    noted = F.to_json(F.struct(F.concat(F.lit("Item "), F.substring_index("q", " ", -1)).alias("headline"), F.col("ans").alias("body"), F.col("ctx").alias("note")))
    plain = F.to_json(F.struct(F.concat(F.lit("Item "), F.substring_index("q", " ", -1)).alias("headline"), F.col("ans").alias("body")))
    raw = rows.select("dataset_id", "row_index", F.when(F.col("ds") % 2 == 0, noted).otherwise(plain).alias("raw"))
    asked = rows.filter("ds % 2 = 1").select("dataset_id", F.lit(" Article").alias("requested")).distinct()
    return convert.convert_dataset(to_row_model(raw), asked, extra=(NEWS,)).rows


TRAIN = "(SELECT text FROM documents UNION ALL SELECT text FROM benchmark)"


@register("train_benchmark_overlap", f"""SELECT t.digest, train_rows, benchmark_rows FROM
  (SELECT sha256({sql_strip('text')}) AS digest, count(*) AS train_rows FROM {TRAIN} GROUP BY 1) t
  JOIN (SELECT sha256({sql_strip('text')}) AS digest, count(*) AS benchmark_rows FROM benchmark GROUP BY 1) b USING (digest)""")
def q_overlap(spark, sf_dir):
    bench = fixtures.table(spark, sf_dir, "benchmark").select("text")
    train = fixtures.table(spark, sf_dir, "documents").select("text").unionByName(bench)
    return convert.train_benchmark_overlap(train, bench)


# ---- passages -----------------------------------------------------------------------------------------------------
WORDS_SQL = rf"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^{SPACE_CLASS[1:-1]}]+')"
RUNS = f"""bw AS (SELECT item_id, {WORDS_SQL} AS w FROM benchmark),
br AS (SELECT item_id, array_to_string(w[i + 1 : i + {passages.WORDS}], ' ') AS run FROM (SELECT item_id, w, unnest(range(0, len(w) - {passages.WORDS - 1})) AS i FROM bw)),
dw AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
dr AS (SELECT doc_id, i, array_to_string(w[i + 1 : i + {passages.WORDS}], ' ') AS run FROM (SELECT doc_id, w, unnest(range(0, len(w) - {passages.WORDS - 1})) AS i FROM dw)),
hit AS MATERIALIZED (SELECT DISTINCT doc_id, i, run FROM dr WHERE run IN (SELECT run FROM br))"""


@register("passage_overlap", f"""WITH {RUNS},
  step AS (SELECT doc_id, i, CASE WHEN lag(i) OVER (PARTITION BY doc_id ORDER BY i) >= i - {passages.WORDS} THEN 0 ELSE 1 END AS new FROM hit),
  isle AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM step),
  part AS (SELECT doc_id, max(i) - min(i) + {passages.WORDS} AS n FROM isle GROUP BY doc_id, k)
  SELECT doc_id, count(*) AS n_passages, CAST(sum(n) AS BIGINT) AS n_words, max(n) AS longest FROM part GROUP BY doc_id""")
def q_passages(spark, sf_dir):
    """Which documents hold passages of the benchmark, and how long they are."""
    return passages.passage_overlap(fixtures.table(spark, sf_dir, "documents"), fixtures.table(spark, sf_dir, "benchmark"), "doc_id")


@register("benchmark_exposure", f"""WITH {RUNS} SELECT item_id, count(*) AS n_runs, count(*) FILTER (WHERE run IN (SELECT run FROM hit)) AS n_found
  FROM (SELECT DISTINCT item_id, run FROM br) GROUP BY item_id""")
def q_exposure(spark, sf_dir):
    return passages.benchmark_exposure(fixtures.table(spark, sf_dir, "documents"), fixtures.table(spark, sf_dir, "benchmark"), "item_id")
