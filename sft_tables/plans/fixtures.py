"""Working inputs derived from the given tables; the same SQL text runs in Spark and in the oracle."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sft_tables.functions.carry import running_total
from sft_tables.operators.rows import to_row_model
from sft_tables.session import configure
from sft_tables.sources.files import write_bytes

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()

ROWS_SQL = """
WITH b AS (
  SELECT source AS dataset_id, CAST(substr(source, 4) AS INT) AS ds, doc_id, lang, text,
         row_number() OVER (PARTITION BY source ORDER BY doc_id) AS row_index
  FROM documents)
SELECT dataset_id, ds, ds % 9 AS fmt, CAST(row_index AS BIGINT) AS row_index,
       'Describe item ' || CAST(doc_id AS STRING) AS q, lang AS ctx, text AS ans,
       CASE WHEN ds % 4 = 3 AND row_index = 3 THEN 'missing_answer'
            WHEN ds % 4 = 1 AND row_index = 30 THEN 'missing_answer'
            WHEN row_index % 13 = 5 THEN 'blank_answer'
            WHEN row_index % 17 = 9 THEN 'null_context'
            WHEN row_index % 19 = 11 THEN 'number_answer' ELSE 'ok' END AS fault
FROM b
"""

LOG_SQL = """
WITH e AS (
  SELECT user_id AS run_id, event_type, value,
         CAST(replace(replace(props, '{"k": ', ''), '}', '') AS INT) AS k,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS seq
  FROM events)
SELECT run_id, seq, k, event_type, value, k % 3 = 0 AS cr,
       CASE WHEN seq % 25 = 1 THEN '***** Running training *****'
            WHEN seq % 25 = 0 THEN '***** train metrics *****'
            WHEN event_type = 'view' THEN ' ' || CAST(k AS STRING) || '%|###| ' || CAST(k AS STRING) || '/'
                 || CAST(100 - k % 2 AS STRING) || ' [00:01<00:01, 2.0it/s]'
            WHEN event_type = 'click' THEN '{' || chr(39) || 'loss' || chr(39) || ': ' || chr(39) || CAST(value AS STRING) || chr(39)
                 || ', ' || chr(39) || 'epoch' || chr(39) || ': ' || chr(39) || '0.5' || chr(39) || '}'
            WHEN event_type = 'error' AND k % 6 = 0 THEN 'Traceback (most recent call last):'
            WHEN event_type = 'error' AND k % 6 = 1 THEN 'RuntimeError: step failed'
            WHEN event_type = 'error' THEN 'ERROR step failed token=abc' || CAST(k AS STRING)
            WHEN event_type = 'purchase' THEN 'WARNING low memory'
            WHEN k % 4 = 0 THEN 'Num examples = ' || CAST(k AS STRING)
            WHEN k % 4 = 1 THEN chr(27) || '[32mTraining completed' || chr(27) || '[0m'
            WHEN k % 4 = 2 THEN '' ELSE 'INFO loading cache' END AS line
FROM e
"""

JOBS_SQL = """
SELECT p_partkey AS job_id, CAST(p_size AS BIGINT) * 490000000 AS parameter_count,
       CASE WHEN p_partkey % 2 = 0 THEN 'bf16' ELSE 'fp32' END AS precision_name,
       CASE WHEN p_partkey % 5 = 0 THEN 'full' ELSE 'lora' END AS method,
       1 + p_partkey % 8 AS batch_size, 512 * (1 + p_partkey % 4) AS cutoff_len,
       p_partkey % 3 = 0 AS gradient_checkpointing
FROM part
"""

GPUS_SQL = """
SELECT s_suppkey AS gpu_index, CAST(81920 AS BIGINT) AS total_mib,
       CAST(least(61440, floor(abs(s_acctbal) * 8)) AS BIGINT) AS free_mib, CAST(s_suppkey * 37 % 101 AS BIGINT) AS position
FROM supplier
"""

RUNS_SQL = """
SELECT o_orderkey AS run_id, o_orderdate AS created_at, o_custkey AS pipeline_id,
       CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'training' ELSE 'failed' END AS status
FROM orders
"""

FILES_SQL = """
SELECT l_orderkey AS run_id,
       CASE l_linenumber WHEN 1 THEN 'model/adapter_config.json' WHEN 2 THEN 'model/adapter_model.safetensors'
            WHEN 3 THEN 'model/config.json' WHEN 4 THEN 'model/model-00001-of-00002.safetensors'
            WHEN 5 THEN 'model/checkpoint-1/trainer_state.json' ELSE 'logs/train.log' END AS rel_path,
       CASE WHEN l_returnflag = 'R' AND l_linenumber = 2 THEN CAST(0 AS BIGINT)
            ELSE CAST(floor(l_quantity) AS BIGINT) * 1000 END AS size
FROM lineitem
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run derived-input SQL; every given table it names is passed as a DataFrame."""
    used = {name: table(spark, sf_dir, name) for name in TABLES if re.search(rf"(?:FROM|JOIN) {name}\b", sql)}
    text = sql.replace("{", "{{").replace("}", "}}")
    for name in used:
        text = re.sub(rf"(FROM|JOIN) {name}\b", rf"\1 {{{name}}}", text)
    return spark.sql(text, **used)


def write_files(df: DataFrame, keys: list[str], folder: str) -> None:
    """A text file ``<key>=<value>/part-00000.txt`` per distinct keys, of the lines in ``value``, like ``partitionBy(keys).text``.

    Files are small and many: the tasks write them in place, so that no driver has to move them afterwards.
    """
    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (row for batch in batches for row in batch.itertuples(index=False, name=None))
        for names, lines in groupby(rows, lambda row: row[:-1]):
            place = "/".join(f"{k}={'__HIVE_DEFAULT_PARTITION__' if n is None else quote(n, safe=' ')}" for k, n in zip(keys, names))
            write_bytes(f"{folder}/{place}/part-00000.txt", "".join(f"{line or ''}\n" for *_, line in lines).encode())
        yield pd.DataFrame({"done": pd.Series([], dtype="int64")})

    parts = df.select(*[F.col(k).cast("string").alias(k) for k in keys], "value").repartition(*keys).sortWithinPartitions(*keys)
    parts.mapInPandas(put, "done bigint").agg(F.count("done")).collect()


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.col("text").alias("content"))


def numbered(df: DataFrame, key: str, order: str, name: str, block: int) -> DataFrame:
    """1-based position within a key, counted per block of the order column (a key may be any size)."""
    return running_total(df, [key], order, F.lit(1), "_before", block).withColumn(name, F.col("_before") + 1).drop("_before")


def dataset_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ROWS_SQL without its one-task-per-source window."""
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("dataset_id"), "doc_id", "lang", "text")
    ds = F.substring("dataset_id", 4, 10).cast("int")
    rows = numbered(docs, "dataset_id", "doc_id", "row_index", 100_000).withColumn("ds", ds)
    i, d = F.col("row_index"), F.col("ds")
    fault = (
        F.when((d % 4 == 3) & (i == 3), "missing_answer").when((d % 4 == 1) & (i == 30), "missing_answer")
        .when(i % 13 == 5, "blank_answer").when(i % 17 == 9, "null_context").when(i % 19 == 11, "number_answer")
        .otherwise("ok")
    )
    return rows.select(
        "dataset_id", "ds", (d % 9).alias("fmt"), "row_index",
        F.concat(F.lit("Describe item "), F.col("doc_id").cast("string")).alias("q"),
        F.col("lang").alias("ctx"), F.col("text").alias("ans"), fault.alias("fault"),
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LOG_SQL without its one-task-per-run window: (run_id, seq, line, cr, k, event_type, value)."""
    six_hours = 6 * 3600 * 1_000_000
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"), "event_type", "value", F.unix_micros(F.col("ts").cast("timestamp")).alias("_at"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )
    e = numbered(events, "run_id", "_at", "seq", six_hours).drop("_at")
    body = LOG_SQL.split("k % 3 = 0 AS cr,")[1].split(" AS line")[0]
    return e.select("*", F.expr("k % 3 = 0").alias("cr"), F.expr(body).alias("line"))


def log_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same log as chunks that cut every line in two: (run_id, chunk_no, text)."""
    whole = F.concat("line", F.when(F.col("cr"), "\r").otherwise("\n"))
    half = F.floor(F.length("_text") / 2).cast("int")
    parts = F.array(
        F.struct(F.col("seq").alias("chunk_no"), F.lit(1).alias("part"), F.left("_text", half).alias("t")),
        F.struct((F.col("seq") + 1).alias("chunk_no"), F.lit(0).alias("part"), F.substr("_text", half + 1).alias("t")),
    )
    pieces = log_lines(spark, sf_dir).withColumn("_text", whole).select("run_id", F.inline(parts))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "t"))), lambda x: x["t"]), "")
    return pieces.groupBy("run_id", "chunk_no").agg(joined.alias("text"))


def _json(**fields) -> F.Column:
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]), {"ignoreNullFields": "false"})


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty datasets of nine formats as JSON text, with planted faults."""
    rows = dataset_rows(spark, sf_dir)
    fault, fmt, q = F.col("fault"), F.col("fmt"), F.col("q")
    missing, number = fault == "missing_answer", fault == "number_answer"
    ans = F.when(fault == "blank_answer", F.lit(" ")).otherwise(F.col("ans"))
    ctx = F.when(fault == "null_context", F.lit(None).cast("string")).otherwise(F.col("ctx"))

    def answered(key: str, *before: tuple[str, F.Column]) -> F.Column:
        named = {k: c for k, c in before}
        return (F.when(missing, _json(**named)).when(number, _json(**named, **{key: F.lit(7)}))
                .otherwise(_json(**named, **{key: ans})))

    def turn(role_key: str, role: F.Column, text_key: str, text: F.Column) -> F.Column:
        return _json(**{role_key: role, text_key: text})

    def chat(field: str, role_key: str, text_key: str, names: tuple[str, str, str]) -> F.Column:
        reply = F.when(missing, _json(**{role_key: F.lit(names[2])})).when(
            number, _json(**{role_key: F.lit(names[2]), text_key: F.lit(7)})).otherwise(
            turn(role_key, F.lit(names[2]), text_key, ans))
        return F.concat(F.lit('{"' + field + '":['), turn(role_key, F.lit(names[0]), text_key, ctx), F.lit(","),
                        turn(role_key, F.lit(names[1]), text_key, q), F.lit(","), reply, F.lit("]}"))

    def marked(role: str, text: F.Column, close: F.Column) -> F.Column:
        return F.concat(F.lit(f"<|im_start|>{role}\n"), text, close)

    end = F.lit("<|im_end|>\n")
    chatml = _json(text=F.concat(
        marked("system", F.coalesce(ctx, F.lit("")), end), marked("user", q, end),
        marked("assistant", F.when(number, "7").otherwise(ans), F.when(missing, F.lit("")).otherwise(end)),
    ))
    with_context = (F.col("ds") >= 9) & (F.col("row_index") % 2 == 0)
    raw = (
        F.when(fmt == 0, answered("output", ("instruction", q), ("input", ctx)))
        .when(fmt == 1, answered("response", ("instruction", q), ("input", ctx)))
        .when(fmt == 2, answered("completion", ("prompt", q), ("input", ctx)))
        .when((fmt == 3) & with_context, answered("answer", ("question", q), ("context", ctx)))
        .when(fmt == 3, answered("answer", ("question", q)))
        .when(fmt == 4, answered("answer", ("context", ctx), ("question", q)))
        .when(fmt == 5, chat("messages", "role", "content", ("system", "user", "assistant")))
        .when(fmt == 6, chat("conversations", "from", "value", ("system", "human", "gpt")))
        .when(fmt == 7, chatml)
        .otherwise(answered("chosen", ("prompt", q), ("rejected", F.concat(q, F.lit(" ?")))))
    )
    return rows.select("dataset_id", "row_index", raw.alias("raw"))


def row_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_row_model(raw_rows(spark, sf_dir))
