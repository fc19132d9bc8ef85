"""Training-log and redaction queries over lines derived from ``events`` and over ``documents``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sft_tables.operators import logs, redact
from sft_tables.plans import fixtures
from sft_tables.plans.fixtures import LOG_SQL

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


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.log_lines(spark, sf_dir).select("run_id", "seq", "cr", "line")


CLEAN = r"trim(regexp_replace(line, '\x1b\[[0-?]*[ -/]*[@-~]', '', 'g'))"
TAGGED = rf"""
raw AS ({LOG_SQL}),
c AS (SELECT run_id, seq, cr, {CLEAN} AS line FROM raw),
f AS (SELECT *, line = '' AS blank, starts_with(line, 'Traceback (most recent call last):') AS tb_start,
        regexp_matches(line, '^[\w.]+(Error|Exception):') AS tb_end, regexp_matches(line, '(?i)\b(ERROR|CRITICAL)\b') AS important,
        regexp_matches(line, '(?i)\bWARNING\b') AS warning FROM c),
tb AS (SELECT *, tb_start OR coalesce(last_value(CASE WHEN tb_start THEN true WHEN tb_end OR (blank AND NOT cr) THEN false END IGNORE NULLS)
         OVER (PARTITION BY run_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS in_traceback FROM f),
m AS (SELECT *, CASE WHEN blank OR in_traceback OR important OR warning THEN NULL
        WHEN contains(line, '***** Running training *****') THEN 'train' WHEN contains(line, '***** train metrics *****') THEN 'table'
        WHEN regexp_matches(line, '(?i)\bTraining completed\b') THEN 'none' END AS marker FROM tb),
p AS (SELECT *, last_value(marker IGNORE NULLS) OVER w AS state,
        last_value(CASE WHEN marker IS NOT NULL THEN seq END IGNORE NULLS) OVER w AS state_seq
      FROM m WINDOW w AS (PARTITION BY run_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT run_id, seq, cr, line, blank, in_traceback, important, warning, marker, nullif(state, 'none') AS phase,
        CASE WHEN state <> 'none' THEN state_seq END AS phase_seq FROM p),
k AS (SELECT *, CASE WHEN blank THEN 'blank' WHEN in_traceback OR important THEN 'error' WHEN warning THEN 'warning'
        WHEN marker = 'train' THEN 'phase_start' WHEN marker = 'table' THEN 'phase_summary' WHEN marker = 'none' THEN 'phase_done'
        WHEN phase = 'table' THEN 'final_table'
        WHEN phase = 'train' AND regexp_matches(line, '\d+\s*/\s*\d+') AND (contains(line, '%') OR contains(line, 'it/s')) THEN 'progress'
        WHEN phase = 'train' AND starts_with(line, '{{') THEN 'metrics'
        WHEN phase = 'train' AND regexp_matches(line, '(?i)(Num examples|Num Epochs|Total optimization steps)\s*=') THEN 'detail'
        ELSE 'noise' END AS kind FROM t),
g AS (SELECT *, CASE WHEN kind = 'progress' THEN CAST(regexp_extract(line, '(\d+)\s*/\s*(\d+)', 1) AS BIGINT) END AS current,
        CASE WHEN kind = 'progress' THEN CAST(regexp_extract(line, '(\d+)\s*/\s*(\d+)', 2) AS BIGINT) END AS total FROM k)
""".replace("{{", "{")

THROTTLED = f"""
{TAGGED},
d0 AS (SELECT *, lag(current) OVER (PARTITION BY run_id, phase_seq ORDER BY seq) AS pc,
         lag(total) OVER (PARTITION BY run_id, phase_seq ORDER BY seq) AS pt FROM g WHERE kind = 'progress'),
d AS (SELECT *, row_number() OVER (PARTITION BY run_id, phase_seq ORDER BY seq) AS i FROM d0
      WHERE pc IS NULL OR pc <> current OR pt <> total),
fold AS (
  SELECT run_id, phase_seq, i, seq, current, total,
    current = total OR current >= greatest(1, total // 20) AS shown,
    CASE WHEN current = total OR current >= greatest(1, total // 20) THEN current ELSE 0 END AS last
  FROM d WHERE i = 1
  UNION ALL
  SELECT d.run_id, d.phase_seq, d.i, d.seq, d.current, d.total,
    d.current = d.total OR d.current >= fold.last + greatest(1, d.total // 20),
    CASE WHEN d.current = d.total OR d.current >= fold.last + greatest(1, d.total // 20) THEN d.current ELSE fold.last END
  FROM fold JOIN d ON d.run_id = fold.run_id AND d.phase_seq = fold.phase_seq AND d.i = fold.i + 1)
"""


@register("split_records", f"SELECT run_id, seq, line, cr FROM ({LOG_SQL}) WHERE NOT (cr AND line = '')")
def q_split(spark, sf_dir):
    return logs.split_records(fixtures.log_chunks(spark, sf_dir))


@register("strip_ansi", f"SELECT run_id, seq, {CLEAN} AS line FROM ({LOG_SQL})")
def q_ansi(spark, sf_dir):
    return records(spark, sf_dir).select("run_id", "seq", logs.strip_ansi(F.col("line")).alias("line"))


@register("traceback_blocks", f"WITH {TAGGED} SELECT run_id, seq, in_traceback FROM tb")
def q_traceback(spark, sf_dir):
    return logs.tag_records(records(spark, sf_dir)).select("run_id", "seq", "in_traceback")


@register("tag_phase", f"WITH {TAGGED} SELECT run_id, seq, phase, phase_seq FROM t")
def q_phase(spark, sf_dir):
    return logs.tag_records(records(spark, sf_dir)).select("run_id", "seq", "phase", "phase_seq")


@register("classify_records", f"WITH {TAGGED} SELECT run_id, seq, kind FROM k")
def q_classify(spark, sf_dir):
    return logs.classify(records(spark, sf_dir)).select("run_id", "seq", "kind")


@register("parse_progress", f"WITH {TAGGED} SELECT run_id, seq, current, total FROM g WHERE kind = 'progress'")
def q_progress(spark, sf_dir):
    return logs.classify(records(spark, sf_dir)).filter("kind = 'progress'").select(
        "run_id", "seq", "progress.current", "progress.total")


@register("throttle_progress", f"""WITH RECURSIVE {THROTTLED} SELECT run_id, phase_seq, seq, current, total,
  CAST(round_even(100.0 * current / total, 0) AS BIGINT) AS percent FROM fold WHERE shown""")
def q_throttle(spark, sf_dir):
    lines = records(spark, sf_dir)
    return logs.throttle_progress(logs.classify(lines))


METRIC_ORACLE = "TRY_CAST(regexp_extract(line, '''loss'': ''([^'']*)''', 1) AS DOUBLE)"


@register("parse_metrics", f"""WITH raw AS ({LOG_SQL}) SELECT run_id, seq, {METRIC_ORACLE} AS loss, CAST(0.5 AS DOUBLE) AS epoch,
  CAST(NULL AS DOUBLE) AS learning_rate FROM raw WHERE starts_with(line, '{{')""".replace("{{", "{"))
def q_metrics(spark, sf_dir):
    return logs.parse_metrics(records(spark, sf_dir)).select("run_id", "seq", "loss", "epoch", "learning_rate")


# the loss as the console shows it; the epoch is 0.5 in all of these lines
METRIC_TEXT = f"""coalesce('Step ' || step || ' | ', '') || 'Epoch 0.5 | Loss ' || CASE WHEN {METRIC_ORACLE} IS NULL
  THEN regexp_extract(line, '''loss'': ''([^'']*)''', 1) ELSE format('{{:.4g}}', {METRIC_ORACLE}) END"""
STEPPED = """s AS (SELECT *, last_value(CASE WHEN kind = 'progress' THEN current || '/' || total END IGNORE NULLS)
    OVER (PARTITION BY run_id, phase_seq ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS step FROM g)"""


@register("format_metrics", f"WITH {TAGGED}, {STEPPED} SELECT run_id, seq, {METRIC_TEXT} AS text FROM s WHERE kind = 'metrics'")
def q_format(spark, sf_dir):
    return logs.metric_lines(logs.classify(records(spark, sf_dir))).select("run_id", "seq", "text")


@register("filter_verbosity_quiet", f"WITH {TAGGED} SELECT run_id, seq, line AS text FROM k WHERE kind = 'error'")
def q_quiet(spark, sf_dir):
    return logs.filter_verbosity(records(spark, sf_dir), "quiet")


@register("filter_verbosity_full", f"SELECT run_id, seq, line AS text FROM ({LOG_SQL})")
def q_full(spark, sf_dir):
    return logs.filter_verbosity(records(spark, sf_dir), "full")


@register("filter_verbosity_concise", f"""WITH RECURSIVE {THROTTLED}, {STEPPED},
  shown AS (SELECT run_id, seq FROM k WHERE kind IN ('error', 'warning', 'phase_start', 'detail', 'metrics')
            UNION ALL SELECT run_id, seq FROM fold WHERE shown)
  SELECT x.run_id, x.seq, CASE s.kind WHEN 'progress' THEN 'Progress: ' || current || '/' || total || ' ('
      || CAST(round_even(100.0 * current / total, 0) AS BIGINT) || '%)'
    WHEN 'metrics' THEN {METRIC_TEXT} ELSE line END AS text FROM shown x JOIN s ON s.run_id = x.run_id AND s.seq = x.seq""")
def q_concise(spark, sf_dir):
    return logs.filter_verbosity(records(spark, sf_dir), "concise")


LIFECYCLE = """SELECT o_orderkey AS run_id,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'ERROR' WHEN o_orderpriority = '2-HIGH' THEN 'WARNING' ELSE 'INFO' END AS level,
  CASE o_orderstatus WHEN 'F' THEN 'Run completed successfully' WHEN 'O' THEN 'Starting LLaMA-Factory training' ELSE 'Resolving model' END AS message
  FROM orders"""


@register("quiet_lifecycle", f"SELECT run_id, level, message FROM ({LIFECYCLE}) WHERE level <> 'INFO' OR message <> 'Resolving model'")
def q_lifecycle(spark, sf_dir):
    return logs.quiet_lifecycle(fixtures.view(spark, sf_dir, LIFECYCLE))


@register("run_log_summary", f"""WITH {TAGGED} SELECT run_id, count(*) FILTER (WHERE kind = 'error') AS errors,
   count(*) FILTER (WHERE kind = 'warning') AS warnings, arg_max(current, seq) FILTER (WHERE kind = 'progress') AS last_step,
   arg_max({METRIC_ORACLE}, seq) FILTER (WHERE kind = 'metrics') AS last_loss,
   coalesce(bool_or(kind IN ('phase_summary', 'phase_done')), false) AS completed FROM g GROUP BY run_id""")
def q_summary(spark, sf_dir):
    return logs.run_log_summary(records(spark, sf_dir))


# ---- redaction ----------------------------------------------------------------------------------------------
S = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NOT_S = "[^" + S[1:-1]


def sql_redact(expr: str) -> str:
    bearer = rf"(?i)(authorization{S}*[:=]{S}*bearer{S}+){NOT_S},;]+"
    assigned = rf"""(?i)((?:api[_-]?key|token|secret|password){S}*[:=]{S}*)[''"]?{NOT_S},''";}}]+"""
    return f"regexp_replace(regexp_replace({expr}, '{bearer}', '\\1<redacted>', 'g'), '{assigned}', '\\1<redacted>', 'g')"


@register("redact_text", f"SELECT doc_id, md5({sql_redact('text')}) AS text FROM documents")
def q_redact(spark, sf_dir):
    docs = fixtures.table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.md5(redact.redact_text(F.col("text"))).alias("text"))


@register("redact_log", f"SELECT run_id, seq, {sql_redact(chr(114) + 'eplace(line, ' + chr(39) + 'abc1' + chr(39) + ', ' + chr(39) + '<redacted>' + chr(39) + ')')} AS line FROM ({LOG_SQL})")
def q_redact_log(spark, sf_dir):
    return redact.redact_columns(records(spark, sf_dir).drop("cr"), ["line"], ["abc1"])


@register("redact_pages", f"SELECT page_id, md5({sql_redact('html')}) AS html FROM pages")
def q_redact_pages(spark, sf_dir):
    return fixtures.table(spark, sf_dir, "pages").select("page_id", F.md5(redact.redact_text(F.col("html"))).alias("html"))


def configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested settings with references and literal credentials."""
    c = fixtures.table(spark, sf_dir, "customer")
    ref = F.col("c_custkey") % 3 == 0
    key = F.when(ref, F.lit(" ${GATEWAY_KEY} ")).otherwise(F.concat(F.lit("sk-"), "c_name"))
    return c.select(
        F.col("c_custkey").alias("config_id"),
        F.struct(
            key.alias("api_key"), F.col("c_name").alias("name"),
            F.struct(F.col("c_nationkey").alias("max_tokens"), F.col("c_mktsegment").alias("hf-token"),
                     F.col("c_nationkey").alias("client_secret")).alias("inner"),
        ).alias("gateway"),
        F.create_map(F.lit("Authorization"), F.concat(F.lit("Bearer "), "c_name"), F.lit("eos_token"), F.lit("</s>"),
                     F.lit("db password"), F.when(ref, "${DB}").otherwise("x")).alias("headers"),
        F.array(F.struct(F.col("c_name").alias("password"), F.col("c_mktsegment").alias("tokenizer"))).alias("users"),
        F.create_map(F.lit("password"), F.struct(F.col("c_name").alias("v")), F.lit("team"), F.struct(F.col("c_mktsegment").alias("v"))).alias("accounts"),
        F.create_map(F.lit("token"), F.col("c_nationkey"), F.lit("max_tokens"), F.col("c_nationkey")).alias("sessions"),
    )


@register("redact_data", """SELECT c_custkey AS config_id, CASE WHEN c_custkey % 3 = 0 THEN ' ${GATEWAY_KEY} ' ELSE '<redacted>' END AS api_key,
  c_name AS name, c_nationkey AS max_tokens, '<redacted>' AS hf_token, '<redacted>' AS client_secret, '<redacted>' AS authorization_header,
  '</s>' AS eos_token, CASE WHEN c_custkey % 3 = 0 THEN '${DB}' ELSE '<redacted>' END AS db_password, '<redacted>' AS user_password,
  c_mktsegment AS tokenizer, '{"password":"<redacted>","team":{"v":"' || c_mktsegment || '"}}' AS accounts,
  '{"max_tokens":' || c_nationkey || ',"token":"<redacted>"}' AS sessions FROM customer""")
def q_redact_data(spark, sf_dir):
    d = redact.redact_data(configs(spark, sf_dir))
    return d.select(
        "config_id", "gateway.api_key", "gateway.name", "gateway.inner.max_tokens", F.col("gateway.inner.`hf-token`").alias("hf_token"),
        "gateway.inner.client_secret", F.col("headers")["Authorization"].alias("authorization_header"),
        F.col("headers")["eos_token"].alias("eos_token"), F.col("headers")["db password"].alias("db_password"),
        F.col("users")[0]["password"].alias("user_password"), F.col("users")[0]["tokenizer"].alias("tokenizer"),
        F.to_json(F.to_variant_object("accounts")).alias("accounts"), F.to_json(F.to_variant_object("sessions")).alias("sessions"))


@register("redact_json", """SELECT c_custkey AS config_id, '{"gateway":{"api_key":"' || CASE WHEN c_custkey % 3 = 0 THEN ' ${GATEWAY_KEY} ' ELSE '<redacted>' END
  || '","name":"' || c_name || '","inner":{"max_tokens":' || c_nationkey || ',"hf-token":"<redacted>","client_secret":"<redacted>"}}}' AS config FROM customer""")
def q_redact_json(spark, sf_dir):
    text = F.to_json(F.struct("gateway"))
    return configs(spark, sf_dir).select("config_id", redact.redact_json(text).alias("config"))


KEY_CASE = """CASE p_size % 10 WHEN 0 THEN 'api-key' WHEN 1 THEN 'Master Key' WHEN 2 THEN 'max_tokens' WHEN 3 THEN 'eos_token'
  WHEN 4 THEN 'my.refresh.token' WHEN 5 THEN 'tokenizer' WHEN 6 THEN ' PASSWORD ' WHEN 7 THEN 'db_private-key' WHEN 8 THEN 'secretary'
  ELSE 'hf_token' END"""


@register("is_sensitive_key", "SELECT p_partkey, p_size % 10 IN (0, 1, 4, 6, 7, 9) AS sensitive FROM part")
def q_sensitive(spark, sf_dir):
    part = fixtures.table(spark, sf_dir, "part")
    return part.select("p_partkey", redact.sensitive_key(F.expr(KEY_CASE)).alias("sensitive"))


@register("literal_secret_audit", """SELECT c_custkey AS config_id, unnest(CASE WHEN c_custkey % 3 = 0
    THEN ['gateway.inner.hf-token', 'gateway.inner.client_secret', 'headers.Authorization', 'users[0].password', 'accounts.password', 'sessions.token']
    ELSE ['gateway.api_key', 'gateway.inner.hf-token', 'gateway.inner.client_secret', 'headers.Authorization', 'headers.db password',
          'users[0].password', 'accounts.password', 'sessions.token'] END) AS path
  FROM customer""")
def q_audit(spark, sf_dir):
    return redact.literal_secret_audit(configs(spark, sf_dir), ["config_id"])


@register("redacted_error", f"""SELECT doc_id, 'ValueError' AS type,
   CASE WHEN m = '' THEN 'ValueError' ELSE m END AS message FROM (SELECT doc_id, substr(regexp_replace(
     regexp_replace(regexp_replace({sql_redact("'token=abc ' || text")}, '^{S}+', ''), '{S}+$', ''), '{S}+', ' ', 'g'), 1, 240) AS m FROM documents)""")
def q_error(spark, sf_dir):
    docs = fixtures.table(spark, sf_dir, "documents")
    e = redact.redacted_error(F.lit("ValueError"), F.concat(F.lit("token=abc "), "text"))
    return docs.select("doc_id", e.alias("e")).select("doc_id", "e.*")
