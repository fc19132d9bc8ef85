"""Run-record, artifact and ownership queries over ``orders``, ``lineitem``, ``customer`` and ``events``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sft_tables.operators import digests, runs
from sft_tables.plans import fixtures
from sft_tables.plans.fixtures import FILES_SQL, RUNS_SQL

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


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    return fixtures.view(spark, sf_dir, sql)


# ---- run ids --------------------------------------------------------------------------------------------
REQUESTS_SQL = """SELECT o_orderkey AS request_id, o_orderdate AS created_at,
   CASE o_custkey % 3 WHEN 0 THEN 'Qwen/Qwen2.5-0.5B-Instruct' WHEN 1 THEN '__' ELSE 'a/b/Llama 3' END AS model_name,
   CASE WHEN o_orderpriority = '1-URGENT' THEN '' ELSE 'Set ' || o_orderpriority || '!' END AS dataset_name FROM orders"""
SLUG = "coalesce(nullif(trim(regexp_replace(lower({c}), '[^a-z0-9]+', '-', 'g'), '-'), ''), '{f}')"
MODEL_SLUG = "substr(" + SLUG.format(c="split_part(model_name, '/', -1)", f="model") + ", 1, 48)"
DATASET_SLUG = "substr(" + SLUG.format(c="dataset_name", f="dataset") + ", 1, 48)"
BASED = f"SELECT request_id, strftime(created_at, '%Y%m%d_%H%M%S') || '_' || {MODEL_SLUG} || '_' || {DATASET_SLUG} AS base_id FROM ({REQUESTS_SQL})"


@register("assign_run_ids", f"""WITH b AS ({BASED}),
  r AS (SELECT *, row_number() OVER (PARTITION BY base_id ORDER BY request_id) AS k, count(*) OVER (PARTITION BY base_id) AS n FROM b),
  held AS (SELECT DISTINCT base_id, CASE request_id % 7 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 4 END AS attempt FROM b WHERE request_id % 7 IN (0, 1, 2)),
  free AS (SELECT base_id, attempt, row_number() OVER (PARTITION BY base_id ORDER BY attempt) AS k
           FROM (SELECT base_id, unnest(range(1, max(n) + 5)) AS attempt FROM r GROUP BY base_id) ANTI JOIN held USING (base_id, attempt))
  SELECT request_id, base_id, attempt, CASE attempt WHEN 1 THEN base_id ELSE base_id || '_' || printf('%02d', attempt) END AS run_id
  FROM r JOIN free USING (base_id, k)""")
def q_ids(spark, sf_dir):
    requests = view(spark, sf_dir, REQUESTS_SQL)
    base = runs.base_run_id(F.col("created_at"), F.col("model_name"), F.col("dataset_name"))
    held = requests.withColumn("m", F.col("request_id") % 7).filter("m < 3").select(
        F.concat(base, F.when(F.col("m") == 0, "").when(F.col("m") == 1, "_02").otherwise("_04")).alias("run_id"))
    return runs.assign_run_ids(requests, held)


# ---- status ---------------------------------------------------------------------------------------------
STATUS_SQL = """SELECT user_id AS run_id, ts, event_id AS seq, CASE event_type WHEN 'view' THEN 'training' WHEN 'click' THEN 'verifying'
   WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'failed' ELSE 'prepared' END AS status FROM events"""
PHASE_SQL = """SELECT user_id AS run_id, CASE event_id % 3 WHEN 0 THEN 'training' WHEN 1 THEN 'serving' ELSE 'gateway' END AS phase, event_id AS seq,
   CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
   CASE WHEN event_type = 'error' THEN 'RuntimeError' END AS error_type, CASE WHEN event_type = 'error' THEN 'value ' || CAST(event_id AS STRING) END AS error_message,
   event_type AS detail_key, CAST(event_id AS STRING) AS detail_value FROM events"""


def phase_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = view(spark, sf_dir, PHASE_SQL)
    return e.withColumn("details", F.when(F.col("detail_key") != "view", F.create_map("detail_key", "detail_value"))).drop("detail_key", "detail_value")


@register("run_status_latest", f"""SELECT run_id, arg_max(status, seq) AS status, max(ts) AS updated_at,
  max(CASE WHEN status IN ('success', 'failed') THEN ts END) AS completed_at FROM ({STATUS_SQL}) GROUP BY run_id""")
def q_status(spark, sf_dir):
    return runs.run_status_latest(view(spark, sf_dir, STATUS_SQL))


@register("phase_status", f"""WITH e AS ({PHASE_SQL}),
  d AS (SELECT run_id, phase, string_agg(detail_key || '=' || v, ',' ORDER BY detail_key) AS details FROM
    (SELECT run_id, phase, detail_key, arg_max(detail_value, seq) AS v FROM e WHERE detail_key <> 'view' GROUP BY ALL) GROUP BY run_id, phase)
  SELECT run_id, phase, status, error_type, error_message, details FROM
   (SELECT run_id, phase, arg_max(status, seq) AS status, arg_max(error_type, seq) FILTER (WHERE error_type IS NOT NULL) AS error_type,
      arg_max(error_message, seq) FILTER (WHERE error_type IS NOT NULL) AS error_message FROM e GROUP BY run_id, phase) LEFT JOIN d USING (run_id, phase)""")
def q_phase(spark, sf_dir):
    s = runs.phase_status(phase_events(spark, sf_dir))
    pairs = F.array_sort(F.transform(F.map_entries("details"), lambda x: F.concat(x["key"], F.lit("="), x["value"])))
    return s.withColumn("details", F.when(F.col("details").isNotNull(), F.array_join(pairs, ",")))


PIVOT = "SELECT run_id, " + ", ".join(f"arg_max(status, seq) FILTER (WHERE phase = '{p}') AS {p}" for p in ("training", "serving", "gateway"))


@register("phase_pivot", f"{PIVOT} FROM ({PHASE_SQL}) GROUP BY run_id")
def q_pivot(spark, sf_dir):
    return runs.phase_pivot(phase_events(spark, sf_dir))


@register("run_outcome", f"""SELECT run_id, CASE WHEN coalesce(training, '') <> 'success' THEN 'Training failed' WHEN serving = 'failed' THEN 'Training succeeded; serving failed'
   WHEN gateway = 'failed' THEN 'Training and serving succeeded; gateway failed' ELSE 'Success' END AS outcome FROM ({PIVOT} FROM ({PHASE_SQL}) GROUP BY run_id)""")
def q_outcome(spark, sf_dir):
    return runs.run_outcome(runs.phase_pivot(phase_events(spark, sf_dir)))


HANDOFF_SQL = """SELECT user_id AS run_id, CASE WHEN value > 100 THEN 'gateway' ELSE 'serving' END AS source, 'manifest-' || CAST(event_id AS STRING) AS manifest,
   event_id AS seq FROM events"""


@register("preferred_handoff", f"SELECT run_id, arg_max(source, (source = 'gateway', seq)) AS source, arg_max(manifest, (source = 'gateway', seq)) AS manifest FROM ({HANDOFF_SQL}) GROUP BY run_id")
def q_handoff(spark, sf_dir):
    return runs.preferred_handoff(view(spark, sf_dir, HANDOFF_SQL))


# ---- metrics --------------------------------------------------------------------------------------------
def metric_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to three documents per order; some values are missing, boolean or text, some documents are broken."""
    o = fixtures.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("run_id"), "o_totalprice", "o_custkey")
    k, price = F.col("run_id"), F.col("o_totalprice")
    results = F.when(k % 4 == 0, F.to_json(F.struct(price.alias("train_loss"), F.lit(True).alias("epoch")))).when(
        k % 4 == 1, F.to_json(F.struct(F.lit("n/a").alias("train_loss"), F.col("o_custkey").alias("train_runtime")))).when(k % 4 == 2, "[1]").otherwise("{")
    everything = F.to_json(F.struct((price * 2).alias("train_loss"), F.lit(2.5).alias("epoch")))
    history = F.array(*[F.struct(F.lit(i).alias("step"), (price / i).alias("loss"), F.lit(i / 2).alias("epoch")) for i in (1, 2)])
    state = F.to_json(F.struct((price * 3).alias("train_loss"), F.lit(3.0).alias("epoch"), k.alias("global_step"), history.alias("log_history")))
    docs = F.array(
        F.struct(F.lit("train_results.json").alias("file_name"), results.alias("raw")),
        F.struct(F.lit("all_results.json").alias("file_name"), F.when(k % 3 == 0, everything).alias("raw")),
        F.struct(F.lit("trainer_state.json").alias("file_name"), F.when(k % 5 != 0, state).alias("raw")),
    )
    return o.select("run_id", F.inline(docs)).filter("raw IS NOT NULL")


METRICS = """
m AS (SELECT o_orderkey AS run_id, o_totalprice AS p, o_custkey, o_orderkey % 4 AS a, o_orderkey % 3 = 0 AS b, o_orderkey % 5 <> 0 AS c FROM orders)
"""


@register("training_metrics", f"""WITH {METRICS} SELECT run_id,
   CASE WHEN a = 0 THEN p WHEN b THEN p * 2 WHEN c THEN p * 3 END AS train_loss, CASE WHEN a = 1 THEN CAST(o_custkey AS DOUBLE) END AS train_runtime,
   CAST(CASE WHEN b THEN 2.5 WHEN c THEN 3.0 END AS DOUBLE) AS final_epoch, CASE WHEN c THEN CAST(run_id AS DOUBLE) END AS global_step,
   concat_ws(',', CASE WHEN a IN (0, 1) THEN 'train_results.json' END, CASE WHEN b THEN 'all_results.json' END, CASE WHEN c THEN 'trainer_state.json' END) AS source_artifacts,
   CASE WHEN c THEN 'trainer_state.json' END AS log_history_artifact, CASE WHEN a IN (2, 3) THEN CAST(1 AS BIGINT) ELSE CAST(0 AS BIGINT) END AS unreadable_documents FROM m""")
def q_metrics(spark, sf_dir):
    return runs.training_metrics(metric_documents(spark, sf_dir)).select(
        "run_id", "train_loss", "train_runtime", "final_epoch", "global_step", F.array_join("source_artifacts", ",").alias("source_artifacts"),
        "log_history_artifact", "unreadable_documents")


@register("metric_history", f"""WITH {METRICS} SELECT run_id, CAST(i - 1 AS BIGINT) AS entry, CAST(i AS BIGINT) AS step, CAST(i AS DOUBLE) / 2 AS epoch, p / i AS loss
  FROM m, (SELECT unnest([1, 2]) AS i) WHERE c""")
def q_history(spark, sf_dir):
    states = metric_documents(spark, sf_dir).filter("file_name = 'trainer_state.json'")
    return runs.metric_history(states).select("run_id", "entry", "step", "epoch", "loss")


@register("metric_curves", f"""WITH {METRICS}, h AS (SELECT run_id, CAST(i - 1 AS BIGINT) AS entry, CAST(i AS BIGINT) AS step, p / i AS loss FROM m, (SELECT unnest([1, 2]) AS i) WHERE c)
  SELECT run_id, entry, step, loss, loss - lag(loss) OVER w AS change, min(loss) OVER w AS best_loss, arg_min(step, loss) OVER w AS best_step
  FROM h WINDOW w AS (PARTITION BY run_id ORDER BY entry)""")
def q_curves(spark, sf_dir):
    states = metric_documents(spark, sf_dir).filter("file_name = 'trainer_state.json'")
    return runs.metric_curves(runs.metric_history(states))


REPORT_SQL = """SELECT o_orderkey AS run_id, 'base-' || CAST(o_custkey AS STRING) AS model_name, 3 AS epochs, CAST(0.0001 AS DOUBLE) AS learning_rate,
   CAST(2 AS BIGINT) AS batch_size, CAST(2048 AS BIGINT) AS cutoff_len, CASE WHEN o_orderkey % 2 = 0 THEN CAST(8 AS BIGINT) END AS lora_rank,
   CAST(16 AS BIGINT) AS lora_alpha, CAST(0.1 AS DOUBLE) AS lora_dropout,
   CASE o_orderkey % 5 WHEN 0 THEN CAST('NaN' AS DOUBLE) WHEN 1 THEN -o_totalprice WHEN 2 THEN CAST('Infinity' AS DOUBLE) WHEN 3 THEN o_totalprice END AS duration_seconds FROM orders"""


@register("report_context", f"""SELECT run_id, CASE WHEN run_id % 5 = 3 THEN duration_seconds END AS training_duration_seconds, model_name, CAST(epochs AS DOUBLE) AS epochs,
   lora_rank AS rank, CASE WHEN lora_rank IS NOT NULL THEN lora_dropout END AS dropout FROM ({REPORT_SQL})""")
def q_report(spark, sf_dir):
    return runs.report_context(view(spark, sf_dir, REPORT_SQL)).select(
        "run_id", "training_duration_seconds", "training.model_name", "training.epochs", "training.lora.rank", "training.lora.dropout")


# ---- artifacts ------------------------------------------------------------------------------------------
ADAPTERS = [
    ('{"r": 8, "base_model_name_or_path": "org/base"}', None), ('{"r": 8, "base_model_name_or_path": " https://huggingface.co/org/base/tree/main/"}', None),
    ('{"r": 8, "base_model_name_or_path": "org/base@v2"}', "REVISION_DIFFERS"), ('{"r": true, "base_model_name_or_path": "org/base"}', "RANK"),
    ('{"r": 8, "base_model_name_or_path": ""}', "BASE_MODEL_TEXT"), ('{"r": 8, "base_model_name_or_path": "org/base", "revision": 1}', "REVISION_TEXT"),
    ('{"r": 8, "base_model_name_or_path": "org/other"}', "BASE_MODEL_DIFFERS"), ("[8]", "CONFIG_NOT_OBJECT"),
    ('{"r": 8, "base_model_name_or_path": "org/base", "revision": "abc"}', None), ('{"r": 8, "base_model_name_or_path": "org/base", "revision": null}', None),
]
ADAPTER_CODE = "CASE r.run_id % " + str(len(ADAPTERS)) + " " + " ".join(f"WHEN {i} THEN {'NULL' if c is None else repr(c)}" for i, (_, c) in enumerate(ADAPTERS)) + " END"


@register("validate_lora_artifacts", f"""WITH f AS ({FILES_SQL}), r AS ({RUNS_SQL}),
   s AS (SELECT run_id, max(size) FILTER (WHERE rel_path = 'model/adapter_config.json') AS c, max(size) FILTER (WHERE rel_path = 'model/adapter_model.safetensors') AS w
         FROM f GROUP BY run_id)
  SELECT r.run_id, CASE WHEN c IS NULL THEN 'CONFIG_MISSING' WHEN c = 0 THEN 'CONFIG_EMPTY' WHEN {ADAPTER_CODE} IS NOT NULL THEN {ADAPTER_CODE}
    WHEN w IS NULL THEN 'WEIGHTS_MISSING' WHEN w = 0 THEN 'WEIGHTS_EMPTY' END AS code FROM r LEFT JOIN s USING (run_id)""")
def q_lora(spark, sf_dir):
    r = view(spark, sf_dir, RUNS_SQL)
    texts = F.array(*[F.lit(t) for t, _ in ADAPTERS])
    configs = r.select("run_id", F.get(texts, (F.col("run_id") % len(ADAPTERS)).cast("int")).alias("raw"))
    wanted = r.select("run_id", F.lit("org/base").alias("base_model"), F.lit(" main ").alias("requested_revision"), F.lit("abc").alias("resolved_revision"))
    return runs.validate_lora(view(spark, sf_dir, FILES_SQL), configs, wanted)


@register("validate_full_artifacts", f"""WITH f AS ({FILES_SQL}), r AS ({RUNS_SQL}),
   s AS (SELECT run_id, max(size) FILTER (WHERE rel_path = 'model/config.json') AS c,
           count(*) FILTER (WHERE rel_path = 'model/model-00001-of-00002.safetensors' AND size > 0) AS w FROM f GROUP BY run_id)
  SELECT r.run_id, CASE WHEN c IS NULL THEN 'CONFIG_MISSING' WHEN c = 0 THEN 'CONFIG_EMPTY' WHEN w = 0 THEN 'WEIGHTS_MISSING' END AS code,
    coalesce(w, 0) AS weight_files FROM r LEFT JOIN s USING (run_id)""")
def q_full(spark, sf_dir):
    return runs.validate_full(view(spark, sf_dir, FILES_SQL), view(spark, sf_dir, RUNS_SQL))


@register("reclaimable_checkpoints", f"""SELECT run_id, 'checkpoint-1' AS checkpoint, CAST(sum(size) AS BIGINT) AS bytes, count(*) AS files FROM ({FILES_SQL})
   WHERE rel_path LIKE 'model/checkpoint-1/%' AND run_id IN (SELECT run_id FROM ({RUNS_SQL}) WHERE status = 'success') GROUP BY run_id""")
def q_checkpoints(spark, sf_dir):
    return runs.reclaimable_checkpoints(view(spark, sf_dir, FILES_SQL), view(spark, sf_dir, RUNS_SQL))


LINKED_SQL = FILES_SQL.replace("AS run_id,", "AS run_id, l_returnflag = 'A' AS is_link,", 1)


@register("storage_by_run", f"SELECT run_id, split_part(rel_path, '/', 1) AS tree, CAST(sum(size) AS BIGINT) AS bytes, count(*) AS files FROM ({LINKED_SQL}) WHERE NOT is_link GROUP BY ALL")
def q_storage(spark, sf_dir):
    return runs.storage_by_run(view(spark, sf_dir, LINKED_SQL))


# ---- ownership ------------------------------------------------------------------------------------------
CLEAN_SQL = """SELECT c_custkey AS request_id, CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey * 10 AS STRING) END AS run_id,
   CASE WHEN c_custkey % 3 = 1 THEN 'e' || CAST(c_custkey AS STRING) END AS execution_id, CASE WHEN c_custkey % 3 = 2 THEN c_custkey END AS pipeline_id FROM customer"""
CLAIMS_SQL = "SELECT 'e' || CAST(o_orderkey % 2000 AS STRING) AS execution_id, o_custkey AS pipeline_id FROM orders WHERE o_orderstatus = 'F'"
EXECUTIONS_SQL = """SELECT 'e' || CAST(o_orderkey % 3000 AS STRING) AS execution_id, o_custkey + 1 AS pipeline_id,
   CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderkey AS STRING) END AS run_id FROM orders WHERE o_orderstatus = 'O'"""
OWNERS_SQL = """SELECT CAST(o_orderkey AS STRING) AS run_id, CASE WHEN o_orderkey % 5 <> 0 THEN 'e' || CAST(o_custkey AS STRING) END AS execution_id,
   o_custkey AS pipeline_id FROM orders WHERE o_orderstatus = 'P'"""
TARGETS_CTE = f"""q AS ({CLEAN_SQL}), cl AS ({CLAIMS_SQL}), ex AS ({EXECUTIONS_SQL}), ow AS ({OWNERS_SQL}),
 targets AS (
  SELECT request_id, 'run' AS kind, run_id AS id FROM q WHERE run_id IS NOT NULL
  UNION SELECT request_id, 'execution', execution_id FROM q WHERE execution_id IS NOT NULL
  UNION SELECT request_id, 'execution', cl.execution_id FROM q JOIN cl ON cl.execution_id = q.execution_id OR cl.pipeline_id = q.pipeline_id
  UNION SELECT request_id, 'execution', ex.execution_id FROM q JOIN ex ON ex.execution_id = q.execution_id OR ex.pipeline_id = q.pipeline_id
  UNION SELECT request_id, 'run', ex.run_id FROM q JOIN ex ON ex.execution_id = q.execution_id OR ex.pipeline_id = q.pipeline_id WHERE ex.run_id IS NOT NULL
  UNION SELECT request_id, 'run', ow.run_id FROM q JOIN ow ON ow.execution_id = q.execution_id OR ow.pipeline_id = q.pipeline_id
  UNION SELECT request_id, 'execution', ow.execution_id FROM q JOIN ow ON ow.execution_id = q.execution_id OR ow.pipeline_id = q.pipeline_id WHERE ow.execution_id IS NOT NULL)"""
RESOURCES_SQL = """SELECT l_orderkey * 10 + l_linenumber AS resource_id, CAST(l_orderkey AS STRING) AS run_id,
   CASE WHEN l_linenumber = 2 THEN 'e' || CAST(l_suppkey AS STRING) END AS execution_id, CASE WHEN l_linenumber = 3 THEN l_partkey END AS pipeline_id FROM lineitem"""
OWNED_CTE = f"""{TARGETS_CTE}, res AS ({RESOURCES_SQL}), owned AS (
  SELECT request_id, resource_id FROM targets JOIN res ON kind = 'run' AND run_id = id
  UNION SELECT request_id, resource_id FROM targets JOIN res ON kind = 'execution' AND execution_id = id
  UNION SELECT request_id, resource_id FROM q JOIN res ON q.pipeline_id = res.pipeline_id)"""


def targets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    requests = view(spark, sf_dir, CLEAN_SQL)
    return requests, runs.discover_targets(requests, *[view(spark, sf_dir, s) for s in (CLAIMS_SQL, EXECUTIONS_SQL, OWNERS_SQL)])


@register("discover_targets", f"WITH {TARGETS_CTE} SELECT request_id, kind, id FROM targets")
def q_targets(spark, sf_dir):
    return targets(spark, sf_dir)[1]


@register("owned_resources", f"WITH {OWNED_CTE} SELECT request_id, resource_id FROM owned")
def q_owned(spark, sf_dir):
    return runs.owned_resources(*targets(spark, sf_dir), view(spark, sf_dir, RESOURCES_SQL))


@register("leftovers", f"WITH {OWNED_CTE} SELECT request_id, count(*) AS remaining FROM owned WHERE resource_id % 10 IN (2, 3) GROUP BY request_id")
def q_leftovers(spark, sf_dir):
    later = view(spark, sf_dir, RESOURCES_SQL).filter("execution_id IS NOT NULL OR pipeline_id IS NOT NULL")
    return runs.leftovers(*targets(spark, sf_dir), later)


# ---- registrations --------------------------------------------------------------------------------------
DESIRED_SQL = """SELECT 'm' || CAST(c_custkey AS STRING) AS alias, 'r' || CAST(c_custkey % 50 AS STRING) AS run_id,
   CASE WHEN c_custkey % 2 = 0 THEN 'base' ELSE 'fine_tuned' END AS role FROM customer"""
LISTING_SQL = """SELECT 'm' || CAST(CASE WHEN o_orderkey % 11 = 0 THEN o_custkey ELSE -o_orderkey END AS STRING) AS model_name, 'id' || CAST(o_orderkey AS STRING) AS registration_id,
   'r' || CAST(CASE WHEN o_custkey % 7 = 0 THEN o_orderkey ELSE o_custkey % 50 END AS STRING) AS pipeline_run_id,
   CASE WHEN o_custkey % 2 = 0 THEN 'base' ELSE 'fine_tuned' END AS pipeline_role FROM orders"""


@register("reconcile_registrations", f"""WITH d AS ({DESIRED_SQL}), l AS ({LISTING_SQL}),
  n AS (SELECT d.alias, d.run_id, d.role, count(l.model_name) AS everything,
    count(*) FILTER (WHERE l.pipeline_run_id = d.run_id AND l.pipeline_role = d.role) AS own,
    max(registration_id) FILTER (WHERE l.pipeline_run_id = d.run_id AND l.pipeline_role = d.role) AS reg
    FROM d LEFT JOIN l ON l.model_name = d.alias GROUP BY ALL)
  SELECT alias, run_id, role, CASE WHEN everything > own THEN 'conflict' WHEN own = 1 THEN 'created' WHEN own > 1 THEN 'indeterminate' ELSE 'absent' END AS outcome,
    CASE WHEN everything = own AND own = 1 THEN reg END AS registration_id FROM n""")
def q_reconcile(spark, sf_dir):
    return runs.reconcile_registrations(view(spark, sf_dir, DESIRED_SQL), view(spark, sf_dir, LISTING_SQL))


PUBLIC_SQL = "SELECT 'm' || CAST(s_suppkey AS STRING) AS id FROM supplier"


@register("alias_conflicts", f"""SELECT alias, run_id, role FROM ({DESIRED_SQL}) WHERE alias IN (SELECT model_name FROM ({LISTING_SQL}))
   OR alias IN (SELECT id FROM ({PUBLIC_SQL}))""")
def q_conflicts(spark, sf_dir):
    return runs.alias_conflicts(view(spark, sf_dir, DESIRED_SQL), view(spark, sf_dir, LISTING_SQL), view(spark, sf_dir, PUBLIC_SQL))


ALIAS_SQL = """SELECT '20260916_120000_' || c_name || '__' || c_mktsegment AS run_id, CASE WHEN c_custkey % 3 = 0 THEN 'Org/My Model..v2' ELSE 'x/' || c_mktsegment END AS base_model,
   CASE WHEN c_custkey % 5 = 0 THEN 'Fixed.Name' WHEN c_custkey % 5 = 1 THEN '-bad' ELSE 'auto' END AS base_name,
   CASE WHEN c_custkey % 10 = 0 THEN 'Fixed.Name' END AS fine_tuned_name FROM customer"""


def _safe(expr: str, fallback: str, limit: int) -> str:
    squeezed = f"regexp_replace(trim(regexp_replace(lower({expr}), '[^a-z0-9._-]+', '-', 'g'), '-._'), '[-._]{{2,}}', '-', 'g')"
    return f"rtrim(substr(coalesce(nullif({squeezed}, ''), '{fallback}'), 1, {limit}), '-._')"


@register("derive_aliases", f"""WITH a AS (SELECT *, {_safe('run_id', 'run', 40)} AS trace FROM ({ALIAS_SQL})),
  b AS (SELECT *, CASE base_name WHEN 'auto' THEN {_safe("split_part(base_model, '/', -1)", 'base', 72)} || '-' || trace ELSE base_name END AS base_alias FROM a),
  f AS (SELECT *, coalesce(fine_tuned_name, {_safe('base_alias', 'model', 80)} || '-finetuned') AS fine_tuned_alias FROM b)
  SELECT run_id, base_alias, fine_tuned_alias, 'ft-serving-' || trace AS container_name,
    CASE WHEN base_alias = '-bad' THEN 'BASE_NAME' WHEN base_alias = fine_tuned_alias THEN 'SAME_ALIAS' END AS code FROM f""")
def q_aliases(spark, sf_dir):
    return runs.derive_aliases(view(spark, sf_dir, ALIAS_SQL))


RESULTS = [  # status, execution, run_directory, model_directory, metadata_path, code
    ("success", "e", "r", "r/model", "r/metadata.json", None), ("failed", "e", "r", "r/model", "r/m", "NOT_SUCCESS"),
    (None, "e", "r", "r/model", "r/m", "NOT_SUCCESS"), ("success", "x", "r", "r/model", "r/m", "OTHER_EXECUTION"),
    ("success", "e", "", "r/model", "r/m", "MISSING_RUN_DIRECTORY"), ("success", "e", "r", None, "r/m", "MISSING_MODEL_DIRECTORY"),
    ("success", "e", "/r", "r/model", "r/m", "UNSAFE_RUN_DIRECTORY"), ("success", "e", "r", "r/../x", "r/m", "UNSAFE_MODEL_DIRECTORY"),
    ("success", "e", "r", "r/model", "r\\\\m", "UNSAFE_METADATA_PATH"), ("success", "e", "r", "q/model", "r/m", "OUTSIDE_MODEL_DIRECTORY"),
    ("success", "e", "./r", "r//model", "rr/m", "OUTSIDE_METADATA_PATH"), ("success", "e", "a/r", "a/r/model", "a/r/m", None),
]


def _result(index: int) -> str:
    arms = " ".join(f"WHEN {i} THEN {'CAST(NULL AS STRING)' if r[index] is None else chr(39) + r[index] + chr(39)}" for i, r in enumerate(RESULTS))
    return f"CASE o_orderkey % {len(RESULTS)} {arms} END"


@register("validate_results", f"SELECT o_orderkey AS result_id, {_result(5)} AS code FROM orders")
def q_results(spark, sf_dir):
    results = view(spark, sf_dir, f"""SELECT o_orderkey AS result_id, {_result(0)} AS status, {_result(1)} || CAST(o_custkey AS STRING) AS execution_id,
        CAST(o_orderkey AS STRING) AS run_id, {_result(2)} AS run_directory, {_result(3)} AS model_directory, {_result(4)} AS metadata_path FROM orders""")
    started = view(spark, sf_dir, "SELECT o_orderkey AS result_id, 'e' || CAST(o_custkey AS STRING) AS started_execution_id FROM orders")
    return runs.validate_results(results, started)


TRAINING_SQL = "SELECT o_orderkey AS run_id, 'e' || CAST(o_custkey AS STRING) AS execution_id, 'org/base' AS base_model, 'lora' AS method FROM orders"
SERVING_SQL = """SELECT o_orderkey AS run_id, o_orderstatus = 'F' AS rolled_back, 'http://s' AS base_url, 'b' || CAST(o_orderkey AS STRING) AS base_alias,
   'f' || CAST(o_orderkey AS STRING) AS fine_tuned_alias FROM orders WHERE o_orderkey % 3 <> 0"""
GATEWAY_SQL = "SELECT o_orderkey AS run_id, o_orderkey % 2 = 0 AS enabled, o_orderstatus = 'O' AS ready, 'http://g' AS base_url FROM orders WHERE o_orderkey % 5 <> 0"


@register("deployment_summary", f"""WITH t AS ({TRAINING_SQL}), s AS ({SERVING_SQL}), g AS ({GATEWAY_SQL})
  SELECT t.run_id, t.execution_id, CASE WHEN s.run_id IS NULL THEN 'failed' WHEN s.rolled_back THEN 'rolled_back' ELSE 'ready' END AS serving,
    s.fine_tuned_alias, CASE WHEN g.ready THEN 'ready' WHEN g.enabled THEN 'failed' ELSE 'disabled' END AS gateway,
    CASE WHEN g.enabled THEN g.base_url END AS gateway_url FROM t LEFT JOIN s USING (run_id) LEFT JOIN g USING (run_id)""")
def q_deployment(spark, sf_dir):
    d = runs.deployment_summary(*[view(spark, sf_dir, s) for s in (TRAINING_SQL, SERVING_SQL, GATEWAY_SQL)])
    return d.select("run_id", "execution_id", F.col("serving.status").alias("serving"), "serving.fine_tuned_alias",
                    F.col("gateway.status").alias("gateway"), F.col("gateway.base_url").alias("gateway_url"))


ATTEMPTS_SQL = """SELECT o_custkey AS run_id, CASE WHEN o_orderkey % 2 = 0 THEN 'base' ELSE 'fine_tuned' END AS role,
   CASE o_orderkey % 5 WHEN 0 THEN 'created' WHEN 1 THEN 'created_after_ambiguous_response' WHEN 2 THEN 'conflict' WHEN 3 THEN 'absent'
     ELSE CASE WHEN o_custkey % 4 = 0 THEN 'indeterminate' ELSE 'absent' END END AS outcome FROM orders"""


@register("registration_outcome", f"""WITH a AS (SELECT run_id, count(*) FILTER (WHERE outcome LIKE 'created%') AS created, bool_or(outcome = 'indeterminate') AS unclear
     FROM ({ATTEMPTS_SQL}) GROUP BY run_id)
  SELECT run_id, created, CASE WHEN run_id IN (SELECT s_suppkey FROM supplier) THEN 'ready' WHEN unclear THEN 'indeterminate_failed' WHEN created = 0 THEN 'registration_failed'
    WHEN created < 2 THEN 'partial_failed' ELSE 'verification_failed' END AS status FROM a""")
def q_registration(spark, sf_dir):
    verified = fixtures.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("run_id"))
    return runs.registration_outcome(view(spark, sf_dir, ATTEMPTS_SQL), verified)


# ---- digests --------------------------------------------------------------------------------------------
FAN = digests.FAN_OUT
ROW_SHA = "sha256(strlen(instruction) || ':' || strlen(input) || ':' || instruction || input || output)"


def _levels(rows: str, key: str, index: str) -> str:
    ctes, previous, position, value = [], rows, f"({index} - 1)", "h"
    for level in range(digests.LEVELS):
        ctes.append(f"l{level} AS (SELECT {key}, {position} // {FAN} AS b, sha256(string_agg({value}, '' ORDER BY {position})) AS h FROM {previous} GROUP BY 1, 2)")
        previous, position, value = f"l{level}", "b", "h"
    return ", ".join(ctes)


@register("dataset_digest", f"""WITH n AS (SELECT source AS dataset_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i, lang AS instruction, source AS input, text AS output FROM documents),
   rows_ AS (SELECT dataset_id, i, {ROW_SHA} AS h FROM n), {_levels('rows_', 'dataset_id', 'i')}
   SELECT dataset_id, h AS sha256 FROM l{digests.LEVELS - 1}""")
def q_digest(spark, sf_dir):
    return digests.dataset_digest(sft_documents(spark, sf_dir))


TURNS_SQL = """SELECT 'd' || CAST(conv_id % 5 AS STRING) AS dataset_id, conv_id DIV 5 + 1 AS row_index, CAST(turn + 1 AS BIGINT) AS turn,
   role AS instruction, '' AS input, text AS output FROM conversations"""


@register("dataset_digest_turns", f"""WITH n AS ({TURNS_SQL.replace('DIV', '//').replace('STRING', 'VARCHAR')}),
   t AS (SELECT dataset_id, row_index AS i, sha256(sha256(string_agg({ROW_SHA}, '' ORDER BY turn))) AS h FROM n GROUP BY 1, 2),
   {_levels('t', 'dataset_id', 'i')} SELECT dataset_id, h AS sha256 FROM l{digests.LEVELS - 1}""")
def q_digest_turns(spark, sf_dir):
    return digests.dataset_digest(view(spark, sf_dir, TURNS_SQL))


def sft_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.dataset_rows(spark, sf_dir)
    return rows.select("dataset_id", "row_index", F.col("ctx").alias("instruction"), F.col("dataset_id").alias("input"), F.col("ans").alias("output"))
