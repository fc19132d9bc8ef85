"""Model, job-spec and capacity queries over inputs derived from ``part`` and ``supplier``."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sft_tables.operators import capacity, jobs, models
from sft_tables.plans import fixtures
from sft_tables.plans.fixtures import GPUS_SQL, JOBS_SQL

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


def pick(expr: str, values: list[str]) -> str:
    """SQL CASE giving values[expr % n]; values are SQL text."""
    arms = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
    return f"CASE {expr} % {len(values)} {arms} END"


def quoted(value: str | None) -> str:
    return "CAST(NULL AS STRING)" if value is None else "'" + value.replace("'", "''") + "'"


# ---- models ---------------------------------------------------------------------------------------------
# name, family, variant, template
NAMES = [
    ("Qwen/Qwen2.5-0.5B-Instruct", "qwen", "qwen2.5", "qwen"), ("Qwen/Qwen2-7B", "qwen", "qwen2", "qwen"),
    ("Qwen/Qwen-1_8B-Chat", "qwen", "qwen", "qwen"), ("meta-llama/Llama-2-7b-chat-hf", "llama", "llama2", "llama2"),
    ("meta-llama/Llama-3.1-8B", "llama", "llama3", "llama3"), ("acme/llama-tiny", "llama", "llama", None),
    ("mistralai/Mistral-7B-v0.1", "mistral", "mistral", "mistral"), ("mistralai/Mixtral-8x7B", None, None, None),
    ("google/gemma-3-270m-it", "gemma", "gemma3", "gemma3"), ("google/gemma-2-9b", "gemma", "gemma2", "gemma2"),
    ("google/gemma_7b", "gemma", "gemma", "gemma"), ("acme/unknown", None, None, None), ("  ", None, None, None),
]
# model_type, architectures, vocab_size, commit, error
CONFIGS = [
    ("qwen2", [], 151936, "c0ffee", None), ("LLAMA", [], 128256, None, None), ("llama", [], 32000, "abc", None),
    ("llama", [], 50000, None, None), ("mistral", [], None, "m1", None), ("gemma3_text", [], None, "g3", None),
    ("phi", ["Qwen2ForCausalLM"], None, None, None), ("phi", [], None, None, None), (None, [], None, None, " offline \n now "),
    None,
]
TEMPLATE_ASKS = [None, None, None, "qwen", "Llama3", " gemma3 ", "", "mistral"]


def _models_sql() -> str:
    name = pick("p_partkey", [quoted(n[0]) for n in NAMES])
    return f"""SELECT p_partkey AS model_id, CASE WHEN trim({name}) = '' THEN {name} ELSE {name} || '-' || CAST(p_partkey AS STRING) END AS model_name,
      {pick('p_size', [quoted(t) for t in TEMPLATE_ASKS])} AS requested_template,
      {pick('p_size', [quoted(r) for r in (None, 'main', None, ' ', None, None, 'v1')])} AS requested_revision FROM part"""


def _configs_sql(engine: str) -> str:
    column = lambda i, kind: pick("(p_partkey // 13)" if engine == "duckdb" else "(p_partkey div 13)", [
        "NULL" if c is None or c[i] is None else quoted(c[i]) if isinstance(c[i], str) else str(c[i]) for c in CONFIGS])
    arch = pick("(p_partkey // 13)" if engine == "duckdb" else "(p_partkey div 13)", [
        "CAST(array() AS array<string>)" if not c or not c[1] else f"array({quoted(c[1][0])})" for c in CONFIGS])
    kept = "(p_partkey // 13) % 10 <> 9" if engine == "duckdb" else "(p_partkey div 13) % 10 <> 9"
    name = pick("p_partkey", [quoted(n[0]) for n in NAMES])
    return f"""SELECT CASE WHEN trim({name}) = '' THEN trim({name}) ELSE {name} || '-' || CAST(p_partkey AS STRING) END AS model_name,
      CAST({column(0, 's')} AS STRING) AS model_type, {arch} AS architectures, CAST(NULL AS STRING) AS name_or_path,
      CAST({column(2, 'i')} AS BIGINT) AS vocab_size, CAST({column(3, 's')} AS STRING) AS commit_hash,
      CAST({column(4, 's')} AS STRING) AS error FROM part WHERE {kept} AND trim({name}) <> ''"""


def model_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.view(spark, sf_dir, _models_sql())


def config_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.view(spark, sf_dir, _configs_sql("spark"))


_FAMILY_ARMS = [pick("p_partkey", [quoted(n[i]) for n in NAMES]) for i in (1, 2, 3)]


def _named(i: int) -> str:
    # the number put behind the name may complete a version: llama-tiny-<n> stays unclear, gemma_7b-<n> too
    return _FAMILY_ARMS[i]


@register("family_from_name", f"SELECT p_partkey AS model_id, {_named(0)} AS family, {_named(1)} AS variant, {_named(2)} AS template FROM part")
def q_family(spark, sf_dir):
    m = model_table(spark, sf_dir).withColumn("m", models.family_from_name(F.col("model_name")))
    return m.select("model_id", "m.family", "m.variant", "m.template")


def _config_results() -> dict[str, str]:
    """Family, variant, template, inferred per (name, config): small literal table for the oracle."""
    rows = []
    for n, (name, family, variant, template) in enumerate(NAMES):
        for c, config in enumerate(CONFIGS):
            if config is None or config[4] is not None or not name.strip():
                continue
            kind, arch, vocab = (config[0] or "").lower(), config[1], config[2]
            got: tuple | None = None
            if kind == "qwen2":
                got = ("qwen", variant if family == "qwen" else "qwen2", "qwen", False)
            elif kind == "llama":
                if template is not None:
                    got = ("llama", variant, template, False)
                elif vocab >= 100000:
                    got = ("llama", "llama3", "llama3", True)
                elif vocab <= 40000:
                    got = ("llama", "llama2", "llama2", True)
            elif kind == "mistral":
                got = ("mistral", "mistral", "mistral", False)
            elif kind == "gemma3_text":
                got = ("gemma", "gemma3", "gemma3", False)
            elif arch:
                got = ("qwen", "qwen2", "qwen", False)
            if got:
                rows.append(f"({n}, {c}, {quoted(got[0])}, {quoted(got[1])}, {quoted(got[2])}, {str(got[3]).lower()})")
    return ", ".join(rows)


CONFIG_CTE = f"""
m AS (SELECT *, model_id % {len(NAMES)} AS n, (model_id // 13) % {len(CONFIGS)} AS c FROM ({_models_sql()})),
cfg AS (SELECT * FROM (VALUES {_config_results()}) t(n, c, family, variant, template, inferred)),
nm AS (SELECT * FROM (VALUES {', '.join(f"({i}, {quoted(f)}, {quoted(v)}, {quoted(t)})" for i, (_, f, v, t) in enumerate(NAMES))}) t(n, family, variant, template)),
raw_cfg AS (SELECT * FROM (VALUES {', '.join(f"({i}, {quoted(c[0].lower() if c and c[0] else None)}, {quoted(c[3] if c else None)}, {'true' if c and c[4] is None else 'false'})" for i, c in enumerate(CONFIGS))}) t(c, kind, commit_hash, loaded)),
j AS (SELECT m.*, cfg.family AS cf, cfg.variant AS cv, cfg.template AS ct, coalesce(cfg.inferred, false) AS inferred,
        nm.family AS nf, nm.variant AS nv, nm.template AS nt, raw_cfg.kind, raw_cfg.commit_hash,
        raw_cfg.loaded AND trim(m.model_name) <> '' AS loaded
      FROM m LEFT JOIN cfg ON cfg.n = m.n AND cfg.c = m.c LEFT JOIN nm ON nm.n = m.n LEFT JOIN raw_cfg ON raw_cfg.c = m.c)
"""


@register("family_from_config", f"WITH {CONFIG_CTE} SELECT model_id, cf AS family, cv AS variant, ct AS template, inferred FROM j WHERE cf IS NOT NULL")
def q_config(spark, sf_dir):
    joined = model_table(spark, sf_dir).join(config_table(spark, sf_dir).filter("error IS NULL"), "model_name")
    found = models.family_from_config(F.col("model_name"), F.col("model_type"), F.col("architectures"), F.col("name_or_path"), F.col("vocab_size"))
    return joined.select("model_id", found.alias("m")).filter("m IS NOT NULL").select("model_id", "m.*")


@register("llama_generation", f"""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'llama2' WHEN 1 THEN 'llama3'
    ELSE CASE WHEN p_size * 4000 >= 100000 THEN 'llama3' WHEN p_size * 4000 BETWEEN 30000 AND 40000 THEN 'llama2' END END AS variant,
  CASE WHEN p_partkey % 4 IN (0, 1) THEN false WHEN p_size * 4000 >= 100000 OR p_size * 4000 BETWEEN 30000 AND 40000 THEN true END AS inferred FROM part""")
def q_llama(spark, sf_dir):
    part = fixtures.table(spark, sf_dir, "part")
    name = F.expr("CASE p_partkey % 4 WHEN 0 THEN 'x/llama-2-7b' ELSE 'x/tiny' END")
    origin = F.expr("CASE p_partkey % 4 WHEN 1 THEN 'meta/Llama-3-8B' WHEN 2 THEN '' END")
    g = models.llama_generation(name, origin, F.col("p_size") * 4000)
    return part.select("p_partkey", g.alias("g")).select("p_partkey", "g.variant", "g.inferred")


ASK = "replace(lower(trim(requested_template)), '-', '_')"


@register("resolve_compatibility", f"""WITH {CONFIG_CTE},
 s AS (SELECT *, coalesce(cf, nf) AS family, CASE WHEN nf IS NOT NULL AND cf IS NOT NULL THEN CASE WHEN nv <> nf THEN nv ELSE cv END ELSE coalesce(cv, nv) END AS variant,
   coalesce(nt, ct) AS template FROM j),
 e AS (SELECT *, CASE WHEN trim(model_name) = '' THEN 'NAME_BLANK' WHEN trim(requested_revision) = '' THEN 'REVISION_BLANK'
   WHEN loaded AND kind = 'llama' AND cf IS NULL THEN 'LLAMA_GENERATION' WHEN nf <> cf THEN 'FAMILY_CONFLICT' WHEN nt <> ct THEN 'TEMPLATE_CONFLICT'
   WHEN nf IS NOT NULL AND cf IS NULL AND loaded THEN 'CONFIG_UNSUPPORTED' WHEN nf IS NULL AND cf IS NULL AND NOT loaded THEN 'UNRECOGNIZED'
   WHEN nf IS NULL AND cf IS NULL THEN 'UNSUPPORTED' WHEN template IS NULL THEN 'TEMPLATE_UNKNOWN'
   WHEN NOT ((family = 'qwen' AND template = 'qwen') OR (family = 'llama' AND template IN ('llama2', 'llama3')) OR (family = 'mistral' AND template = 'mistral')
     OR (family = 'gemma' AND template IN ('gemma', 'gemma2', 'gemma3'))) THEN 'TEMPLATE_INCOMPATIBLE'
   WHEN trim(requested_template) = '' THEN 'TEMPLATE_BLANK' WHEN {ASK} <> template THEN 'TEMPLATE_MISMATCH' END AS code FROM s)
 SELECT model_id, code, CASE WHEN code IS NULL THEN family END AS family, CASE WHEN code IS NULL THEN variant END AS variant,
   CASE WHEN code IS NULL THEN template END AS template,
   CASE WHEN code IS NULL THEN CASE WHEN nf IS NOT NULL AND cf IS NOT NULL THEN 'name+config' WHEN cf IS NOT NULL THEN 'config' ELSE 'name' END END AS detection_source,
   CASE WHEN code IS NULL THEN concat_ws('; ', CASE WHEN cf IS NULL THEN 'CONFIG_UNAVAILABLE: ' || CASE WHEN c = 8 THEN 'offline now' ELSE 'config not found' END END,
     CASE WHEN inferred THEN 'GENERATION_FROM_VOCABULARY' END,
     CASE WHEN NOT regexp_matches(lower(model_name), 'instruct|chat|-it|_it|assistant') THEN 'NOT_INSTRUCTION_TUNED' END) END AS warnings,
   CASE WHEN code IS NULL THEN CASE WHEN loaded AND commit_hash IS NOT NULL THEN 'resolved' ELSE 'unavailable' END END AS revision_status FROM e""")
def q_resolve(spark, sf_dir):
    r = models.resolve_compatibility(model_table(spark, sf_dir), config_table(spark, sf_dir))
    return r.select("model_id", "code", "family", "variant", "template", "detection_source",
                    F.when(F.col("warnings").isNotNull(), F.array_join("warnings", "; ")).alias("warnings"), "revision_status")


@register("instruction_tuned", f"SELECT model_id, regexp_matches(lower(model_name), 'instruct|chat|-it|_it|assistant') AS tuned FROM ({_models_sql()})")
def q_tuned(spark, sf_dir):
    return model_table(spark, sf_dir).select("model_id", models.instruction_tuned(F.col("model_name")).alias("tuned"))


@register("revision_status", f"""WITH {CONFIG_CTE} SELECT model_id, CASE WHEN loaded THEN commit_hash END AS resolved_revision,
  CASE WHEN loaded AND commit_hash IS NOT NULL THEN 'resolved' ELSE 'unavailable' END AS status,
  CASE WHEN loaded AND commit_hash IS NOT NULL THEN NULL WHEN NOT loaded THEN 'lookup failed: offline' ELSE 'no commit hash in config' END AS reason
  FROM j WHERE c <> 9 AND trim(model_name) <> ''""")
def q_revision(spark, sf_dir):
    joined = model_table(spark, sf_dir).join(config_table(spark, sf_dir), "model_name")
    loaded = F.col("error").isNull()
    r = models.revision_status(F.when(loaded, F.col("commit_hash")), loaded, F.lit("offline"))
    return joined.select("model_id", r.alias("r")).select("model_id", "r.*")


# reference text, normalized reference, revision
REFS = [
    (" Qwen/Qwen2-7B/ ", "Qwen/Qwen2-7B", None), ("https://huggingface.co/a/b/", "a/b", None), ("a\\\\b", "a/b", None),
    ("a/b/tree/main/", "a/b", "main"), ("a/b@v1", "a/b", "v1"), ("https://huggingface.co/a/b/tree/x/y", "a/b", "x/y"),
    ("@v1", "@v1", None), ("a@b@c", "a@b", "c"), ("a/tree/", "a/tree", None),
]


def _refs_sql(index: int, spark: bool = False) -> str:
    return pick("p_partkey", ["NULL" if r[index] is None else "'" + (r[index] if spark else r[index].replace("\\\\", "\\")) + "'" for r in REFS])


@register("normalize_model_ref", f"SELECT p_partkey, {_refs_sql(1)} AS ref, {_refs_sql(2)} AS revision FROM part")
def q_ref(spark, sf_dir):
    part = fixtures.table(spark, sf_dir, "part")
    return part.select("p_partkey", models.normalize_model_ref(F.expr(_refs_sql(0, True))).alias("r")).select("p_partkey", "r.ref", "r.revision")


# ---- documents with one planted fault per row ------------------------------------------------------------
def changed(base: dict, path: str, value) -> str:
    doc = json.loads(json.dumps(base))
    *parents, last = path.split(".")
    at = doc
    for p in parents:
        at = at[p]
    if value is ...:
        del at[last]
    else:
        at[last] = value
    return json.dumps(doc)


def specs(base: dict, faults: list[tuple[str | None, str | None, object]]) -> list[tuple[str, str | None]]:
    """(document text, expected code) per planted fault."""
    return [(json.dumps(base) if path is None else changed(base, path, value), code) for code, path, value in faults]


def spec_table(spark: SparkSession, sf_dir: str, documents: list[tuple[str, str | None]], key: str) -> DataFrame:
    """Document text chosen by p_partkey from the list; the number in the name keeps rows distinct."""
    texts = F.array(*[F.lit(t) for t, _ in documents])
    # a few MB of keys, which a scan gives to one or two tasks, are many documents: they are dealt out before these are made
    part = fixtures.table(spark, sf_dir, "part").select("p_partkey").repartition(2 * spark.sparkContext.defaultParallelism)
    return part.select(F.col("p_partkey").alias(key), F.get(texts, (F.col("p_partkey") % len(documents)).cast("int")).alias("raw"))


def expected(documents: list[tuple[str, str | None]], key: str) -> str:
    code = pick("p_partkey", [quoted(c) for _, c in documents])
    return f"SELECT p_partkey AS {key}, {code} AS code FROM part WHERE {code} IS NOT NULL"


ENTRY = {
    "parameter_count": 490000000, "precision": "bf16", "attention_backend": "eager",
    "architecture": {"model_type": "qwen2", "hidden_size": 896, "num_hidden_layers": 24, "num_attention_heads": 14,
                     "num_key_value_heads": 2, "head_dim": 64, "max_position_embeddings": 32768, "sliding_window": None},
}
CATALOG_DOCS = specs(ENTRY, [
    (None, None, None), (None, "architecture.sliding_window", 4096), (None, "precision", " BF16 "),
    ("PARAMETER_COUNT", "parameter_count", True), ("PARAMETER_COUNT", "parameter_count", 5.0), ("PRECISION_TEXT", "precision", 16),
    ("ATTENTION_TEXT", "attention_backend", ...), ("ARCHITECTURE_MISSING", "architecture", [1]),
    ("ARCHITECTURE_UNKNOWN_FIELD", "architecture.top_level_model_type", "gemma3_text"), ("MODEL_TYPE", "architecture.model_type", " "),
    ("SIZE_HEAD_DIM", "architecture.head_dim", 0), ("SIZE_HIDDEN_SIZE", "architecture.hidden_size", "896"),
    ("SLIDING_WINDOW_MISSING", "architecture.sliding_window", ...), ("SLIDING_WINDOW", "architecture.sliding_window", -1),
    ("KV_HEADS", "architecture.num_key_value_heads", 15), ("PRECISION", "precision", "int8"), ("ATTENTION_BACKEND", "attention_backend", "flash"),
])


@register("validate_catalog", expected(CATALOG_DOCS, "name"))
def q_catalog(spark, sf_dir):
    return models.validate_catalog(jobs.parse_specs(spec_table(spark, sf_dir, CATALOG_DOCS, "name")))


CATALOG_SQL = f"""SELECT {pick('p_partkey', [quoted(n[0]) for n in NAMES])} || '-' || p_brand AS name,
   min(CASE WHEN p_size % 3 = 0 THEN 'fp32' ELSE 'bf16' END) AS precision, min(CAST(p_size AS BIGINT) * 490000000) AS parameter_count,
   'eager' AS attention_backend FROM part GROUP BY 1"""


APPROVED_SQL = CATALOG_SQL.replace("FROM part", "FROM part WHERE p_brand NOT LIKE '%5'")


@register("approved_models", f"""SELECT p_partkey AS job_id, name AS model_name, 'MODEL_NOT_APPROVED' AS code FROM
  (SELECT p_partkey, {pick('p_partkey', [quoted(n[0]) for n in NAMES])} || '-' || p_brand AS name FROM part)
  WHERE name NOT IN (SELECT name FROM ({APPROVED_SQL}))""")
def q_approved(spark, sf_dir):
    wanted = fixtures.view(spark, sf_dir, f"SELECT p_partkey AS job_id, {pick('p_partkey', [quoted(n[0]) for n in NAMES])} || '-' || p_brand AS model_name FROM part")
    return models.approved_models(wanted, fixtures.view(spark, sf_dir, APPROVED_SQL))


@register("catalog_profile", f"""WITH c AS (SELECT *, CASE WHEN lower(name) LIKE '%qwen%' THEN 'qwen' WHEN lower(name) LIKE '%llama%' THEN 'llama'
    WHEN lower(name) LIKE '%mistral-%' THEN 'mistral' WHEN lower(name) LIKE '%gemma%' THEN 'gemma' ELSE 'other' END AS family FROM ({CATALOG_SQL}))
  SELECT family, precision, count(*) AS models, min(parameter_count) AS min_parameters, max(parameter_count) AS max_parameters
  FROM c GROUP BY ROLLUP (family, precision)""")
def q_profile(spark, sf_dir):
    return models.catalog_profile(fixtures.view(spark, sf_dir, CATALOG_SQL))


JOB = {
    "schema_version": 1, "job": {"name": "example-job"}, "model": {"name": "Qwen/Qwen2-7B"},
    "datasets": {"train": {"path": "data/train.JSONL", "source_format": "auto", "format": "auto"}, "benchmark": {"path": "bench.json"}},
    "training": {"epochs": 1, "learning_rate": 5e-05, "batch_size": 1, "cutoff_len": 2048, "lora": {"rank": 8, "alpha": 16, "dropout": 0.0}},
}
T, LORA = "training", "training.lora"
UNKNOWN_FAULTS = [
    ("UNKNOWN_FIELD_JOB_FILE", "extra", 1), ("UNKNOWN_FIELD_JOB", "job.owner", "x"), ("UNKNOWN_FIELD_MODEL", "model.size", 1),
    ("UNKNOWN_FIELD_DATASETS", "datasets.test", {}), ("UNKNOWN_FIELD_DATASETS_TRAIN", "datasets.train.split", "train"),
    ("UNKNOWN_FIELD_DATASETS_BENCHMARK", "datasets.benchmark.x", 1), ("UNKNOWN_FIELD_TRAINING", f"{T}.save_steps", 1),
    ("UNKNOWN_FIELD_TRAINING_LORA", f"{LORA}.bias", 1),
]
IDENTITY_FAULTS = [
    ("SCHEMA_VERSION", "schema_version", True), ("SCHEMA_VERSION", "schema_version", 2), ("SCHEMA_VERSION", "schema_version", 1.0),
    ("NOT_MAPPING_JOB", "job", ...), ("TEXT_JOB_NAME", "job.name", 5), ("JOB_NAME", "job.name", "-bad"), ("JOB_NAME", "job.name", "x" * 64),
    ("NOT_MAPPING_MODEL", "model", "Qwen"), ("TEXT_MODEL_NAME", "model.name", " "), ("TEXT_MODEL_REVISION", "model.revision", ""),
    (None, "model.revision", None), (None, "model.revision", "main"),
]
TP, BP = "datasets.train.path", "datasets.benchmark.path"
PATH_FAULTS = [
    ("NOT_MAPPING_DATASETS", "datasets", None), ("NOT_MAPPING_DATASETS_TRAIN", "datasets.train", []), ("NOT_MAPPING_DATASETS_BENCHMARK", "datasets.benchmark", ...),
    ("TEXT_DATASETS_TRAIN_PATH", TP, 7), ("BACKSLASH_DATASETS_TRAIN_PATH", TP, "a\\b.json"), ("PATH_DATASETS_TRAIN_PATH", TP, "../a.json"),
    ("PATH_DATASETS_TRAIN_PATH", TP, "/a.json"), ("PATH_DATASETS_TRAIN_PATH", TP, "C:/a.json"), ("PATH_DATASETS_BENCHMARK_PATH", BP, "a//b.json"),
    ("PATH_DATASETS_BENCHMARK_PATH", BP, "./b.json"), ("SAME_FILE", TP, "bench.json"), ("EXTENSION_DATASETS_TRAIN_PATH", TP, "train.xml"),
    ("EXTENSION_DATASETS_TRAIN_PATH", TP, "data/.json"), ("EXTENSION_DATASETS_BENCHMARK_PATH", BP, "bench.txt"), (None, TP, "a/b.chatml"),
]
HYPER_FAULTS = [
    ("NOT_MAPPING_TRAINING", T, 3), ("EPOCHS", f"{T}.epochs", True), ("EPOCHS", f"{T}.epochs", 0), (None, f"{T}.epochs", 0.5),
    ("LEARNING_RATE", f"{T}.learning_rate", "1e-4"), ("LEARNING_RATE", f"{T}.learning_rate", -1e-5), ("BATCH_SIZE", f"{T}.batch_size", 1.5),
    ("BATCH_SIZE", f"{T}.batch_size", True), ("CUTOFF_LEN", f"{T}.cutoff_len", ...), ("NOT_MAPPING_TRAINING_LORA", LORA, ...),
    ("LORA_RANK", f"{LORA}.rank", 0), ("LORA_ALPHA", f"{LORA}.alpha", "16"), ("LORA_DROPOUT", f"{LORA}.dropout", 1),
    ("LORA_DROPOUT", f"{LORA}.dropout", False), (None, f"{LORA}.dropout", 0.99),
]
VALID = (None, None, None)


def _job_query(name: str, faults, rules) -> None:
    documents = specs(JOB, [VALID, *faults])

    @register(name, expected(documents, "job_id"))
    def run(spark, sf_dir):
        return jobs.violations(jobs.parse_specs(spec_table(spark, sf_dir, documents, "job_id")), rules(), "job_id")


_job_query("reject_unknown_fields", UNKNOWN_FAULTS, jobs.unknown_field_rules)
_job_query("validate_job_identity", IDENTITY_FAULTS, jobs.identity_rules)
_job_query("validate_paths", PATH_FAULTS, jobs.dataset_rules)
_job_query("validate_hyperparameters", HYPER_FAULTS, jobs.hyperparameter_rules)
ALL_JOBS = specs(JOB, [VALID, *UNKNOWN_FAULTS, *IDENTITY_FAULTS, *PATH_FAULTS, *HYPER_FAULTS])
_job_query("validate_job", [*UNKNOWN_FAULTS, *IDENTITY_FAULTS, *PATH_FAULTS, *HYPER_FAULTS], jobs.job_rules)

TRAINING = {
    "method": "lora", "epochs": 3, "learning_rate": 0.0002, "batch_size": 2, "precision": "bf16", "gradient_checkpointing": True,
    "cutoff_len": 2048, "save_steps": 10, "logging_steps": 1, "lora": {"rank": 8, "alpha": 16, "dropout": 0.1}, "attention_backend": "sdpa",
}
FULL = {k: v for k, v in TRAINING.items() if k not in ("lora", "attention_backend")} | {"method": " Full ", "precision": "FP16"}
TRAINING_DOCS = specs(TRAINING, [
    VALID, ("UNKNOWN_FIELD", "seed", 1), ("MISSING_FIELD", "save_steps", ...), ("TEXT_METHOD", "method", 1), ("METHOD_QLORA", "method", "QLoRA"),
    ("METHOD", "method", "dora"), ("PRECISION", "precision", "int8"), ("ATTENTION_BACKEND", "attention_backend", None), ("LORA_REQUIRED", "lora", None),
    ("LORA_NOT_MAPPING", "lora", 8), ("LORA_UNKNOWN_FIELD", "lora.bias", 1), ("LORA_MISSING_FIELD", "lora.alpha", ...),
    ("LORA_DROPOUT", "lora.dropout", 1.0), ("LORA_RANK", "lora.rank", True), ("LORA_ALPHA", "lora.alpha", 0), ("EPOCHS", "epochs", "3"),
    ("LEARNING_RATE", "learning_rate", 0), ("BATCH_SIZE", "batch_size", 2.0), ("GRADIENT_CHECKPOINTING", "gradient_checkpointing", "yes"),
    ("CUTOFF_LEN", "cutoff_len", -1), ("SAVE_STEPS", "save_steps", None), ("LOGGING_STEPS", "logging_steps", 0), (None, "attention_backend", ...),
]) + [(json.dumps(FULL), None), (json.dumps(FULL | {"lora": {}}), "LORA_FORBIDDEN"), ("[]", "NOT_MAPPING")]


def training_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.parse_specs(spec_table(spark, sf_dir, TRAINING_DOCS, "config_id"))


@register("validate_training_config", expected(TRAINING_DOCS, "config_id"))
def q_training(spark, sf_dir):
    return jobs.violations(training_specs(spark, sf_dir), jobs.training_rules(), "config_id")


_V = [i for i, (_, c) in enumerate(TRAINING_DOCS) if c is None]


@register("training_args", f"""WITH v AS (SELECT p_partkey AS config_id, p_partkey % {len(TRAINING_DOCS)} AS i FROM part)
  SELECT config_id, CASE WHEN i = {_V[2]} THEN 'full' ELSE 'lora' END AS finetuning_type, CAST(3 AS DOUBLE) AS num_train_epochs,
   CAST(2 AS BIGINT) AS per_device_train_batch_size, CAST(0.0002 AS DOUBLE) AS learning_rate, i = {_V[2]} AS fp16, i <> {_V[2]} AS bf16,
   false AS disable_gradient_checkpointing, CAST(2048 AS BIGINT) AS cutoff_len, 'epoch' AS save_strategy, CAST(2 AS BIGINT) AS save_total_limit,
   CAST(1 AS BIGINT) AS logging_steps, CASE WHEN i <> {_V[2]} THEN CAST(8 AS BIGINT) END AS lora_rank,
   CASE WHEN i <> {_V[2]} THEN CAST(16 AS BIGINT) END AS lora_alpha, CASE WHEN i <> {_V[2]} THEN CAST(0.1 AS DOUBLE) END AS lora_dropout,
   CASE WHEN i = {_V[0]} THEN 'sdpa' END AS flash_attn FROM v WHERE i IN ({', '.join(map(str, _V))})""")
def q_args(spark, sf_dir):
    return jobs.training_args(jobs.typed_training(training_specs(spark, sf_dir), "config_id"), "config_id")


_OK = [i for i, (_, c) in enumerate(ALL_JOBS) if c is None]
DIGESTS_SQL = "SELECT p_name AS path, sha256(p_name) AS sha256 FROM part WHERE false"
_DOC = [json.loads(t) for t, _ in ALL_JOBS]


def _per_job(value: Callable[[dict], object]) -> str:
    arms = " ".join(f"WHEN {i} THEN {'NULL' if value(_DOC[i]) is None else quoted(value(_DOC[i])) if isinstance(value(_DOC[i]), str) else value(_DOC[i])}" for i in _OK)
    return f"CASE p_partkey % {len(ALL_JOBS)} {arms} END"


_ALLOWED = f"p_partkey % {len(ALL_JOBS)} IN ({', '.join(map(str, _OK))})"


@register("job_manifest", f"""SELECT p_partkey AS job_id, 'example-job' AS job_name, 'Qwen/Qwen2-7B' AS model_name,
   CAST({_per_job(lambda d: d['model'].get('revision'))} AS VARCHAR) AS model_revision,
   {_per_job(lambda d: 'train.' + d['datasets']['train']['path'].lower().rsplit('.', 1)[1])} AS train_file,
   sha256({_per_job(lambda d: d['datasets']['train']['path'])}) AS train_sha256, 'benchmark.json' AS benchmark_file, 'auto' AS benchmark_format,
   sha256('bench.json') AS benchmark_sha256, 'finetune.yaml' AS generated_config FROM part WHERE {_ALLOWED}""")
def q_manifest(spark, sf_dir):
    docs = jobs.parse_specs(spec_table(spark, sf_dir, ALL_JOBS, "job_id"))
    paths = docs.select(F.explode(F.expr(
        "array(try_variant_get(v, '$.datasets.train.path', 'string'), try_variant_get(v, '$.datasets.benchmark.path', 'string'))")).alias("path")).distinct()
    return jobs.job_manifest(docs, paths.select("path", F.sha2("path", 256).alias("sha256")), "job_id")


DEFAULTS = {"method": "lora", "gradient_checkpointing": False, "save_steps": 10, "logging_steps": 1}


@register("effective_config", f"""SELECT p_partkey AS job_id, 'Qwen/Qwen2-7B' AS model_name, 'example-job-train' AS dataset_name, 'auto' AS source_format,
   'auto' AS dataset_format, CAST({_per_job(lambda d: d['training']['epochs'])} AS DOUBLE) AS epochs, CAST(0.00005 AS DOUBLE) AS learning_rate, CAST(1 AS BIGINT) AS batch_size,
   CAST(2048 AS BIGINT) AS cutoff_len, CAST(8 AS BIGINT) AS lora_rank, CAST(16 AS BIGINT) AS lora_alpha,
   CAST({_per_job(lambda d: d['training']['lora']['dropout'])} AS DOUBLE) AS lora_dropout, 'bf16' AS precision,
   'eager' AS attention_backend, CAST(7000000000 AS BIGINT) AS model_parameter_estimate, 'lora' AS method, false AS gradient_checkpointing,
   10 AS save_steps, 1 AS logging_steps FROM part WHERE {_ALLOWED}""")
def q_effective(spark, sf_dir):
    docs = jobs.parse_specs(spec_table(spark, sf_dir, ALL_JOBS, "job_id"))
    catalog = docs.select(F.expr("try_variant_get(v, '$.model.name', 'string')").alias("name")).filter("trim(name) <> ''").distinct().select(
        "name", F.lit("BF16").alias("precision"), F.lit("eager").alias("attention_backend"), F.lit(7_000_000_000).alias("parameter_count"))
    return jobs.effective_config(docs, catalog, DEFAULTS, "job_id")


# ---- capacity -------------------------------------------------------------------------------------------
ACTIVATION, MARGIN = 1048576, 25
SUBTOTAL = f"""(parameter_count * CASE method WHEN 'lora' THEN CASE precision_name WHEN 'fp32' THEN 4 ELSE 2 END + 2
   ELSE CASE precision_name WHEN 'fp32' THEN 4 ELSE 2 END * 2 + 12 END
   + CASE WHEN gradient_checkpointing THEN (batch_size * cutoff_len * {ACTIVATION} + 1) // 2 ELSE batch_size * cutoff_len * {ACTIVATION} END)"""
EST_CTE = f"""est AS (SELECT job_id, parameter_count, precision_name, CAST(({SUBTOTAL} + 1048575) // 1048576 AS BIGINT) AS subtotal_mib,
   CAST((({SUBTOTAL} * {100 + MARGIN} + 99) // 100 + 1048575) // 1048576 AS BIGINT) AS required_training_mib FROM ({JOBS_SQL}))"""


def job_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.view(spark, sf_dir, JOBS_SQL)


def gpu_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.view(spark, sf_dir, GPUS_SQL)


@register("estimate_training", f"WITH {EST_CTE} SELECT job_id, subtotal_mib, required_training_mib FROM est")
def q_estimate(spark, sf_dir):
    return capacity.estimate_training(job_table(spark, sf_dir), ACTIVATION, MARGIN).select("job_id", "subtotal_mib", "required_training_mib")


SERVING_SQL = """SELECT p_partkey AS model_id, CAST(p_size AS BIGINT) * 490000000 AS parameter_count,
   CASE WHEN p_partkey % 2 = 0 THEN 'bf16' ELSE 'fp32' END AS precision_name, p_size AS num_hidden_layers, 1 + p_partkey % 8 AS num_key_value_heads,
   64 AS head_dim, 8192 AS max_position_embeddings, 1024 * (1 + p_partkey % 10) AS max_model_len, 1 + p_partkey % 4 AS max_num_seqs FROM part"""
_B = "(CASE precision_name WHEN 'fp32' THEN 4 ELSE 2 END)"
_W, _KV = f"(parameter_count * {_B})", f"(2 * CAST(num_hidden_layers AS BIGINT) * num_key_value_heads * head_dim * max_model_len * max_num_seqs * {_B})"
_AD = f"(({_W} * 2 + 99) // 100)"
_SUB = f"({_W} + {_AD} + {_KV} + CAST(2048 AS BIGINT) * 1048576)"
_CEIL = lambda x: f"CAST(({x} + 1048575) // 1048576 AS BIGINT)"
SERVING_CTE = f"""srv AS (SELECT *, CASE WHEN max_model_len > max_position_embeddings THEN 'MAX_MODEL_LEN' END AS code, {_CEIL(_W)} AS weight_mib,
   {_CEIL(_AD)} AS adapter_mib, {_CEIL(_KV)} AS kv_cache_mib, CAST({_KV} AS BIGINT) AS kv_cache_bytes, {_CEIL(_SUB)} AS serving_subtotal_mib,
   {_CEIL(f'(({_SUB} * 115 + 99) // 100)')} AS required_serving_mib FROM ({SERVING_SQL}))"""
_EST = ("weight_mib", "adapter_mib", "kv_cache_mib", "kv_cache_bytes", "serving_subtotal_mib", "required_serving_mib")


def serving(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capacity.estimate_serving(fixtures.view(spark, sf_dir, SERVING_SQL), 2048, 2, 15)


@register("estimate_serving", f"WITH {SERVING_CTE} SELECT model_id, code, " + ", ".join(f"CASE WHEN code IS NULL THEN {c} END AS {c}" for c in _EST) + " FROM srv")
def q_serving(spark, sf_dir):
    return serving(spark, sf_dir).select("model_id", "code", *_EST)


GRID = [{"batch_size": b, "cutoff_len": c, "gradient_checkpointing": g} for b in (1, 4) for c in (512, 2048) for g in (True, False)]


@register("sweep", f"""WITH g AS (SELECT * FROM (VALUES {', '.join(f"(CAST({p['batch_size']} AS BIGINT), CAST({p['cutoff_len']} AS BIGINT), {str(p['gradient_checkpointing']).lower()})" for p in GRID)})
     t(batch_size, cutoff_len, gradient_checkpointing)),
   x AS (SELECT job_id, parameter_count, precision_name, method, g.* FROM ({JOBS_SQL}) j, g)
   SELECT job_id, CAST(batch_size AS INT) AS batch_size, CAST(cutoff_len AS INT) AS cutoff_len, gradient_checkpointing,
     CAST((({SUBTOTAL} * {100 + MARGIN} + 99) // 100 + 1048575) // 1048576 AS BIGINT) AS required_training_mib FROM x""")
def q_sweep(spark, sf_dir):
    base = job_table(spark, sf_dir).select("job_id", "parameter_count", "precision_name", "method")
    return capacity.estimate_training(capacity.sweep(base, GRID), ACTIVATION, MARGIN).select(
        "job_id", "batch_size", "cutoff_len", "gradient_checkpointing", "required_training_mib")


DEVICE = pick("job_id", ["'auto'", "'auto'", "'3'", "'auto'", "'999999'", "CAST(job_id % 10 AS STRING)"])
ADMIT_CTE = f"""{EST_CTE}, {SERVING_CTE}, gpu AS ({GPUS_SQL}),
 req AS (SELECT job_id, greatest(required_training_mib, CASE WHEN code IS NULL THEN required_serving_mib ELSE 0 END) AS required_mib,
   {DEVICE} AS device, CASE WHEN code IS NULL THEN required_serving_mib ELSE 0 END AS required_serving_mib FROM est JOIN srv ON model_id = job_id),
 best AS (SELECT * FROM gpu ORDER BY free_mib DESC, position, gpu_index LIMIT 1),
 adm AS (SELECT r.*, CASE WHEN device <> 'auto' AND n.gpu_index IS NULL THEN 'GPU_NOT_FOUND'
     WHEN device = 'auto' AND b.free_mib < required_mib THEN 'NO_GPU' WHEN device <> 'auto' AND n.free_mib < required_mib THEN 'GPU_TOO_SMALL' END AS code,
     CASE device WHEN 'auto' THEN b.gpu_index ELSE n.gpu_index END AS g, CASE device WHEN 'auto' THEN b.free_mib ELSE n.free_mib END AS f,
     CASE device WHEN 'auto' THEN b.total_mib ELSE n.total_mib END AS t, (SELECT count(*) FROM gpu x WHERE x.free_mib < r.required_mib) AS rejected_gpus
   FROM req r CROSS JOIN best b LEFT JOIN gpu n ON device <> 'auto' AND n.gpu_index = TRY_CAST(device AS BIGINT))"""


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    need = F.coalesce("required_serving_mib", F.lit(0)).cast("bigint")
    train = capacity.estimate_training(job_table(spark, sf_dir), ACTIVATION, MARGIN).select("job_id", "required_training_mib")
    serve = serving(spark, sf_dir).select(F.col("model_id").alias("job_id"), need.alias("required_serving_mib"))
    return train.join(serve, "job_id").select(
        "job_id", F.greatest("required_training_mib", "required_serving_mib").alias("required_mib"),
        F.expr(DEVICE).alias("device"), "required_serving_mib")


@register("admit_gpus", f"""WITH {ADMIT_CTE} SELECT job_id, required_mib, device, code, CASE WHEN code IS NULL THEN g END AS gpu_index,
   CASE WHEN code IS NULL THEN f END AS free_mib, CASE WHEN code IS NULL THEN t END AS total_mib, rejected_gpus FROM adm""")
def q_admit(spark, sf_dir):
    return capacity.admit_gpus(requests(spark, sf_dir), gpu_table(spark, sf_dir)).drop("required_serving_mib")


@register("gpu_rejections", f"WITH {ADMIT_CTE} SELECT gpu_index, total_mib, free_mib, (SELECT count(*) FROM req WHERE required_mib > free_mib) AS rejected_jobs FROM gpu")
def q_rejections(spark, sf_dir):
    return capacity.gpu_rejections(requests(spark, sf_dir), gpu_table(spark, sf_dir)).select("gpu_index", "total_mib", "free_mib", "rejected_jobs")


@register("explain_rejections", f"""SELECT gpu_index, free_mib, 'GPU ' || gpu_index || ' rejected: ' || free_mib || ' MiB free; 40000 MiB estimated required' AS reason
  FROM ({GPUS_SQL}) WHERE free_mib < 40000""")
def q_explain(spark, sf_dir):
    return capacity.explain_rejections(gpu_table(spark, sf_dir), 40000)


@register("utilization_bps", f"""WITH {ADMIT_CTE}, u AS (SELECT job_id, greatest((required_serving_mib * 10000 + t - 1) // t, 1000) AS bps FROM adm WHERE code IS NULL)
  SELECT job_id, CAST(bps AS BIGINT) AS utilization_bps, CASE WHEN bps > 9000 THEN 'ABOVE_MAXIMUM' END AS utilization_code FROM u""")
def q_bps(spark, sf_dir):
    admitted = capacity.admit_gpus(requests(spark, sf_dir), gpu_table(spark, sf_dir)).filter("code IS NULL")
    return capacity.utilization_bps(admitted, 1000, 9000).select("job_id", "utilization_bps", "utilization_code")


POLICY = {
    "enabled": True, "model_parameter_estimate": 490000000, "activation_bytes_per_token": 1048576, "safety_margin_percent": 25,
    "model_architecture": ENTRY["architecture"],
    "serving_memory": {"enabled": True, "runtime_overhead_mib": 2048, "adapter_overhead_percent": 2, "safety_margin_percent": 15,
                       "minimum_gpu_memory_utilization": 0.1, "maximum_gpu_memory_utilization": 0.9},
}
SM, MA = "serving_memory", "model_architecture"
POLICY_DOCS = specs(POLICY, [
    VALID, ("UNKNOWN_FIELD", "x", 1), ("ENABLED", "enabled", "yes"), ("DISABLED_WITH_VALUES", "enabled", False), ("DISABLED_WITH_VALUES", "enabled", ...),
    ("PARAMETERS", "model_parameter_estimate", 10**15 + 1), (None, "model_parameter_estimate", 10**15), ("ACTIVATION_BYTES", "activation_bytes_per_token", 0),
    ("SAFETY_MARGIN", "safety_margin_percent", 9), ("SAFETY_MARGIN", "safety_margin_percent", True), (None, MA, None), ("ARCHITECTURE_NOT_MAPPING", MA, 1),
    ("ARCHITECTURE_UNKNOWN", f"{MA}.x", 1), ("ARCHITECTURE_MISSING", f"{MA}.sliding_window", ...), ("ARCHITECTURE_MODEL_TYPE", f"{MA}.model_type", ""),
    ("ARCHITECTURE_HEAD_DIM", f"{MA}.head_dim", 0.5), ("SLIDING_WINDOW", f"{MA}.sliding_window", 0), ("KV_HEADS", f"{MA}.num_key_value_heads", 99),
    (None, SM, None), ("SERVING_NOT_MAPPING", SM, "on"), ("SERVING_FIELDS", f"{SM}.enabled", ...), ("SERVING_ENABLED", f"{SM}.enabled", False),
    ("RUNTIME_OVERHEAD", f"{SM}.runtime_overhead_mib", 0), ("ADAPTER_OVERHEAD", f"{SM}.adapter_overhead_percent", 101), (None, f"{SM}.adapter_overhead_percent", 0),
    ("SERVING_MARGIN", f"{SM}.safety_margin_percent", -1), ("MINIMUM_UTILIZATION", f"{SM}.minimum_gpu_memory_utilization", 0.12345),
    ("MAXIMUM_UTILIZATION", f"{SM}.maximum_gpu_memory_utilization", 1.5), (None, f"{SM}.maximum_gpu_memory_utilization", 1),
    ("UTILIZATION_ORDER", f"{SM}.minimum_gpu_memory_utilization", 0.95),
]) + [('{"enabled": false}', None), ("{}", None), ("[]", "NOT_MAPPING")]


@register("validate_policy", expected(POLICY_DOCS, "policy_id"))
def q_policy(spark, sf_dir):
    return jobs.violations(jobs.parse_specs(spec_table(spark, sf_dir, POLICY_DOCS, "policy_id")), capacity.policy_rules(), "policy_id")
