"""Job specifications and training configs: one JSON document per row, checked by rule columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sft_tables.functions import variants as vr
from sft_tables.functions.errors import first_error
from sft_tables.functions.once import once
from sft_tables.functions.text import strip
from sft_tables.operators.models import ATTENTION_BACKENDS, PRECISIONS

# Allowed fields per section, file extensions, name patterns, method names, defaults.
SECTIONS = {
    "$": ("schema_version", "job", "model", "datasets", "training"),
    "$.job": ("name",),
    "$.model": ("name", "revision"),
    "$.datasets": ("train", "benchmark"),
    "$.datasets.train": ("path", "source_format", "format"),
    "$.datasets.benchmark": ("path", "format"),
    "$.training": ("epochs", "learning_rate", "batch_size", "cutoff_len", "lora"),
    "$.training.lora": ("rank", "alpha", "dropout"),
}
JOB_NAME = "[A-Za-z0-9][A-Za-z0-9._-]{0,62}"
TRAIN_EXTENSIONS = ("json", "jsonl", "ndjson", "csv", "parquet", "pq", "txt", "chatml")
BENCHMARK_EXTENSIONS = ("json", "jsonl", "csv", "parquet")
METHODS = ("lora", "full")
TRAINING_FIELDS = (
    "method", "epochs", "learning_rate", "batch_size", "precision", "gradient_checkpointing", "cutoff_len",
    "save_steps", "logging_steps", "lora", "attention_backend",
)
OPTIONAL_TRAINING_FIELDS = ("lora", "attention_backend")
ATTENTION_ARGUMENT = {"eager": "disabled", "sdpa": "sdpa", "fa2": "fa2", "fa3": "fa3"}

Rules = list[tuple[str, Column]]


def parse_specs(specs: DataFrame, raw: str = "raw") -> DataFrame:
    return once(specs, v=F.try_parse_json(raw)).drop(raw)


def _code(path: str) -> str:
    return path.removeprefix("$").removeprefix(".").replace(".", "_").upper() or "JOB_FILE"


def section_rules(path: str) -> Rules:
    """The section is a mapping without unknown fields."""
    rules: Rules = [(f"NOT_MAPPING_{_code(path)}", vr.mapping(path).isNull())]
    return [*rules, (f"UNKNOWN_FIELD_{_code(path)}", vr.unknown_keys(path, SECTIONS[path]))]


def path_rules(path: str) -> Rules:
    """A normalized relative path: text, forward slashes, no drive, no empty, '.' or '..' part."""
    where, stripped = _code(path), f"regexp_replace({vr.text_at(path)}, '(?U)\\\\A[\\\\s\\\\x1c-\\\\x1f]+|[\\\\s\\\\x1c-\\\\x1f]+\\\\z', '')"
    return [
        (f"TEXT_{where}", ~vr.is_text(path)),
        (f"BACKSLASH_{where}", F.expr(f"contains({stripped}, chr(92))")),
        (f"PATH_{where}", F.expr(
            f"exists(split({stripped}, '/'), p -> p IN ('', '.', '..')) OR contains(split({stripped}, '/')[0], ':')")),
    ]


def extension_rule(path: str, extensions: tuple[str, ...]) -> tuple[str, Column]:
    part = r"(?s).*[^/]\.(?i:" + "|".join(extensions) + ")"
    return f"EXTENSION_{_code(path)}", ~vr.matches(path, part)


def identity_rules() -> Rules:
    return [
        ("SCHEMA_VERSION", ~(vr.is_positive_int("$.schema_version") & F.expr("try_variant_get(v, '$.schema_version', 'bigint') = 1"))),
        *section_rules("$.job"),
        ("TEXT_JOB_NAME", ~vr.is_text("$.job.name")), ("JOB_NAME", ~vr.matches("$.job.name", JOB_NAME)),
        *section_rules("$.model"),
        ("TEXT_MODEL_NAME", ~vr.is_text("$.model.name")),
        ("TEXT_MODEL_REVISION", ~vr.is_null("$.model.revision") & ~vr.is_text("$.model.revision")),
    ]


def dataset_rules() -> Rules:
    train, bench = "$.datasets.train", "$.datasets.benchmark"
    (not_train, unknown_train), (not_bench, unknown_bench) = section_rules(train), section_rules(bench)
    at = lambda path: strip(F.expr(vr.text_at(f"{path}.path")))
    same = at(train) == at(bench)
    return [
        *section_rules("$.datasets"), not_train, not_bench, unknown_train, unknown_bench,
        *path_rules(f"{train}.path"), *path_rules(f"{bench}.path"), ("SAME_FILE", same),
        extension_rule(f"{train}.path", TRAIN_EXTENSIONS), extension_rule(f"{bench}.path", BENCHMARK_EXTENSIONS),
    ]


def hyperparameter_rules() -> Rules:
    t, lora = "$.training", "$.training.lora"
    return [
        *section_rules(t),
        ("EPOCHS", ~vr.is_positive_number(f"{t}.epochs")), ("LEARNING_RATE", ~vr.is_positive_number(f"{t}.learning_rate")),
        ("BATCH_SIZE", ~vr.is_positive_int(f"{t}.batch_size")), ("CUTOFF_LEN", ~vr.is_positive_int(f"{t}.cutoff_len")),
        *section_rules(lora),
        ("LORA_RANK", ~vr.is_positive_int(f"{lora}.rank")), ("LORA_ALPHA", ~vr.is_positive_int(f"{lora}.alpha")),
        ("LORA_DROPOUT", ~vr.is_number_from_zero_below_one(f"{lora}.dropout")),
    ]


def unknown_field_rules() -> Rules:
    return [rule for path in SECTIONS for rule in section_rules(path) if rule[0].startswith("UNKNOWN")]


def job_rules() -> Rules:
    """All rules of a job file in the order they are reported."""
    return [*section_rules("$"), *identity_rules(), *dataset_rules(), *hyperparameter_rules()]


def violations(specs: DataFrame, rules: Rules, key: str) -> DataFrame:
    """First violated rule per document (input has ``v``)."""
    return specs.select(key, first_error(rules).alias("code")).filter("code IS NOT NULL")


def valid(specs: DataFrame, rules: Rules) -> DataFrame:
    return specs.filter(first_error(rules).isNull())


def training_rules() -> Rules:
    """Rules of a full training config."""
    lora = "$.lora"
    is_lora = vr.in_set("$.method", ("lora",))
    rules: Rules = [
        ("NOT_MAPPING", vr.mapping("$").isNull()),
        ("UNKNOWN_FIELD", vr.unknown_keys("$", TRAINING_FIELDS)),
        ("MISSING_FIELD", vr.missing_keys("$", [f for f in TRAINING_FIELDS if f not in OPTIONAL_TRAINING_FIELDS])),
        ("TEXT_METHOD", ~vr.is_text("$.method")),
        ("METHOD_QLORA", vr.in_set("$.method", ("qlora",))),
        ("METHOD", ~vr.in_set("$.method", METHODS)),
        ("PRECISION", ~vr.in_set("$.precision", PRECISIONS)),
        ("ATTENTION_BACKEND", vr.present("$.attention_backend") & ~vr.in_set("$.attention_backend", ATTENTION_BACKENDS)),
        ("LORA_REQUIRED", is_lora & vr.is_null(lora)),
        ("LORA_FORBIDDEN", ~is_lora & ~vr.is_null(lora)),
    ]
    lora_rules = [
        ("LORA_NOT_MAPPING", vr.mapping(lora).isNull()),
        ("LORA_UNKNOWN_FIELD", vr.unknown_keys(lora, SECTIONS["$.training.lora"])),
        ("LORA_MISSING_FIELD", vr.missing_keys(lora, SECTIONS["$.training.lora"])),
        ("LORA_DROPOUT", ~vr.is_number_from_zero_below_one(f"{lora}.dropout")),
        ("LORA_RANK", ~vr.is_positive_int(f"{lora}.rank")), ("LORA_ALPHA", ~vr.is_positive_int(f"{lora}.alpha")),
    ]
    rules += [(code, is_lora & condition) for code, condition in lora_rules]
    return rules + [
        ("EPOCHS", ~vr.is_positive_number("$.epochs")), ("LEARNING_RATE", ~vr.is_positive_number("$.learning_rate")),
        ("BATCH_SIZE", ~vr.is_positive_int("$.batch_size")), ("GRADIENT_CHECKPOINTING", ~vr.is_bool("$.gradient_checkpointing")),
        ("CUTOFF_LEN", ~vr.is_positive_int("$.cutoff_len")), ("SAVE_STEPS", ~vr.is_positive_int("$.save_steps")),
        ("LOGGING_STEPS", ~vr.is_positive_int("$.logging_steps")),
    ]


def typed_training(configs: DataFrame, key: str) -> DataFrame:
    """Valid training configs as typed columns."""
    get = lambda f, t: F.expr(f"try_variant_get(v, '$.{f}', '{t}')")
    choice = lambda f: F.lower(strip(get(f, "string")))
    return valid(configs, training_rules()).select(
        key, choice("method").alias("method"), get("epochs", "double").alias("epochs"),
        get("learning_rate", "double").alias("learning_rate"), get("batch_size", "bigint").alias("batch_size"),
        choice("precision").alias("precision"), get("gradient_checkpointing", "boolean").alias("gradient_checkpointing"),
        get("cutoff_len", "bigint").alias("cutoff_len"), get("save_steps", "bigint").alias("save_steps"),
        get("logging_steps", "bigint").alias("logging_steps"), get("lora.rank", "bigint").alias("lora_rank"),
        get("lora.alpha", "bigint").alias("lora_alpha"), get("lora.dropout", "double").alias("lora_dropout"),
        F.coalesce(choice("attention_backend"), F.lit("auto")).alias("attention_backend"),
    )


def training_args(typed: DataFrame, key: str) -> DataFrame:
    """Trainer arguments of typed training configs."""
    flash = F.lit(None).cast("string")
    for backend, argument in ATTENTION_ARGUMENT.items():
        flash = F.when(F.col("attention_backend") == backend, argument).otherwise(flash)
    return typed.select(
        key, F.col("method").alias("finetuning_type"), F.col("epochs").alias("num_train_epochs"),
        F.col("batch_size").alias("per_device_train_batch_size"), "learning_rate",
        (F.col("precision") == "fp16").alias("fp16"), (F.col("precision") == "bf16").alias("bf16"),
        (~F.col("gradient_checkpointing")).alias("disable_gradient_checkpointing"), "cutoff_len",
        F.lit("epoch").alias("save_strategy"), F.lit(2).cast("bigint").alias("save_total_limit"), "logging_steps",
        "lora_rank", "lora_alpha", "lora_dropout", flash.alias("flash_attn"),
    )


def _suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"(\.[^./]*)\z", 1))


def job_manifest(specs: DataFrame, digests: DataFrame, key: str) -> DataFrame:
    """Prepared file names and digests per valid job; digests: (path, sha256). Missing files give NULL digests."""
    at = lambda p: strip(F.expr(vr.text_at(p)))
    jobs = valid(specs, job_rules()).select(
        key, at("$.job.name").alias("job_name"), at("$.model.name").alias("model_name"), at("$.model.revision").alias("model_revision"),
        at("$.datasets.train.path").alias("train_path"), at("$.datasets.benchmark.path").alias("benchmark_path"),
        F.coalesce(at("$.datasets.benchmark.format"), F.lit("auto")).alias("benchmark_format"),
    )
    train = digests.select(F.col("path").alias("train_path"), F.col("sha256").alias("train_sha256"))
    bench = digests.select(F.col("path").alias("benchmark_path"), F.col("sha256").alias("benchmark_sha256"))
    return jobs.join(train, "train_path", "left").join(bench, "benchmark_path", "left").select(
        key, "job_name", "model_name", "model_revision", F.concat(F.lit("train"), _suffix(F.col("train_path"))).alias("train_file"),
        "train_sha256", F.concat(F.lit("benchmark"), _suffix(F.col("benchmark_path"))).alias("benchmark_file"), "benchmark_format",
        "benchmark_sha256", F.lit("finetune.yaml").alias("generated_config"),
    )


def valid_train_file(name: Column) -> Column:
    return name.rlike(r"\Atrain\.(?:" + "|".join(TRAIN_EXTENSIONS) + r")\z")


def effective_config(specs: DataFrame, catalog: DataFrame, defaults: dict[str, object], key: str) -> DataFrame:
    """Job values over infrastructure defaults, with precision, attention and size from the catalog."""
    t = "$.training"
    get = lambda p, kind: F.expr(f"try_variant_get(v, '{p}', '{kind}')")
    text = lambda p: F.expr(vr.text_at(p))
    jobs = valid(specs, job_rules()).select(
        key, strip(text("$.model.name")).alias("model_name"), F.concat(strip(text("$.job.name")), F.lit("-train")).alias("dataset_name"),
        F.coalesce(text("$.datasets.train.source_format"), F.lit("auto")).alias("source_format"),
        F.coalesce(text("$.datasets.train.format"), F.lit("auto")).alias("dataset_format"),
        get(f"{t}.epochs", "double").alias("epochs"), get(f"{t}.learning_rate", "double").alias("learning_rate"),
        get(f"{t}.batch_size", "bigint").alias("batch_size"), get(f"{t}.cutoff_len", "bigint").alias("cutoff_len"),
        get(f"{t}.lora.rank", "bigint").alias("lora_rank"), get(f"{t}.lora.alpha", "bigint").alias("lora_alpha"),
        get(f"{t}.lora.dropout", "double").alias("lora_dropout"),
    )
    policy = catalog.select(
        F.col("name").alias("model_name"), F.lower("precision").alias("precision"),
        F.lower("attention_backend").alias("attention_backend"), F.col("parameter_count").alias("model_parameter_estimate"))
    return jobs.join(policy, "model_name").select("*", *[F.lit(v).alias(n) for n, v in defaults.items()])
