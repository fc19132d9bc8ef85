"""Model family, template and catalog rules as expressions over tables of models and configs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sft_tables.functions.errors import first_error
from sft_tables.functions.text import is_blank, squeeze, strip
from sft_tables.functions.variants import in_set, is_positive_int, is_text, mapping, unknown_keys

# Family names, templates, config types, instruction markers, catalog fields and choices.
TEMPLATES = {
    "qwen": ("qwen",), "llama": ("llama2", "llama3"), "mistral": ("mistral",), "gemma": ("gemma", "gemma2", "gemma3"),
}
QWEN_TYPES = ("qwen", "qwen2", "qwen2_moe")
GEMMA_TYPES = {"gemma": "gemma", "gemma2": "gemma2", "gemma3": "gemma3", "gemma3_text": "gemma3"}
INSTRUCTION_MARKERS = ("instruct", "chat", "-it", "_it", "assistant")
LLAMA3_VOCABULARY = 100_000
LLAMA2_VOCABULARY = (30_000, 40_000)
HUB_PREFIX = "https://huggingface.co/"
ARCHITECTURE_SIZES = (
    "hidden_size", "num_hidden_layers", "num_attention_heads", "num_key_value_heads", "head_dim", "max_position_embeddings",
)
ARCHITECTURE_FIELDS = ("model_type", *ARCHITECTURE_SIZES, "sliding_window")
PRECISIONS = ("fp32", "fp16", "bf16")
ATTENTION_BACKENDS = ("auto", "eager", "sdpa", "fa2", "fa3")


def _match(family: str, variant: str, template: str | None) -> Column:
    return F.struct(F.lit(family).alias("family"), F.lit(variant).alias("variant"),
                    F.lit(template).cast("string").alias("template"))


def family_from_name(name: Column) -> Column:
    """Struct (family, variant, template); NULL for an unknown family, NULL template for an unclear llama."""
    n = F.replace(F.lower(name), F.lit("_"), F.lit("-"))
    return (
        F.when(n.contains("qwen") & n.rlike(r"qwen[- ]?2[.-]?5"), _match("qwen", "qwen2.5", "qwen"))
        .when(n.contains("qwen") & n.rlike(r"qwen[- ]?2"), _match("qwen", "qwen2", "qwen"))
        .when(n.contains("qwen"), _match("qwen", "qwen", "qwen"))
        .when(n.contains("llama") & n.rlike(r"llama[- .]?2(?:[- ./]|$)"), _match("llama", "llama2", "llama2"))
        .when(n.contains("llama") & n.rlike(r"llama[- .]?3(?:[.-]\d+)?(?:[- ./]|$)"), _match("llama", "llama3", "llama3"))
        .when(n.contains("llama"), _match("llama", "llama", None))
        .when(n.contains("mistral") & ~n.contains("mixtral"), _match("mistral", "mistral", "mistral"))
        .when(n.contains("gemma-3-"), _match("gemma", "gemma3", "gemma3"))
        .when(n.contains("gemma-2-"), _match("gemma", "gemma2", "gemma2"))
        .when(n.contains("gemma"), _match("gemma", "gemma", "gemma"))
    )


def llama_generation(model_name: Column, name_or_path: Column, vocab_size: Column) -> Column:
    """Struct (variant, template, inferred); NULL when Llama 2 and 3 cannot be told apart."""
    named = family_from_name(F.concat_ws(" ", F.nullif(model_name, F.lit("")), F.nullif(name_or_path, F.lit(""))))

    def result(variant, template, inferred: bool) -> Column:
        as_col = lambda x: F.lit(x) if isinstance(x, str) else x
        return F.struct(as_col(variant).alias("variant"), as_col(template).alias("template"), F.lit(inferred).alias("inferred"))

    return (
        F.when(named["template"].isNotNull(), result(named["variant"], named["template"], False))
        .when(vocab_size >= LLAMA3_VOCABULARY, result("llama3", "llama3", True))
        .when(vocab_size.between(*LLAMA2_VOCABULARY), result("llama2", "llama2", True))
    )


def family_from_config(model_name: Column, model_type: Column, architectures: Column, name_or_path: Column,
                       vocab_size: Column) -> Column:
    """Struct (family, variant, template, inferred) from a model config; NULL when it matches nothing."""
    kind = F.lower(model_type)
    named = family_from_name(model_name)
    llama = llama_generation(model_name, name_or_path, vocab_size)
    by_architecture = family_from_name(F.array_join(architectures, " "))

    def result(family, variant, template, inferred=False) -> Column:
        as_col = lambda x: F.lit(x) if not isinstance(x, Column) else x
        return F.struct(as_col(family).alias("family"), as_col(variant).alias("variant"), as_col(template).alias("template"),
                        as_col(inferred).alias("inferred"))

    gemma = F.when(kind == "gemma", "gemma")
    for config_type, template in GEMMA_TYPES.items():
        gemma = gemma.when(kind == config_type, template)
    return (
        F.when(kind.isin(*QWEN_TYPES), result("qwen", F.when(named["family"] == "qwen", named["variant"]).otherwise(kind), "qwen"))
        .when((kind == "llama") & llama.isNotNull(), result("llama", llama["variant"], llama["template"], llama["inferred"]))
        .when(kind == "llama", F.lit(None))
        .when(kind == "mistral", result("mistral", "mistral", "mistral"))
        .when(kind.isin(*GEMMA_TYPES), result("gemma", gemma, gemma))
        .when(by_architecture["template"].isNotNull(),
              result(by_architecture["family"], by_architecture["variant"], by_architecture["template"]))
    )


def instruction_tuned(name: Column) -> Column:
    return F.lower(name).rlike("|".join(INSTRUCTION_MARKERS))


def revision_status(commit_hash: Column, loaded: Column, error: Column) -> Column:
    """Struct (resolved_revision, status, reason)."""
    return F.struct(
        commit_hash.alias("resolved_revision"),
        F.when(commit_hash.isNotNull(), "resolved").otherwise("unavailable").alias("status"),
        F.when(commit_hash.isNotNull(), F.lit(None)).when(~loaded, F.concat(F.lit("lookup failed: "), error))
        .otherwise("no commit hash in config").alias("reason"),
    )


def resolve_compatibility(models: DataFrame, configs: DataFrame) -> DataFrame:
    """One row per model: family, variant, template, source, warnings and revision, or the first error.

    models: model_name, requested_template, requested_revision. configs: model_name, model_type, architectures,
    name_or_path, vocab_size, commit_hash, error (set when the lookup failed; a missing row counts as failed).
    """
    m = models.withColumn("model_name", strip("model_name"))
    j = m.join(configs.withColumn("_found", F.lit(True)), "model_name", "left")
    name = F.col("model_name")
    short = F.substring(F.coalesce(F.nullif(squeeze("error"), F.lit("")), F.lit("config not found")), 1, 240)
    j = j.withColumn("_loaded", F.coalesce("_found", F.lit(False)) & F.col("error").isNull()).withColumn("_error", short)
    j = j.withColumn("n", family_from_name(name)).withColumn("c", F.when(F.col("_loaded"), family_from_config(
        name, F.col("model_type"), F.col("architectures"), F.col("name_or_path"), F.col("vocab_size"))))
    n, c = F.col("n"), F.col("c")
    has_n, has_c, loaded = n.isNotNull(), c.isNotNull(), F.col("_loaded")
    family = F.coalesce(c["family"], n["family"])
    variant = F.when(has_n & has_c, F.when(n["variant"] != n["family"], n["variant"]).otherwise(c["variant"])).otherwise(
        F.coalesce(c["variant"], n["variant"]))
    template = F.coalesce(n["template"], c["template"])
    allowed = F.lit(False)
    for known, templates in TEMPLATES.items():
        allowed = allowed | ((family == known) & template.isin(*templates))
    asked = F.col("requested_template")
    code = first_error([
        ("NAME_BLANK", F.coalesce(is_blank(name), F.lit(True))),
        ("REVISION_BLANK", is_blank("requested_revision")),
        ("LLAMA_GENERATION", loaded & (F.lower("model_type") == "llama") & ~has_c),
        ("FAMILY_CONFLICT", has_n & has_c & (n["family"] != c["family"])),
        ("TEMPLATE_CONFLICT", has_n & has_c & (n["template"] != c["template"])),
        ("CONFIG_UNSUPPORTED", has_n & ~has_c & loaded),
        ("UNRECOGNIZED", ~has_n & ~has_c & ~loaded),
        ("UNSUPPORTED", ~has_n & ~has_c),
        ("TEMPLATE_UNKNOWN", template.isNull()),
        ("TEMPLATE_INCOMPATIBLE", ~allowed),
        ("TEMPLATE_BLANK", is_blank(asked)),
        ("TEMPLATE_MISMATCH", F.replace(F.lower(strip(asked)), F.lit("-"), F.lit("_")) != template),
    ])
    warnings = F.filter(F.array_distinct(F.array(
        F.when(has_n & ~has_c & ~loaded, F.concat(F.lit("CONFIG_UNAVAILABLE: "), F.col("_error"))),
        F.when(c["inferred"], "GENERATION_FROM_VOCABULARY"),
        F.when(~instruction_tuned(name), "NOT_INSTRUCTION_TUNED"),
    )), lambda w: w.isNotNull())
    source = F.when(has_n & has_c, "name+config").when(has_c, "config").otherwise("name")
    kept = j.withColumn("code", code)
    ok = F.col("code").isNull()
    revision = revision_status(F.when(loaded, F.col("commit_hash")), loaded, F.col("_error"))
    carried = [x for x in models.columns if x != "model_name"]
    return kept.select(
        "model_name", *carried, "code", *[F.when(ok, v).alias(a) for a, v in (
            ("family", family), ("variant", variant), ("template", template), ("detection_source", source),
            ("warnings", warnings), ("resolved_revision", revision["resolved_revision"]),
            ("revision_status", revision["status"]), ("revision_reason", revision["reason"]))])


def normalize_model_ref(value: Column) -> Column:
    """Struct (ref, revision) of a model reference; comparison stays case-sensitive."""
    path = F.regexp_replace(F.replace(strip(value), F.lit("\\"), F.lit("/")), r"/+\z", "")
    path = F.when(F.startswith(path, F.lit(HUB_PREFIX)), F.regexp_replace(F.substr(path, F.lit(len(HUB_PREFIX) + 1)), r"/+\z", "")).otherwise(path)
    at_tree, at_mark = F.instr(path, "/tree/"), path.rlike(r"(?s)\A.+@[^@]+\z")
    tree_revision = F.regexp_replace(F.substr(path, at_tree + 6), r"\A/+|/+\z", "")
    return F.struct(
        F.when(at_tree > 0, F.regexp_replace(F.substr(path, F.lit(1), at_tree - 1), r"/+\z", ""))
        .when(at_mark, F.regexp_extract(path, r"(?s)\A(.+)@[^@]+\z", 1)).otherwise(path).alias("ref"),
        F.when(at_tree > 0, F.nullif(tree_revision, F.lit(""))).when(at_mark, F.regexp_extract(path, r"@([^@]+)\z", 1)).alias("revision"),
    )


def validate_catalog(catalog: DataFrame) -> DataFrame:
    """First violation per catalog entry (name, v): v is the entry as a variant."""
    arch = "$.architecture"
    sliding = f"{arch}.sliding_window"
    rules = [
        ("PARAMETER_COUNT", ~is_positive_int("$.parameter_count")),
        ("PRECISION_TEXT", ~is_text("$.precision")),
        ("ATTENTION_TEXT", ~is_text("$.attention_backend")),
        ("ARCHITECTURE_MISSING", mapping(arch).isNull()),
        ("ARCHITECTURE_UNKNOWN_FIELD", unknown_keys(arch, ARCHITECTURE_FIELDS)),
        ("MODEL_TYPE", ~is_text(f"{arch}.model_type")),
        *[(f"SIZE_{f.upper()}", ~is_positive_int(f"{arch}.{f}")) for f in ARCHITECTURE_SIZES],
        ("SLIDING_WINDOW_MISSING", F.expr(f"try_variant_get(v, '{sliding}', 'variant') IS NULL")),
        ("SLIDING_WINDOW", F.expr(f"schema_of_variant(try_variant_get(v, '{sliding}', 'variant')) <> 'VOID'") & ~is_positive_int(sliding)),
        ("KV_HEADS", F.expr(f"try_variant_get(v, '{arch}.num_key_value_heads', 'bigint') > try_variant_get(v, '{arch}.num_attention_heads', 'bigint')")),
        ("PRECISION", ~in_set("$.precision", PRECISIONS)),
        ("ATTENTION_BACKEND", ~in_set("$.attention_backend", ATTENTION_BACKENDS)),
    ]
    return catalog.select("name", first_error(rules).alias("code")).filter("code IS NOT NULL")


def approved_models(jobs: DataFrame, catalog: DataFrame) -> DataFrame:
    """Jobs whose model is not in the catalog."""
    return jobs.join(catalog.select(F.col("name").alias("model_name")), "model_name", "left_anti").withColumn(
        "code", F.lit("MODEL_NOT_APPROVED"))


def catalog_profile(catalog: DataFrame) -> DataFrame:
    """Counts and parameter range by family and precision, with subtotals."""
    return catalog.withColumn("family", F.coalesce(family_from_name(F.col("name"))["family"], F.lit("other"))).rollup(
        "family", "precision").agg(
        F.count(F.lit(1)).alias("models"), F.min("parameter_count").alias("min_parameters"),
        F.max("parameter_count").alias("max_parameters"),
    )
