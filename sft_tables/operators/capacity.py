"""Memory estimates, GPU admission and policy checks; whole numbers only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sft_tables.functions import variants as vr
from sft_tables.functions.carry import running_total
from sft_tables.functions.errors import first_error
from sft_tables.operators.models import ARCHITECTURE_FIELDS, ARCHITECTURE_SIZES

# Byte sizes of the estimate, policy fields and their bounds.
MIB = 1024 * 1024
LORA_EXTRA_BYTES = 2
FULL_WEIGHT_COPIES = 2
FULL_EXTRA_BYTES = 12
POLICY_FIELDS = (
    "enabled", "model_parameter_estimate", "activation_bytes_per_token", "safety_margin_percent", "model_architecture",
    "serving_memory",
)
SERVING_FIELDS = (
    "enabled", "runtime_overhead_mib", "adapter_overhead_percent", "safety_margin_percent",
    "minimum_gpu_memory_utilization", "maximum_gpu_memory_utilization",
)
LARGEST_INTEGER = 10**15
BASIS_POINTS = 10_000


def _wide(c: Column | str | int) -> Column:
    column = F.lit(c) if isinstance(c, int) else F.col(c) if isinstance(c, str) else c
    return column.cast("decimal(38,0)")


def ceil_div(value: Column, divisor: int) -> Column:
    """Integer ceiling; sums of bytes stay decimal until here."""
    total = (value + F.lit(divisor - 1)).cast("decimal(28,0)")
    return F.floor(total / F.lit(divisor).cast("decimal(10,0)")).cast("bigint")


def element_bytes(precision: Column) -> Column:
    return F.when(precision == "fp32", 4).otherwise(2)


def estimate_training(jobs: DataFrame, activation_bytes_per_token: int, margin_percent: int) -> DataFrame:
    """Add subtotal_mib and required_training_mib from parameter_count, precision_name, method, batch_size,
    cutoff_len and gradient_checkpointing."""
    size = element_bytes(F.col("precision_name"))
    per_parameter = F.when(F.col("method") == "lora", size + LORA_EXTRA_BYTES).when(
        F.col("method") == "full", size * FULL_WEIGHT_COPIES + FULL_EXTRA_BYTES)
    activations = _wide("batch_size") * _wide("cutoff_len") * _wide(activation_bytes_per_token)
    kept = F.when(F.col("gradient_checkpointing"), ceil_div(activations, 2)).otherwise(activations)
    subtotal = (_wide("parameter_count") * _wide(per_parameter) + kept).cast("decimal(38,0)")
    required = ceil_div((subtotal * (100 + margin_percent)).cast("decimal(38,0)"), 100)
    return jobs.withColumn("subtotal_mib", ceil_div(subtotal, MIB)).withColumn("required_training_mib", ceil_div(required, MIB))


def estimate_serving(models: DataFrame, runtime_overhead_mib: int, adapter_percent: int, margin_percent: int) -> DataFrame:
    """Add the serving estimate from parameter_count, precision_name, num_hidden_layers, num_key_value_heads,
    head_dim, max_position_embeddings, max_model_len and max_num_seqs; ``code`` where the length exceeds the model."""
    size = _wide(element_bytes(F.col("precision_name")))
    weights = (_wide("parameter_count") * size).cast("decimal(38,0)")
    adapter = _wide(ceil_div((weights * adapter_percent).cast("decimal(38,0)"), 100))
    kv = F.lit(2).cast("decimal(38,0)")
    for factor in ("num_hidden_layers", "num_key_value_heads", "head_dim", "max_model_len", "max_num_seqs"):
        kv = (kv * _wide(factor)).cast("decimal(38,0)")
    kv = (kv * size).cast("decimal(38,0)")
    subtotal = (weights + adapter + kv + _wide(runtime_overhead_mib) * _wide(MIB)).cast("decimal(38,0)")
    required = _wide(ceil_div((subtotal * (100 + margin_percent)).cast("decimal(38,0)"), 100))
    too_long = F.col("max_model_len") > F.col("max_position_embeddings")
    values = {
        "weight_mib": ceil_div(weights, MIB), "adapter_mib": ceil_div(adapter, MIB), "kv_cache_mib": ceil_div(kv, MIB),
        "kv_cache_bytes": kv.cast("bigint"), "serving_subtotal_mib": ceil_div(subtotal, MIB),
        "required_serving_mib": ceil_div(required, MIB),
    }
    return models.select(
        "*", F.when(too_long, "MAX_MODEL_LEN").alias("code"), *[F.when(~too_long, v).alias(n) for n, v in values.items()])


def sweep(models: DataFrame, grid: Sequence[dict[str, object]]) -> DataFrame:
    """Every model with every hyperparameter combination of a given list; each row is expanded in place."""
    names = list(grid[0])
    points = F.array(*[F.struct(*[F.lit(p[n]).alias(n) for n in names]) for p in grid])
    return models.select("*", F.inline(points))


def count_below(values: DataFrame, value: str, thresholds: DataFrame, threshold: str, name: str) -> DataFrame:
    """Add to every threshold row how many values are strictly smaller, without pairing the two tables.

    Both sides are first reduced to counts per distinct whole number, thresholds above the largest value are
    folded onto one point; the running sum goes over blocks of these numbers, so no task holds all of them.
    """
    counted = values.groupBy(F.col(value).alias("at")).agg(F.count(F.lit(1)).alias("n"))
    top = counted.agg(F.max("at") + 1).scalar()
    capped = thresholds.withColumn("_at", F.least(F.col(threshold), top))
    points = counted.unionByName(capped.select(F.col("_at").alias("at")).distinct().withColumn("n", F.lit(0).cast("bigint")))
    totals = points.groupBy("at").agg(F.sum("n").alias("n"))
    running = running_total(totals.withColumn("_all", F.lit(0)), ["_all"], "at", F.col("n"), name).select(F.col("at").alias("_at"), name)
    return capped.join(running, "_at").drop("_at")


def admit_gpus(jobs: DataFrame, gpus: DataFrame) -> DataFrame:
    """Choose a GPU per job: jobs (job_id, required_mib, device), gpus (gpu_index, free_mib, total_mib).

    ``device`` is 'auto' or an index. The GPU with the most free memory (the first listed on ties: by a column
    ``position``, or else by index) serves every
    automatic job it is large enough for, and if it is too small no other one fits, so automatic jobs need
    one row of the inventory (a scalar subquery); explicit requests are an equi-join. ``rejected_gpus`` counts the GPUs with too
    little free memory.
    """
    listed = F.col("position" if "position" in gpus.columns else "gpu_index")
    best = gpus.agg(F.max(F.struct("free_mib", (-listed).alias("o"), (-F.col("gpu_index")).alias("i"), "gpu_index", "total_mib"))).scalar()
    with_best = jobs.withColumn("best", best)
    asked = F.when(F.col("device") != "auto", F.col("device").try_cast("bigint"))
    named = gpus.select(F.col("gpu_index").alias("_asked"), F.struct("free_mib", "gpu_index", "total_mib").alias("named"))
    joined = with_best.withColumn("_asked", asked).join(named, "_asked", "left")
    pick = F.when(F.col("device") == "auto", F.struct("best.free_mib", "best.gpu_index", "best.total_mib")).otherwise(F.col("named"))
    judged = joined.withColumn("pick", pick).withColumn("code", first_error([
        ("GPU_NOT_FOUND", (F.col("device") != "auto") & F.col("named").isNull()),
        ("NO_GPU", (F.col("device") == "auto") & F.coalesce(F.col("pick.free_mib") < F.col("required_mib"), F.lit(True))),
        ("GPU_TOO_SMALL", F.col("pick.free_mib") < F.col("required_mib")),
    ]))
    ok = F.col("code").isNull()
    chosen = judged.select(
        *jobs.columns, "code", F.when(ok, F.col("pick.gpu_index")).alias("gpu_index"),
        F.when(ok, F.col("pick.free_mib")).alias("free_mib"), F.when(ok, F.col("pick.total_mib")).alias("total_mib"))
    return count_below(gpus, "free_mib", chosen, "required_mib", "rejected_gpus")


def gpu_rejections(jobs: DataFrame, gpus: DataFrame) -> DataFrame:
    """Per GPU: how many jobs it is too small for (its free memory is below what they require)."""
    total = jobs.agg(F.count(F.lit(1))).scalar()
    fits = count_below(jobs, "required_mib", gpus.withColumn("_above", F.col("free_mib") + 1), "_above", "_fitting")
    return fits.select(*gpus.columns, (total - F.col("_fitting")).alias("rejected_jobs"))


def explain_rejections(gpus: DataFrame, required_mib: int) -> DataFrame:
    """The rejected GPUs of one requirement with the reason text."""
    reason = F.concat(F.lit("GPU "), "gpu_index", F.lit(" rejected: "), "free_mib", F.lit(f" MiB free; {required_mib} MiB estimated required"))
    return gpus.filter(F.col("free_mib") < required_mib).select("gpu_index", "free_mib", reason.alias("reason"))


def utilization_bps(admitted: DataFrame, minimum_bps: int, maximum_bps: int) -> DataFrame:
    """Serving share of the chosen GPU in basis points, at least the minimum; ``utilization_code`` above the maximum."""
    needed = F.floor((_wide("required_serving_mib") * BASIS_POINTS + F.col("total_mib") - 1).cast("decimal(28,0)")
                     / F.col("total_mib").cast("decimal(10,0)")).cast("bigint")
    share = F.greatest(needed, F.lit(minimum_bps).cast("bigint"))
    return admitted.withColumn("utilization_bps", share).withColumn(
        "utilization_code", F.when(F.col("utilization_bps") > maximum_bps, "ABOVE_MAXIMUM"))


def _bounded(path: str, low: int, high: int) -> Column:
    value = F.expr(f"try_variant_get(v, '{path}', 'decimal(38,0)')")
    return F.coalesce(vr.is_positive_int(path) | F.expr(f"schema_of_variant(try_variant_get(v, '{path}', 'variant')) = 'BIGINT'"), F.lit(False)) \
        & F.coalesce(value.between(low, high), F.lit(False))


def _basis_points(path: str) -> Column:
    """A share that is a whole number of basis points between 1 and 10000."""
    value = f"try_variant_get(v, '{path}', 'double')"
    kind = f"schema_of_variant(try_variant_get(v, '{path}', 'variant'))"
    return F.expr(
        f"coalesce(({kind} IN ('BIGINT', 'DOUBLE', 'FLOAT') OR {kind} LIKE 'DECIMAL%') AND bround({value} * {BASIS_POINTS}) "
        f"BETWEEN 1 AND {BASIS_POINTS} AND bround({value} * {BASIS_POINTS}) / {BASIS_POINTS} = {value}, false)")


def policy_rules() -> list[tuple[str, Column]]:
    """Rules of a resource policy document in report order."""
    off = F.expr("coalesce(try_variant_get(v, '$.enabled', 'boolean'), false) = false")
    arch, serving = "$.model_architecture", "$.serving_memory"
    low, high = f"{serving}.minimum_gpu_memory_utilization", f"{serving}.maximum_gpu_memory_utilization"
    has_arch, has_serving = ~vr.is_null(arch), ~vr.is_null(serving)
    rules = [
        ("NOT_MAPPING", vr.mapping("$").isNull()), ("UNKNOWN_FIELD", vr.unknown_keys("$", POLICY_FIELDS)),
        ("ENABLED", vr.present("$.enabled") & ~vr.is_bool("$.enabled")),
        ("DISABLED_WITH_VALUES", off & vr.unknown_keys("$", ("enabled",))),
    ]
    on: list[tuple[str, Column]] = [
        ("PARAMETERS", ~_bounded("$.model_parameter_estimate", 1, LARGEST_INTEGER)),
        ("ACTIVATION_BYTES", ~_bounded("$.activation_bytes_per_token", 1, LARGEST_INTEGER)),
        ("SAFETY_MARGIN", ~_bounded("$.safety_margin_percent", 10, 100)),
        ("ARCHITECTURE_NOT_MAPPING", has_arch & vr.mapping(arch).isNull()),
        ("ARCHITECTURE_UNKNOWN", has_arch & vr.unknown_keys(arch, ARCHITECTURE_FIELDS)),
        ("ARCHITECTURE_MISSING", has_arch & vr.missing_keys(arch, ARCHITECTURE_FIELDS)),
        ("ARCHITECTURE_MODEL_TYPE", has_arch & ~vr.is_text(f"{arch}.model_type")),
        *[(f"ARCHITECTURE_{f.upper()}", has_arch & ~_bounded(f"{arch}.{f}", 1, LARGEST_INTEGER)) for f in ARCHITECTURE_SIZES],
        ("SLIDING_WINDOW", has_arch & ~vr.is_null(f"{arch}.sliding_window") & ~_bounded(f"{arch}.sliding_window", 1, LARGEST_INTEGER)),
        ("KV_HEADS", has_arch & F.expr(f"try_variant_get(v, '{arch}.num_key_value_heads', 'bigint') > try_variant_get(v, '{arch}.num_attention_heads', 'bigint')")),
        ("SERVING_NOT_MAPPING", has_serving & vr.mapping(serving).isNull()),
        ("SERVING_FIELDS", has_serving & (vr.unknown_keys(serving, SERVING_FIELDS) | vr.missing_keys(serving, SERVING_FIELDS))),
        ("SERVING_ENABLED", has_serving & F.expr(f"coalesce(NOT try_variant_get(v, '{serving}.enabled', 'boolean'), true)")),
        ("RUNTIME_OVERHEAD", has_serving & ~_bounded(f"{serving}.runtime_overhead_mib", 1, LARGEST_INTEGER)),
        ("ADAPTER_OVERHEAD", has_serving & ~_bounded(f"{serving}.adapter_overhead_percent", 0, 100)),
        ("SERVING_MARGIN", has_serving & ~_bounded(f"{serving}.safety_margin_percent", 0, 100)),
        ("MINIMUM_UTILIZATION", has_serving & ~_basis_points(low)), ("MAXIMUM_UTILIZATION", has_serving & ~_basis_points(high)),
        ("UTILIZATION_ORDER", has_serving & F.expr(f"try_variant_get(v, '{low}', 'double') > try_variant_get(v, '{high}', 'double')")),
    ]
    return rules + [(code, ~off & condition) for code, condition in on]
