"""Run records, artifacts, ownership and registrations as table operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sft_tables.functions import variants as vr
from sft_tables.functions.carry import running_total
from sft_tables.functions.errors import first_error
from sft_tables.functions.once import once
from sft_tables.functions.text import last_path_part, nonblank, safe_identifier, slug, strip
from sft_tables.operators.models import normalize_model_ref

# States, metric names and documents, artifact names, result fields.
TERMINAL = ("success", "failed")
METRICS = {
    "train_loss": "train_loss", "train_runtime": "train_runtime", "train_samples_per_second": "train_samples_per_second",
    "train_steps_per_second": "train_steps_per_second", "final_epoch": "epoch", "global_step": "global_step",
}
METRIC_DOCUMENTS = ("train_results.json", "all_results.json", "trainer_state.json")
LORA_CONFIG, LORA_WEIGHTS = "model/adapter_config.json", "model/adapter_model.safetensors"
FULL_CONFIG = "model/config.json"
FULL_WEIGHTS = r"\Amodel/(?:model\.safetensors|model-[^/]*\.safetensors|pytorch_model\.bin|pytorch_model-[^/]*\.bin)\z"
CHECKPOINT = r"\Amodel/(checkpoint-[^/]*)/"
PUBLIC_NAME = r"\A[A-Za-z0-9][A-Za-z0-9._-]{0,127}\z"
RESULT_TEXT_FIELDS = ("run_id", "run_directory", "model_directory", "metadata_path")
# any JSON value keeps its text where a section's fields are free
METADATA_SCHEMA = (
    "schema_version INT, run_id STRING, pipeline_id STRING, status STRING, created_at STRING, updated_at STRING, completed_at STRING, "
    "model STRUCT<name: STRING, family: STRING, template: STRING, requested_revision: STRING, resolved_revision: STRING, "
    "revision_status: STRING>, dataset STRUCT<path: STRING, name: STRING, source_format: STRING, format: STRING, "
    "num_samples: BIGINT, sha256: STRING>, training VARIANT, output STRUCT<model_dir: STRING, "
    "verified_artifacts: ARRAY<STRING>>, environment VARIANT, container VARIANT, resources VARIANT, artifact VARIANT, serving VARIANT, "
    "gateway VARIANT, phases MAP<STRING, STRUCT<status: STRING>>, "
    "training_metrics MAP<STRING, STRING>, error STRUCT<type: STRING, message: STRING>"
)


def scan_runs(spark: SparkSession, root: str, name: str = "metadata.json") -> DataFrame:
    """One row per ``<root>/<run>/metadata.json``; the folder name is the run. Sections with free fields are variants."""
    path = F.col("_metadata.file_path")
    return spark.read.schema(METADATA_SCHEMA).json(f"{root}/*/{name}", multiLine=True).select(
        F.element_at(F.split(path, "/"), -2).alias("run_folder"), "*")


def base_run_id(created_at: Column, model_name: Column, dataset_name: Column) -> Column:
    return F.concat_ws("_", F.date_format(created_at, "yyyyMMdd_HHmmss"), slug(last_path_part(model_name), "model"),
                       slug(dataset_name, "dataset"))


def _held_attempts(existing: DataFrame) -> DataFrame:
    """(base_id, attempt) of existing run ids: the bare id is attempt 1, ``_02`` and so on the later ones."""
    suffix = F.regexp_extract("run_id", r"_(\d{2,})\z", 1)
    parts = F.size(F.split("run_id", "_"))
    attempt = F.when(parts == 5, suffix.try_cast("bigint")).otherwise(F.lit(1).cast("bigint"))
    known = (parts == 4) | ((parts == 5) & (attempt >= 2) & (suffix == F.format_string("%02d", attempt)))
    taken = once(
        existing.select("run_id").distinct(),
        base_id=F.when(parts == 5, F.regexp_replace("run_id", r"_\d{2,}\z", "")).otherwise(F.col("run_id")),
        attempt=attempt, known=known)
    return taken.filter("known").select("base_id", "attempt")


def _passed_by_marks(wanted: DataFrame, gaps: DataFrame) -> DataFrame:
    """Gaps below k per request by one running total over requests and gaps together, for bases of any size."""
    # at equal values the gap comes after the request: it has to be strictly smaller
    marks = wanted.select("base_id", (F.col("_k") * 2).alias("_at"), "request_id", F.lit(0).cast("bigint").alias("_held")).unionByName(
        gaps.groupBy("base_id", (F.col("_gap") * 2 + 1).alias("_at")).agg(F.count(F.lit(1)).alias("_held")).withColumn(
            "request_id", F.lit(None).cast("bigint")))
    counted = running_total(marks, ["base_id"], "_at", F.col("_held"), "_passed").filter("request_id IS NOT NULL")
    return counted.select("request_id", "base_id", (F.col("_at") / 2 + F.col("_passed")).cast("bigint").alias("attempt"))


def assign_run_ids(requests: DataFrame, existing: DataFrame) -> DataFrame:
    """Run ids for requests (request_id BIGINT, created_at, model_name, dataset_name) next to existing (run_id).

    The k-th request of a base id takes the k-th attempt number that no existing run holds. If the existing
    attempts are e1 < e2 < .., that number is k plus the count of j with e_j - j < k; one running total over requests
    and these gaps counts for all bases, of any size.
    """
    base = base_run_id(F.col("created_at"), F.col("model_name"), F.col("dataset_name"))
    numbered = running_total(requests.withColumn("base_id", base), ["base_id"], "request_id", F.lit(1), "_before")
    wanted = numbered.select("request_id", "base_id", (F.col("_before") + 1).alias("_k"))
    held = _held_attempts(existing)
    gaps = running_total(held, ["base_id"], "attempt", F.lit(1), "_before").select(
        "base_id", (F.col("attempt") - F.col("_before") - 1).alias("_gap"))
    numbers = _passed_by_marks(wanted, gaps)
    run_id = F.when(F.col("attempt") == 1, F.col("base_id")).otherwise(
        F.concat_ws("_", "base_id", F.format_string("%02d", "attempt")))
    return numbers.select("request_id", "base_id", "attempt", run_id.alias("run_id"))


def run_status_latest(events: DataFrame) -> DataFrame:
    """Latest status per run from (run_id, ts, seq, status); completed_at is the last terminal time."""
    order = F.struct("ts", "seq")
    return events.groupBy("run_id").agg(
        F.max_by("status", order).alias("status"), F.max("ts").alias("updated_at"),
        F.max(F.when(F.col("status").isin(*TERMINAL), F.col("ts"))).alias("completed_at"))


def phase_status(events: DataFrame) -> DataFrame:
    """Merged phase sections from (run_id, phase, seq, status, details MAP, error_type, error_message): the last
    status, per key the last detail, the last error."""
    key = ["run_id", "phase"]
    failed = F.when(F.col("error_type").isNotNull(), F.col("seq"))
    sections = events.groupBy(*key).agg(
        F.max_by("status", "seq").alias("status"), F.max_by("error_type", failed).alias("error_type"),
        F.max_by("error_message", failed).alias("error_message"))
    details = (
        events.select(*key, "seq", F.explode("details").alias("k", "v")).groupBy(*key, "k")
        .agg(F.max_by("v", "seq").alias("v")).groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("details"))
    )
    return sections.join(details, key, "left")


def phase_pivot(events: DataFrame, phases: tuple[str, ...] = ("training", "serving", "gateway")) -> DataFrame:
    """Last status of each phase, one row per run."""
    return events.groupBy("run_id").agg(*[
        F.max_by("status", F.when(F.col("phase") == p, F.col("seq"))).alias(p) for p in phases])


def preferred_handoff(events: DataFrame) -> DataFrame:
    """The manifest to hand on per run, from (run_id, source, manifest, seq): gateway before serving, then the latest."""
    order = F.struct((F.col("source") == "gateway").alias("g"), F.col("seq"))
    return events.groupBy("run_id").agg(F.max_by(F.struct("source", "manifest"), order).alias("h")).select("run_id", "h.*")


def _number(path: str) -> str:
    kind = f"schema_of_variant(try_variant_get(v, '{path}', 'variant'))"
    return f"CASE WHEN {kind} IN ('BIGINT', 'DOUBLE', 'FLOAT') OR {kind} LIKE 'DECIMAL%' THEN try_variant_get(v, '{path}', 'double') END"


def training_metrics(documents: DataFrame) -> DataFrame:
    """Six final metrics per run from (run_id, file_name, raw). Documents are asked in their fixed order and the
    first numeric value wins; booleans are no numbers."""
    docs = once(documents, v=F.try_parse_json("raw")).drop("raw")
    is_object = F.expr("try_variant_get(v, '$', 'map<string,variant>') IS NOT NULL")
    values = docs.select("run_id", "file_name", is_object.alias("ok"),
                         *[F.expr(_number(f"$.{key}")).alias(name) for name, key in METRICS.items()],
                         F.expr("try_variant_get(v, '$.log_history', 'array<variant>') IS NOT NULL").alias("has_history"))
    at = lambda doc: (F.col("file_name") == doc) & F.col("ok")
    merged = values.groupBy("run_id").agg(
        *[F.coalesce(*[F.max(F.when(at(d), F.col(m))) for d in METRIC_DOCUMENTS]).alias(m) for m in METRICS],
        *[F.max(at(d)).alias(f"_has_{i}") for i, d in enumerate(METRIC_DOCUMENTS)],
        F.max(at(METRIC_DOCUMENTS[2]) & F.col("has_history")).alias("_history"),
        F.count_if(~F.col("ok")).alias("unreadable_documents"),
    )
    sources = F.filter(F.array(*[F.when(F.col(f"_has_{i}"), d) for i, d in enumerate(METRIC_DOCUMENTS)]), lambda x: x.isNotNull())
    return merged.select("run_id", *METRICS, sources.alias("source_artifacts"),
                         F.when(F.col("_history"), METRIC_DOCUMENTS[2]).alias("log_history_artifact"), "unreadable_documents")


def metric_history(states: DataFrame) -> DataFrame:
    """Logged steps per run from (run_id, raw trainer state)."""
    docs = once(states, v=F.try_parse_json("raw")).drop("raw")
    rows = docs.select("run_id", F.posexplode(F.expr("try_variant_get(v, '$.log_history', 'array<variant>')")).alias("entry", "e"))
    get = lambda f, t: F.expr(f"try_variant_get(e, '$.{f}', '{t}')").alias(f)
    return rows.select("run_id", F.col("entry").cast("bigint").alias("entry"), get("step", "bigint"), get("epoch", "double"),
                       get("loss", "double"), get("learning_rate", "double"))


def metric_curves(history: DataFrame) -> DataFrame:
    """Loss curve per run from ``metric_history`` rows: the change against the logged loss before, the lowest so far and
    the step it was logged at (the first of equal ones). Entries without a finite loss are no points. A run's history comes
    from one document, so a window holds no more than that."""
    points = history.filter("loss IS NOT NULL AND NOT isnan(loss) AND abs(loss) <> double('inf')")
    by_run = Window.partitionBy("run_id").orderBy("entry")
    so_far = by_run.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    best = F.min(F.struct(F.col("loss"), F.col("entry"), F.col("step"))).over(so_far)
    return points.select("run_id", "entry", "step", "loss", (F.col("loss") - F.lag("loss").over(by_run)).alias("change"), best.alias("_best")).select(
        "run_id", "entry", "step", "loss", "change", F.col("_best.loss").alias("best_loss"), F.col("_best.step").alias("best_step"))


def report_context(runs: DataFrame) -> DataFrame:
    """Non-secret training facts; a missing, negative or non-finite duration is NULL, lora only where present."""
    d = F.col("duration_seconds")
    clean = F.when(d.isNotNull() & ~F.isnan(d) & (d >= 0) & (d != float("inf")), d)
    lora = F.when(F.col("lora_rank").isNotNull(), F.struct(
        F.col("lora_rank").alias("rank"), F.col("lora_alpha").alias("alpha"), F.col("lora_dropout").alias("dropout")))
    return runs.select(
        "run_id", F.lit(1).alias("schema_version"), clean.alias("training_duration_seconds"),
        F.struct("model_name", F.col("epochs").cast("double").alias("epochs"), F.col("learning_rate").cast("double").alias("learning_rate"),
                 "batch_size", "cutoff_len", lora.alias("lora")).alias("training"))


def _largest(path: str) -> Column:
    """Aggregate: size of a file of the run, NULL when it is absent."""
    return F.max(F.when(F.col("rel_path") == path, F.col("size")))


def validate_lora(files: DataFrame, configs: DataFrame, runs: DataFrame) -> DataFrame:
    """First artifact error (or NULL) per run with method lora.

    files: run_id, rel_path, size. configs: run_id, raw adapter config. runs: run_id, base_model,
    requested_revision, resolved_revision.
    """
    sizes = files.filter(F.col("rel_path").isin(LORA_CONFIG, LORA_WEIGHTS)).groupBy("run_id").agg(
        _largest(LORA_CONFIG).alias("config_size"), _largest(LORA_WEIGHTS).alias("weight_size"))
    docs = once(configs, v=F.try_parse_json("raw")).drop("raw")
    declared = normalize_model_ref(F.expr(vr.text_at("$.base_model_name_or_path")))
    read = docs.select(
        "run_id", vr.mapping("$").isNotNull().alias("is_object"), vr.is_positive_int("$.r").alias("rank_ok"),
        vr.is_text("$.base_model_name_or_path").alias("base_ok"),
        (vr.is_null("$.revision") | vr.is_text("$.revision")).alias("revision_ok"),
        declared["ref"].alias("declared"), F.coalesce(strip(F.expr(vr.text_at("$.revision"))), declared["revision"]).alias("declared_revision"))
    want = normalize_model_ref(F.col("base_model"))
    accepted = F.filter(F.array(strip("requested_revision"), strip("resolved_revision"), F.col("_want.revision")), lambda r: nonblank(r))
    # the planner sees little of what a parsed text holds, and would broadcast tables as long as ``runs``
    joined = runs.withColumn("_want", want).join(sizes.hint("merge"), "run_id", "left").join(read.hint("merge"), "run_id", "left")
    known = lambda c: F.coalesce(F.col(c), F.lit(False))
    code = first_error([
        ("CONFIG_MISSING", F.col("config_size").isNull()), ("CONFIG_EMPTY", F.col("config_size") == 0),
        ("CONFIG_NOT_OBJECT", ~known("is_object")), ("RANK", ~known("rank_ok")), ("BASE_MODEL_TEXT", ~known("base_ok")),
        ("REVISION_TEXT", ~known("revision_ok")), ("BASE_MODEL_DIFFERS", F.col("declared") != F.col("_want.ref")),
        ("REVISION_DIFFERS", (F.size(accepted) > 0) & ~F.array_contains(accepted, F.col("declared_revision"))),
        ("WEIGHTS_MISSING", F.col("weight_size").isNull()), ("WEIGHTS_EMPTY", F.col("weight_size") == 0),
    ])
    return joined.select("run_id", code.alias("code"))


def validate_full(files: DataFrame, runs: DataFrame) -> DataFrame:
    """First artifact error (or NULL) and the number of weight files per run with method full."""
    weights = F.col("rel_path").rlike(FULL_WEIGHTS) & (F.col("size") > 0)
    found = files.groupBy("run_id").agg(
        _largest(FULL_CONFIG).alias("config_size"), F.count_if(weights).alias("weight_files"))
    code = first_error([
        ("CONFIG_MISSING", F.col("config_size").isNull()), ("CONFIG_EMPTY", F.col("config_size") == 0),
        ("WEIGHTS_MISSING", F.col("weight_files") == 0),
    ])
    return runs.select("run_id").join(found, "run_id", "left").select(
        "run_id", code.alias("code"), F.coalesce("weight_files", F.lit(0)).cast("bigint").alias("weight_files"))


def reclaimable_checkpoints(files: DataFrame, runs: DataFrame) -> DataFrame:
    """Checkpoint folders of verified runs with their size; a report, nothing is deleted."""
    verified = runs.filter("status = 'success'").select("run_id")
    folder = F.regexp_extract("rel_path", CHECKPOINT, 1)
    sizes = files.withColumn("checkpoint", folder).filter("checkpoint <> ''").groupBy("run_id", "checkpoint").agg(
        F.sum("size").cast("bigint").alias("bytes"), F.count(F.lit(1)).alias("files"))
    return sizes.join(verified, "run_id", "left_semi")


def storage_by_run(files: DataFrame) -> DataFrame:
    """Bytes per run and top folder; rows flagged as links do not count."""
    kept = files.filter("NOT is_link") if "is_link" in files.columns else files
    return kept.groupBy("run_id", F.substring_index("rel_path", "/", 1).alias("tree")).agg(
        F.sum("size").cast("bigint").alias("bytes"), F.count(F.lit(1)).alias("files"))


def discover_targets(requests: DataFrame, claims: DataFrame, executions: DataFrame, owners: DataFrame) -> DataFrame:
    """Runs and executions to clean up per request: (request_id, kind, id).

    requests: request_id, run_id, execution_id, pipeline_id (NULL where not asked for). One pass: ids found on
    the way are not followed further. Every lookup is an equi-join on one requested id.
    """
    by_execution = requests.filter("execution_id IS NOT NULL").select("request_id", F.col("execution_id").alias("_key"))
    by_pipeline = requests.filter("pipeline_id IS NOT NULL").select("request_id", F.col("pipeline_id").cast("string").alias("_key"))

    def matches(table: DataFrame, execution: str, pipeline: str, *columns: str) -> DataFrame:
        first = table.withColumn("_key", F.col(execution)).join(by_execution, "_key")
        second = table.withColumn("_key", F.col(pipeline).cast("string")).join(by_pipeline, "_key")
        return first.unionByName(second).select("request_id", *columns)

    def ids(found: DataFrame, kind: str, column: str) -> DataFrame:
        return found.select("request_id", F.lit(kind).alias("kind"), F.col(column).cast("string").alias("id"))

    claimed = matches(claims, "execution_id", "pipeline_id", "execution_id")
    executed = matches(executions, "execution_id", "pipeline_id", "execution_id", "run_id")
    owned = matches(owners, "execution_id", "pipeline_id", "execution_id", "run_id")
    parts = [
        ids(requests, "run", "run_id"), ids(requests, "execution", "execution_id"), ids(claimed, "execution", "execution_id"),
        ids(executed, "execution", "execution_id"), ids(executed, "run", "run_id"), ids(owned, "run", "run_id"),
        ids(owned, "execution", "execution_id"),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.filter("id IS NOT NULL").distinct()


def owned_resources(requests: DataFrame, targets: DataFrame, resources: DataFrame) -> DataFrame:
    """Resources labelled with a target run, a target execution or the requested pipeline: (request_id, resource_id).

    Every resource is read once, as one row per label that it has; one equi-join finds the requests. Pairs leave the join
    before equal ones are put together: a label that many requests want makes far more pairs than its task has read.
    """
    label = lambda kind, column: F.struct(F.lit(kind).alias("kind"), F.col(column).cast("string").alias("id"))
    labels = F.array(label("run", "run_id"), label("execution", "execution_id"), label("pipeline", "pipeline_id"))
    labelled = resources.select("resource_id", F.inline(labels)).filter("id IS NOT NULL")
    pipelines = requests.filter("pipeline_id IS NOT NULL").select("request_id", label("pipeline", "pipeline_id").alias("l")).select("request_id", "l.*")
    wanted = targets.select("request_id", "kind", "id").unionByName(pipelines)
    return labelled.join(wanted, ["kind", "id"]).select("request_id", "resource_id").repartition("request_id", "resource_id").distinct()


def leftovers(requests: DataFrame, targets: DataFrame, later: DataFrame) -> DataFrame:
    """Owned resources still present in a later snapshot, counted per request."""
    return owned_resources(requests, targets, later).groupBy("request_id").agg(F.count(F.lit(1)).alias("remaining"))


def reconcile_registrations(desired: DataFrame, listing: DataFrame) -> DataFrame:
    """Outcome per desired (alias, run_id, role) against a listing (model_name, registration_id, pipeline_run_id,
    pipeline_role): a foreign owner is a conflict, one own record created, several indeterminate, none absent.
    The listing is counted before it is joined."""
    totals = listing.groupBy(F.col("model_name").alias("alias")).agg(F.count(F.lit(1)).alias("_all"))
    own = listing.groupBy(
        F.col("model_name").alias("alias"), F.col("pipeline_run_id").alias("run_id"), F.col("pipeline_role").alias("role"),
    ).agg(F.count(F.lit(1)).alias("_own"), F.max("registration_id").alias("registration_id"))
    joined = desired.join(totals, "alias", "left").join(own, ["alias", "run_id", "role"], "left")
    owned, everything = F.coalesce("_own", F.lit(0)), F.coalesce("_all", F.lit(0))
    outcome = F.when(everything > owned, "conflict").when(owned == 1, "created").when(owned > 1, "indeterminate").otherwise("absent")
    return joined.select("alias", "run_id", "role", outcome.alias("outcome"),
                         F.when(outcome == "created", F.col("registration_id")).alias("registration_id"))


def alias_conflicts(desired: DataFrame, management: DataFrame, public: DataFrame) -> DataFrame:
    """Desired aliases that the management or the public listing already has."""
    existing = management.select(F.col("model_name").alias("alias")).unionByName(public.select(F.col("id").alias("alias"))).distinct()
    return desired.join(existing, "alias", "left_semi")


def derive_aliases(runs: DataFrame) -> DataFrame:
    """Serving names from (run_id, base_model, base_name, fine_tuned_name); a name of 'auto' or NULL is derived."""
    trace = safe_identifier("run_id", "run", 40)
    derived = F.concat(safe_identifier(last_path_part("base_model"), "base", 72), F.lit("-"), trace)
    auto = lambda c, fallback: F.when(F.coalesce(F.col(c), F.lit("auto")) == "auto", fallback).otherwise(F.col(c))
    named = runs.withColumn("base_alias", auto("base_name", derived))
    named = named.withColumn("fine_tuned_alias", auto("fine_tuned_name", F.concat(
        safe_identifier("base_alias", "model", 80), F.lit("-finetuned"))))
    return named.select("run_id", "base_alias", "fine_tuned_alias", F.concat(F.lit("ft-serving-"), trace).alias("container_name"),
                        first_error([
                            ("BASE_NAME", ~F.col("base_alias").rlike(PUBLIC_NAME)), ("FINE_TUNED_NAME", ~F.col("fine_tuned_alias").rlike(PUBLIC_NAME)),
                            ("SAME_ALIAS", F.col("base_alias") == F.col("fine_tuned_alias")),
                        ]).alias("code"))


def _parts(path: str) -> Column:
    return F.filter(F.split(path, "/"), lambda p: ~p.isin("", "."))


def _unsafe(path: str) -> Column:
    """Absolute, upward, empty, or with backslashes or control characters."""
    return (
        F.startswith(F.col(path), F.lit("/")) | F.col(path).rlike(r"[\\\x00-\x1f]") | (F.size(_parts(path)) == 0)
        | F.array_contains(_parts(path), "..")
    )


def validate_results(results: DataFrame, executions: DataFrame) -> DataFrame:
    """First error (or NULL) of worker results (result_id, status, execution_id, run fields) against the execution
    that was started (result_id, started_execution_id)."""
    joined = results.join(executions, "result_id")
    directory = _parts("run_directory")
    outside = lambda c: F.slice(_parts(c), F.lit(1), F.size(directory)) != directory
    code = first_error([
        ("NOT_SUCCESS", F.coalesce(F.col("status") != "success", F.lit(True))),
        ("OTHER_EXECUTION", ~F.col("execution_id").eqNullSafe(F.col("started_execution_id"))),
        *[(f"MISSING_{f.upper()}", F.coalesce(F.col(f) == "", F.lit(True))) for f in RESULT_TEXT_FIELDS],
        *[(f"UNSAFE_{f.upper()}", _unsafe(f)) for f in RESULT_TEXT_FIELDS[1:]],
        *[(f"OUTSIDE_{f.upper()}", outside(f)) for f in RESULT_TEXT_FIELDS[2:]],
    ])
    return joined.select("result_id", code.alias("code"))


def deployment_summary(training: DataFrame, serving: DataFrame, gateway: DataFrame) -> DataFrame:
    """One nested row per run. training: run_id, execution_id, base_model, method. serving: run_id, rolled_back, aliases,
    base_url. gateway: run_id, enabled, ready, base_url."""
    s = serving.select("run_id", F.struct("rolled_back", "base_url", "base_alias", "fine_tuned_alias").alias("_s"))
    g = gateway.select("run_id", F.struct("enabled", "ready", "base_url").alias("_g"))
    joined = training.join(s, "run_id", "left").join(g, "run_id", "left")
    serving_state = F.when(F.col("_s").isNull(), "failed").when(F.col("_s.rolled_back"), "rolled_back").otherwise("ready")
    gateway_state = F.when(F.coalesce("_g.ready", F.lit(False)), "ready").when(F.coalesce("_g.enabled", F.lit(False)), "failed").otherwise("disabled")
    enabled = F.coalesce("_g.enabled", F.lit(False))
    return joined.select(
        "run_id", "execution_id", F.struct(F.lit("success").alias("status"), "base_model", "method").alias("training"),
        F.struct(serving_state.alias("status"), F.col("_s.base_url").alias("base_url"), F.col("_s.base_alias").alias("base_alias"),
                 F.col("_s.fine_tuned_alias").alias("fine_tuned_alias")).alias("serving"),
        F.struct(gateway_state.alias("status"), F.when(enabled, F.col("_g.base_url")).alias("base_url")).alias("gateway"))


def registration_outcome(attempts: DataFrame, verified: DataFrame) -> DataFrame:
    """State of two-alias registrations from attempts (run_id, role, outcome) and verified runs (run_id)."""
    created = F.startswith(F.col("outcome"), F.lit("created"))
    state = attempts.groupBy("run_id").agg(F.count_if(created).alias("created"), F.max(F.col("outcome") == "indeterminate").alias("_unclear"))
    ready = verified.select("run_id").distinct().withColumn("_ready", F.lit(True))
    status = (
        F.when(F.coalesce("_ready", F.lit(False)), "ready").when(F.col("_unclear"), "indeterminate_failed")
        .when(F.col("created") == 0, "registration_failed").when(F.col("created") < 2, "partial_failed").otherwise("verification_failed")
    )
    return state.join(ready, "run_id", "left").select("run_id", "created", status.alias("status"))


def run_outcome(pivoted: DataFrame) -> DataFrame:
    """Readable outcome from one row per run with the status of training, serving and gateway."""
    training, serving, gateway = (F.col(c) for c in ("training", "serving", "gateway"))
    outcome = (
        F.when(F.coalesce(training != "success", F.lit(True)), "Training failed")
        .when(serving == "failed", "Training succeeded; serving failed")
        .when(gateway == "failed", "Training and serving succeeded; gateway failed").otherwise("Success")
    )
    return pivoted.select("run_id", outcome.alias("outcome"))
