"""Golden values of the model, capacity, run and redaction rules."""

import datetime
import json

import pytest

from sft_tables.functions import text as tx
from sft_tables.operators import capacity, digests, models, redact, runs
from pyspark.sql import functions as F


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def job(spark, **over):
    base = {"parameter_count": 490_000_000, "precision_name": "bf16", "method": "lora", "batch_size": 1, "cutoff_len": 2048, "gradient_checkpointing": False}
    return capacity.estimate_training(spark.createDataFrame([{**base, **over}]), 1 << 20, 25).first()


def test_training_estimates(spark):
    assert (job(spark)["subtotal_mib"], job(spark)["required_training_mib"]) == (3918, 4897)
    assert job(spark, precision_name="fp32")["required_training_mib"] == 6065
    for larger in ({"batch_size": 2}, {"cutoff_len": 4096}, {"precision_name": "fp32"}, {"method": "full"}):
        assert job(spark, **larger)["required_training_mib"] > 4897
    assert job(spark, gradient_checkpointing=True)["required_training_mib"] < 4897
    assert job(spark, parameter_count=10**15, method="full")["required_training_mib"] == -(-(-(-(16 * 10**15 + (2048 << 20)) * 125 // 100)) // (1 << 20))


def test_key_value_cache(spark):
    model = {"parameter_count": 1, "precision_name": "bf16", "num_hidden_layers": 2, "num_key_value_heads": 1, "head_dim": 8,
             "max_position_embeddings": 100, "max_model_len": 10, "max_num_seqs": 2}
    assert capacity.estimate_serving(spark.createDataFrame([model]), 1, 0, 0).first()["kv_cache_bytes"] == 1280
    late = capacity.estimate_serving(spark.createDataFrame([{**model, "max_model_len": 101}]), 1, 0, 0).first()
    assert (late["code"], late["kv_cache_bytes"]) == ("MAX_MODEL_LEN", None)


def test_gpu_choice(spark):
    gpus = spark.createDataFrame([(0, 10, 100), (1, 50, 100), (2, 50, 200)], "gpu_index bigint, free_mib bigint, total_mib bigint")
    jobs = spark.createDataFrame([(1, 50, "auto"), (2, 51, "auto"), (3, 10, "0"), (4, 11, "0"), (5, 1, "7")], "job_id bigint, required_mib bigint, device string")
    found = {r["job_id"]: (r["code"], r["gpu_index"], r["rejected_gpus"]) for r in capacity.admit_gpus(jobs, gpus).collect()}
    assert found == {1: (None, 1, 1), 2: ("NO_GPU", None, 3), 3: (None, 0, 0), 4: ("GPU_TOO_SMALL", None, 1), 5: ("GPU_NOT_FOUND", None, 0)}
    assert {r["gpu_index"]: r["rejected_jobs"] for r in capacity.gpu_rejections(jobs, gpus).collect()} == {0: 3, 1: 1, 2: 1}
    none = capacity.admit_gpus(jobs, gpus.limit(0)).filter("job_id = 1").collect()
    assert [r["code"] for r in none] in ([], ["NO_GPU"])


@pytest.mark.parametrize(("name", "family", "variant", "template"), [
    ("Qwen/Qwen2.5-0.5B-Instruct", "qwen", "qwen2.5", "qwen"), ("meta-llama/Llama_3.1-8B", "llama", "llama3", "llama3"),
    ("x/llama-2", "llama", "llama2", "llama2"), ("x/llama-30b", "llama", "llama", None), ("google/gemma-3-1b", "gemma", "gemma3", "gemma3"),
])
def test_families(spark, name, family, variant, template):
    assert tuple(one(spark, models.family_from_name(F.lit(name)))) == (family, variant, template)


def test_run_ids_fill_gaps(spark):
    at = datetime.datetime(2026, 9, 16, 12)
    model = "Qwen/Qwen2.5-0.5B-Instruct"
    base = "20260916_120000_qwen2-5-0-5b-instruct_demo"
    requests = spark.createDataFrame([(i, at, model, "demo") for i in (5, 6, 7)], "request_id bigint, created_at timestamp, model_name string, dataset_name string")
    held = spark.createDataFrame([(f"{base}_02",), (f"{base}_04",), (f"{base}_2",), ("other",)], "run_id string")
    assert [r["run_id"] for r in runs.assign_run_ids(requests, held).orderBy("request_id").collect()] == [base, f"{base}_03", f"{base}_05"]
    fresh = runs.assign_run_ids(requests, held.limit(0)).orderBy("request_id").collect()
    assert [r["run_id"] for r in fresh] == [base, f"{base}_02", f"{base}_03"]


def test_run_records_are_read_from_folders(spark, tmp_path):
    for name, status in (("r1", "success"), ("r2", "failed")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "metadata.json").write_text(json.dumps({
            "schema_version": 2, "run_id": name, "status": status, "model": {"name": "m"}, "phases": {"serving": {"status": "ready"}},
            "training_metrics": {"train_loss": 0.5}}, indent=2))
    found = {r["run_folder"]: (r["status"], r["model"]["name"], r["phases"]["serving"]["status"]) for r in runs.scan_runs(spark, str(tmp_path)).collect()}
    assert found == {"r1": ("success", "m", "ready"), "r2": ("failed", "m", "ready")}


@pytest.mark.parametrize(("value", "expected"), [
    ("\x1c a b \n", "a b"), ("​", "​"), (" \t\x1f", ""),
])
def test_strip_follows_unicode(spark, value, expected):
    assert one(spark, tx.strip(F.lit(value))) == expected == value.strip()
    assert one(spark, tx.nonblank(F.lit(value))) is bool(value.strip())


@pytest.mark.parametrize(("text", "expected"), [
    ("Authorization: Bearer abc.def, next", "Authorization: Bearer <redacted>, next"), ("api-key='k1' rest", "api-key=<redacted>' rest"),
    ("TOKEN = x;password:y", "TOKEN = <redacted>;password:<redacted>"), ("known s3cret s3 here", "known <redacted> <redacted> here"),
])
def test_redacted_text(spark, text, expected):
    assert one(spark, redact.redact_text(F.lit(text), ["s3", "s3cret", ""])) == expected


def test_sensitive_keys(spark):
    yes, no = ["api_key", "API-Key", " Hf Token ", "db.password", "x_client_secret"], ["eos_token", "max_tokens", "tokenizer", "secretary"]
    for key in yes + no:
        assert redact.is_sensitive_key(key) is (key in yes)
        assert one(spark, redact.sensitive_key(F.lit(key))) is (key in yes)


def test_nested_json_redaction(spark):
    text = json.dumps({"a": [{"token": "x", "b": 1}], "secret": {"k": 1}, "password": "${DB}"})
    assert json.loads(one(spark, redact.redact_json(F.lit(text)))) == {"a": [{"token": "<redacted>", "b": 1}], "secret": "<redacted>", "password": "${DB}"}
    assert one(spark, redact.redact_json(F.lit("not json token=x"))) is None


def test_digest_ignores_partitioning_and_sees_order(spark):
    data = [("d", i, f"q{i}", "", f"a{i}") for i in range(1, 200)]
    table = spark.createDataFrame(data, "dataset_id string, row_index bigint, instruction string, input string, output string")
    first = digests.dataset_digest(table).collect()
    assert first == digests.dataset_digest(table.repartition(17)).collect()
    swapped = table.withColumn("row_index", 200 - F.col("row_index"))
    assert first != digests.dataset_digest(swapped).collect()


def test_secrets_in_maps_lists_and_variants(spark):
    table = spark.sql("""SELECT 1 AS id, map('password', named_struct('v', 'hunter2'), 'team', named_struct('v', 'x')) AS m, map('token', 12345, 'n', 7) AS n,
        array(named_struct('password', 'hunter2', 'name', 'a'), named_struct('password', concat('$', '{P}'), 'name', 'b')) AS users,
        array(map('a', array(named_struct('hf_token', 'z')))) AS deep""")
    shown = redact.redact_data(table).select(F.to_json(F.to_variant_object(F.struct("m", "n", "users", "deep")))).first()[0]
    assert json.loads(shown) == {
        "m": {"password": "<redacted>", "team": {"v": "x"}}, "n": {"token": "<redacted>", "n": 7},
        "users": [{"password": "<redacted>", "name": "a"}, {"password": "${P}", "name": "b"}], "deep": [{"a": [{"hf_token": "<redacted>"}]}]}
    assert {r["path"] for r in redact.literal_secret_audit(table, ["id"]).collect()} == {
        "m.password", "n.token", "users[0].password", "deep[0].a[0].hf_token"}
    loose = spark.sql("""SELECT parse_json('{"a": [{"secret": 1}]}') AS v""")
    assert redact.redact_data(loose).select(F.to_json("v")).first()[0] == '{"a":[{"secret":"<redacted>"}]}'
    with pytest.raises(ValueError):
        redact.literal_secret_audit(loose, [])


def test_metric_curves(spark):
    rows = [(1, 0, 10, 3.0), (1, 1, 20, None), (1, 2, 30, 2.0), (1, 3, 40, float("nan")), (1, 4, 50, 2.0), (1, 5, 60, 2.5), (2, 0, None, 1.0), (3, 0, 1, None)]
    found = runs.metric_curves(spark.createDataFrame(rows, "run_id bigint, entry bigint, step bigint, loss double").repartition(3))
    assert sorted(tuple(r)[:2] + tuple(r)[4:] for r in found.collect()) == [
        (1, 0, None, 3.0, 10), (1, 2, -1.0, 2.0, 30), (1, 4, 0.0, 2.0, 30), (1, 5, 0.5, 2.0, 30), (2, 0, None, 1.0, None)]
