"""Physical plans: no join without a key, pruned scans, limits before shuffles."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from sft_tables.operators import convert, formats, runs
from sft_tables.operators import rows as rw
from sft_tables.plans import fixtures

SF = "/root/testdata/sf0.001"
# queries that write files or run streams while they are built are left to the comparison tests
EAGER = re.compile("^(read_|write_|json_files|probe_|select_source|file_digest|scan_runs|.*_stream$|dataset_manifest|op[0-9]+_|pipeline)")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in sorted(entry.queries()) if not EAGER.match(n)])
def test_every_join_has_a_key(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_typed_rows_read_only_their_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("lang = 'en'").select(
        "doc_id", F.col("source").alias("instruction"), F.col("text").alias("output"), "n_chars", "lang")
    text = plan(convert.convert_columns(docs, formats.ALPACA, ["doc_id"]))
    assert "n_chars" not in text and "EqualTo(lang,en)" in text and "Exchange" not in text and "Python" not in text


def test_first_rows_are_limited_before_the_shuffle(spark):
    text = plan(rw.first_rows(fixtures.table(spark, SF, "documents").select("source", "doc_id"), "doc_id", key="source"))
    assert text.index("WindowGroupLimit") < text.index("Exchange") < text.rindex("WindowGroupLimit")


def test_sample_and_key_filters_reach_the_scan(spark, tmp_path):
    spark.range(100).selectExpr("'d' AS dataset_id", "id + 1 AS row_index", "'{}' AS raw").write.parquet(str(tmp_path / "r"))
    model = rw.to_row_model(spark.read.parquet(str(tmp_path / "r")))
    text = plan(rw.sample_rows(model).filter("dataset_id = 'd'"))
    assert "LessThanOrEqual(row_index,25)" in text and "EqualTo(dataset_id,d)" in text
    assert text.count("parseJson") == 1


def test_conversion_has_no_python_and_parses_once_per_scan(spark):
    text = plan(convert.convert_dataset(fixtures.row_model(spark, SF)).rows)
    assert "Python" not in text and "Pandas" not in text
    assert text.count("parseJson") == 1
    # raw text is not moved by the join with the formats, whose written size is known
    assert "BroadcastHashJoin" in text and not re.search(r"Exchange hashpartitioning\(dataset_id[^)]*\), ENSURE[\s\S]{0,400}raw#", text)


def test_configs_as_many_as_runs_are_not_broadcast(spark):
    files = spark.createDataFrame([(1, runs.LORA_CONFIG, 5), (1, runs.LORA_WEIGHTS, 0)], "run_id bigint, rel_path string, size bigint")
    configs = spark.createDataFrame([(1, '{"r": 8, "base_model_name_or_path": "a/b"}')], "run_id bigint, raw string")
    wanted = spark.createDataFrame([(1, "a/b", None, None), (2, "a/b", None, None)], "run_id bigint, base_model string, requested_revision string, resolved_revision string")
    found = runs.validate_lora(files, configs, wanted)
    assert "Broadcast" not in plan(found)
    assert sorted(map(tuple, found.collect())) == [(1, "WEIGHTS_EMPTY"), (2, "CONFIG_MISSING")]


def test_pairs_are_dealt_out_before_they_are_made_distinct(spark):
    requests = spark.createDataFrame([(1, None, "e", 7), (2, "r", None, None)], "request_id bigint, run_id string, execution_id string, pipeline_id bigint")
    targets = spark.createDataFrame([(1, "execution", "e"), (2, "run", "r")], "request_id bigint, kind string, id string")
    resources = spark.createDataFrame([(10, "r", "e", 7), (11, "r", "e", None), (11, "r", "e", None)], "resource_id bigint, run_id string, execution_id string, pipeline_id bigint")
    found = runs.owned_resources(requests, targets, resources)
    pair = r"\(keys=\[request_id#\d+L, resource_id#\d+L\]"
    assert re.search(pair + r"[^\n]*\n[ +:-]*Exchange hashpartitioning\(request_id#\d+L, resource_id#\d+L, \d+\), REPARTITION_BY_COL", plan(found))
    assert sorted(map(tuple, found.collect())) == [(1, 10), (1, 11), (2, 10), (2, 11)]


def test_specs_are_dealt_out_before_they_are_checked(spark):
    text = plan(entry.queries()["validate_policy"](spark, SF))
    assert re.search(r"parseJson[\s\S]*Exchange RoundRobinPartitioning[\s\S]*FileScan", text)
