"""Streams: what was known beforehand, what comes later, and what is repeated."""

import datetime
import json

import pytest

from sft_tables.operators import convert
from sft_tables.operators.rows import to_row_model
from sft_tables.sources import sinks
from sft_tables.streaming import tables

RAW = "dataset_id string, row_index bigint, raw string"
ALPACA, DPO, ODD = ({"instruction": "Q", "output": "A"}, {"prompt": "Q", "chosen": "A", "rejected": "B"}, {"strange": 1})


def batch_of(spark, *parts):
    return spark.createDataFrame([(d, i, json.dumps(v)) for d, numbers, v in parts for i in numbers], RAW)


def outcomes(spark, out, waiting):
    table = tables.Normalization(spark, out).results()
    found = sorted(((r["dataset_id"], r["outcome"], r["code"], r["row_index"]) for r in table.collect()), key=str)
    return found, sorted((r["dataset_id"], r["row_index"]) for r in waiting.collect())


def test_datasets_that_come_later(spark, tmp_path):
    out = str(tmp_path)
    known = spark.createDataFrame([("known", "alpaca", None), ("refused", None, "AMBIGUOUS")], "dataset_id string, format string, code string").selectExpr(
        "dataset_id", "format", "cast(1 as decimal(4,3)) AS confidence", "code")
    done = tables.Normalization(spark, out, known)
    batches = [
        batch_of(spark, ("known", range(1, 4), ALPACA), ("refused", [1], ALPACA), ("late", range(1, 11), ALPACA), (None, [1], ALPACA)),
        batch_of(spark, ("late", range(11, 41), ALPACA), ("few", [1, 2], ODD), ("known", [4], ODD)),
        batch_of(spark, ("late", [41], ODD), ("pairs", range(1, 31), DPO)),
    ]
    for number, batch in enumerate(batches):
        for _ in range(1 + (number == 1)):  # a batch that is repeated replaces its rows
            done.write(batch, number)
        if number == 0:
            found, waiting = outcomes(spark, out, done.waiting(0))
            assert waiting == [("late", i) for i in range(1, 11)]
            assert found == sorted([("known", "row", None, i) for i in range(1, 4)] + [(None, "violation", "NO_FORMAT", 1), ("refused", "violation", "AMBIGUOUS", None)], key=str)
    found, waiting = outcomes(spark, out, done.waiting(2))
    assert waiting == [("few", 1), ("few", 2)]
    done.finish()
    found, waiting = outcomes(spark, out, done.waiting(3))
    want = [("known", "row", None, i) for i in range(1, 4)] + [("late", "row", None, i) for i in range(1, 41)] + [
        (None, "violation", "NO_FORMAT", 1), ("refused", "violation", "AMBIGUOUS", None), ("known", "violation", "MISSING_FIELDS", 4),
        ("late", "violation", "MISSING_FIELDS", 41), ("pairs", "violation", "TASK_UNSUPPORTED", None), ("few", "violation", "NOT_RECOGNIZED", None)]
    assert found == sorted(want, key=str) and waiting == []
    assert {r["dataset_id"]: r["format"] for r in done.formats().filter("code IS NULL").collect()} == {"known": "alpaca", "late": "alpaca", "pairs": "dpo"}


def test_patience(spark, tmp_path):
    done = tables.Normalization(spark, str(tmp_path), patience=2)
    for number, rows in enumerate([[1, 2], [3], [4]]):
        done.write(batch_of(spark, ("slow", rows, ALPACA)), number)
        found, waiting = outcomes(spark, str(tmp_path), done.waiting(number))
        assert (len(found), len(waiting)) == [(0, 2), (0, 3), (4, 0)][number]


def test_stream_ends_where_the_table_does(spark, tmp_path):
    raw = batch_of(spark, ("a", range(1, 61), ALPACA), ("b", range(1, 8), ODD))
    raw.repartitionByRange(2, "row_index").write.parquet(str(tmp_path / "in"))
    done = tables.Normalization(spark, str(tmp_path / "out"))
    source = spark.readStream.schema(RAW).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    tables.run_to_end(tables.normalize_stream(source, done, str(tmp_path / "state")))
    done.finish()
    found, _ = outcomes(spark, str(tmp_path / "out"), done.waiting(done.last))
    want = sinks.conversion_table(convert.convert_dataset(to_row_model(raw))).collect()
    assert found == sorted(((r["dataset_id"], r["outcome"], r["code"], r["row_index"]) for r in want), key=str)


@pytest.mark.parametrize("chosen", [[], [("old", "alpaca")]])
def test_rows_without_a_choice_are_violations(spark, chosen):
    rows = to_row_model(batch_of(spark, ("old", [1, 2], ALPACA), ("new", [1], ALPACA), (None, [1, 2], ALPACA)))
    selection = spark.createDataFrame([(d, f, None) for d, f in chosen], "dataset_id string, format string, code string")
    found = sinks.conversion_table(convert.convert_with(rows, selection, require=None)).collect()
    assert sorted(((r["dataset_id"], r["row_index"], r["code"]) for r in found), key=str) == sorted(
        [("old", i, None if chosen else "NO_FORMAT") for i in (1, 2)] + [("new", 1, "NO_FORMAT"), (None, 1, "NO_FORMAT"), (None, 2, "NO_FORMAT")], key=str)


def events_of(spark, folder, batches):
    for n, rows in enumerate(batches):
        data = [(r, datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=m), q, status) for r, m, q, status in rows]
        spark.createDataFrame(data, "run_id bigint, ts timestamp, seq bigint, status string").coalesce(1).write.parquet(f"{folder}/b{n}")
    return spark.readStream.schema("run_id bigint, ts timestamp, seq bigint, status string").option("maxFilesPerTrigger", 1).parquet(f"{folder}/b*")


def test_status_state_ends_with_the_runs(spark, tmp_path):
    """The latest status of every run, and no state left of those that ended or fell silent."""
    batches = [
        [(1, 0, 1, "training"), (1, 5, 2, "success"), (2, 0, 1, "training"), (2, 0, 3, "verifying"), (2, 0, 2, "prepared")],
        [(2, 3, 4, "training"), (1, 4, 9, "training"), (3, 200, 1, "failed")],
        [(4, 900, 1, "training"), (1, 2, 3, "late")],
        [(4, 901, 2, "success")],
        [(5, 5000, 1, "training")], [(5, 20000, 2, "failed")], [(6, 40000, 1, "success")],
    ]
    source = events_of(spark, str(tmp_path / "in"), batches)
    stream = tables.run_status_stream(source, delay="10 minutes", grace_minutes=30, silence_minutes=600)
    tables.run_to_end(tables.write_updates(stream, str(tmp_path / "out"), str(tmp_path / "state")))
    found = {}
    for r in spark.read.parquet(str(tmp_path / "out")).orderBy("batch_id").collect():
        found.setdefault(r["run_id"], []).append((r["seq"], r["status"]))
    assert found == {1: [(2, "success")], 2: [(3, "verifying"), (4, "training")], 3: [(1, "failed")], 4: [(1, "training"), (2, "success")],
                     5: [(1, "training"), (2, "failed")], 6: [(1, "success")]}
    left = spark.read.format("statestore").option("stateVarName", "last").load(str(tmp_path / "state"))
    assert [r["key"]["run_id"] for r in left.collect()] == [6]
