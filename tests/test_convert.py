import json

import pytest

from sft_tables.functions.errors import TableCheckError
from sft_tables.operators import convert, detect, formats
from sft_tables.operators import rows as rw

CHAT = [
    {"role": "system", "content": "Be brief"}, {"role": "user", "content": "Q1"}, {"role": "assistant", "content": "A1"},
    {"role": "user", "content": "Q2"}, {"role": "assistant", "content": "A2"},
]
CHAT_ROWS = [("Q1", "System: Be brief", "A1"), ("Q2", "System: Be brief\nUser: Q1\nAssistant: A1", "A2")]
MARKED = "<|im_start|>user\nQ<|im_end|>\n<|im_start|>assistant\n A <|im_end|>\n"
GOLDEN = {
    "alpaca": ({"instruction": "Q", "output": "A"}, [("Q", "", "A")]),
    "instruction_response": ({"instruction": "Q", "response": "A"}, [("Q", "", "A")]),
    "prompt_completion": ({"prompt": "Q", "completion": "A", "input": "I"}, [("Q", "I", "A")]),
    "qa_json": ({"prompt": "Q", "response": "A"}, [("Q", "", "A")]),
    "rag_qa": ({"context": "C", "question": "Q", "answer": "A"}, [("Q", "C", "A")]),
    "openai_chat": ({"messages": CHAT}, CHAT_ROWS),
    "sharegpt": ({"conversations": [{"from": "human", "value": "Q"}, {"from": "gpt", "value": "A"}]}, [("Q", "", "A")]),
    "chatml": (MARKED, [("Q", "", "A")]),
}
BAD = {
    "alpaca": ({"instruction": "Q", "output": ""}, "BLANK_OR_NOT_STRING"),
    "instruction_response": ({"instruction": "Q", "response": " "}, "BLANK_OR_NOT_STRING"),
    "prompt_completion": ({"prompt": "Q", "completion": 5}, "BLANK_OR_NOT_STRING"),
    "qa_json": ({"question": "Q", "answer": "A", "context": None}, "CONTEXT_NOT_STRING"),
    "rag_qa": ({"context": "", "question": "Q", "answer": "A"}, "BLANK_OR_NOT_STRING"),
    "openai_chat": ({"messages": [{"role": "assistant", "content": "A"}]}, "ASSISTANT_ORPHAN"),
    "sharegpt": ({"conversations": [{"from": "gpt", "value": "A"}]}, "ASSISTANT_ORPHAN"),
    "chatml": ("<|im_start|>user\nQ", "CHATML_MALFORMED"),
    "dpo": ({"prompt": "Q", "chosen": "", "rejected": "B"}, "BLANK_OR_NOT_STRING"),
}


def requested(spark, names):
    return spark.createDataFrame([(n, n) for n in names], "dataset_id string, requested string")


def sft(done):
    return {name: [tuple(r)[1:] for r in part] for name, part in _by_dataset(
        done.rows.orderBy("dataset_id", "row_index", "turn").select("dataset_id", "instruction", "input", "output").collect())}


def _by_dataset(found):
    groups = {}
    for r in found:
        groups.setdefault(r["dataset_id"], []).append(r)
    return groups.items()


def test_every_format_is_detected_and_converted(rows):
    done = convert.convert_dataset(rows(**{n: [raw] for n, (raw, _) in GOLDEN.items()}))
    chosen = {r["dataset_id"]: r["format"] for r in done.selection.collect()}
    assert chosen == {n: n for n in GOLDEN}
    assert sft(done) == {n: expected for n, (_, expected) in GOLDEN.items()}
    assert done.violations.count() == 0


def test_text_field_holds_chatml_too(rows):
    assert sft(convert.convert_dataset(rows(d=[{"text": MARKED}]))) == {"d": [("Q", "", "A")]}


def test_each_format_reports_a_bad_row(spark, rows):
    table = rows(**{n: [raw] for n, (raw, _) in BAD.items()})
    found = convert.convert_dataset(table, requested(spark, BAD), require=None).row_violations.collect()
    assert {r["dataset_id"]: r["code"] for r in found} == {n: code for n, (_, code) in BAD.items()}


@pytest.mark.parametrize(("messages", "code", "turn"), [
    ([], "CHAT_EMPTY", None), ([{"role": "system", "content": "S"}], "NO_ASSISTANT", None),
    ([{"role": "user", "content": "Q"}], "NO_ASSISTANT", None), (CHAT[1:] + [{"role": "user", "content": "Q"}], "ENDS_ON_USER", None),
    (CHAT[1:3] + [CHAT[0]], "SYSTEM_LATE", 3), ([CHAT[1], CHAT[1]], "USER_TWICE", 2), (CHAT[:3] + [CHAT[2]], "ASSISTANT_ORPHAN", 4),
    ([CHAT[1], {"role": "tool", "content": "x"}], "ROLE_UNKNOWN", 2), ([CHAT[1], {"role": "assistant", "content": 5}], "CONTENT_BLANK", 2),
    ([CHAT[1], "text"], "TURN_NOT_OBJECT", 2), ([CHAT[1], {"content": "x"}], "ROLE_UNKNOWN", 2),
])
def test_first_bad_turn_wins(spark, rows, messages, code, turn):
    table = rows(d=[{"messages": messages}])
    want = spark.createDataFrame([("d", "openai")], "dataset_id string, requested string")
    (found,) = convert.convert_dataset(table, want).row_violations.collect()
    assert (found["code"], found["turn"]) == (code, turn)


def test_sharegpt_stray_item_is_found_before_turn_rules(spark, rows):
    table = rows(sharegpt=[{"conversations": [{"from": "bot", "value": "x"}, 7]}, {"conversations": 3}, {"x": 1}])
    found = convert.convert_dataset(table, requested(spark, ["sharegpt"])).row_violations.orderBy("row_index").collect()
    assert [(r["code"], r["turn"]) for r in found] == [("TURN_NOT_OBJECT", 2), ("CHAT_NOT_LIST", None), ("CHAT_MISSING", None)]


def test_sharegpt_keeps_other_speaker_names(rows):
    done = convert.convert_dataset(rows(d=[{"conversations": [{"from": "user", "value": "Q"}, {"from": "assistant", "value": "A"}]}]))
    assert sft(done) == {"d": [("Q", "", "A")]}


def test_undecided_datasets(rows):
    done = convert.convert_dataset(rows(
        both=[{"instruction": "I", "output": "O", "prompt": "P", "completion": "C"}], none=[{"question": "Q", "unknown": "v"}],
        apart=[{"instruction": "Q"}, {"output": "A"}], pref=[{"prompt": "P", "chosen": "A", "rejected": "B"}]))
    assert {r["dataset_id"]: r["code"] for r in done.dataset_violations.collect()} == {
        "both": "AMBIGUOUS", "none": "NOT_RECOGNIZED", "apart": "NOT_RECOGNIZED", "pref": "TASK_UNSUPPORTED"}
    assert done.preference.select("prompt", "chosen", "rejected").collect() == [("P", "A", "B")]


def test_reports_name_the_evidence(rows):
    ranked = detect.detect_dataset_format(rows(
        apart=[{"instruction": "Q"}, {"output": "A"}], none=[{"question": "Q", "unknown": "v"}]))
    report = {r["dataset_id"]: r["report"] for r in detect.detection_report(ranked, detect.select_format(ranked)).collect()}
    assert "complete in 0/2 sampled rows" in report["apart"]
    assert "'question'" in report["none"] and "- qa_json: confidence 0.30" in report["none"]


def test_partial_scores_round_like_the_binary_product(rows):
    # one of sixteen fields: 0.6 / 16 = 0.0375 is stored just below the half
    scores = detect.score_formats(rw.sample_rows(rows(d=[{"instruction": "x"}] + [{"z": 1}] * 7)))
    got = scores.filter("format = 'alpaca'").first()
    assert float(got["confidence"]) == round(0.6 * 1 / 16, 3) == 0.037


def test_all_partial_scores_match_python_rounding():
    low = detect._halves_going_down()
    for total in {n * k for n in range(1, 26) for k in (2, 3)}:
        for present in range(total):
            exact = 600 * present / total
            half_up = int(exact + 0.5) / 1000
            got = half_up - (0.001 if present in low.get(total, []) else 0)
            assert abs(got - round(0.6 * present / total, 3)) < 1e-9, (present, total)


def test_unknown_override_and_alias(spark, rows):
    want = spark.createDataFrame([("a", "nope"), ("b", " Question-Answer ")], "dataset_id string, requested string")
    raw = [{"question": "Q", "answer": "A"}]
    chosen = {r["dataset_id"]: (r["format"], r["code"]) for r in convert.convert_dataset(rows(a=raw, b=raw), want).selection.collect()}
    assert chosen == {"a": (None, "UNKNOWN_FORMAT"), "b": ("qa_json", None)}


def test_duplicate_aliases_are_refused():
    with pytest.raises(ValueError, match="claimed"):
        formats.alias_lookup({"a": ("x",), "b": ("X",)})


def test_column_copy_keeps_sources_and_uses_original_values(rows):
    table = rw.map_columns(rows(d=[{"a": "1", "b": "2", "c": None}, {"a": "1"}, [1]]), {"a": "b", "b": "a", "x": "c"})
    found = table.orderBy("row_index").select("map_error", "raw").collect()
    assert found[0]["map_error"] is None
    assert json.loads(found[0]["raw"]) == {"a": "2", "b": "1", "c": None, "x": None}
    assert [r["map_error"] for r in found[1:]] == ["MAP_MISSING_SOURCE", "MAP_NOT_OBJECT"]


def test_mapped_columns_enable_detection(rows):
    table = rw.map_columns(rows(d=[{"ask": "Q", "reply": "A"}]), {"instruction": "ask", "output": "reply"})
    assert sft(convert.convert_dataset(table)) == {"d": [("Q", "", "A")]}


def test_missing_and_null_differ(rows):
    done = convert.convert_dataset(rows(d=[{"instruction": "Q", "output": "A"}, {"instruction": "Q", "input": None, "output": "A"}]))
    assert sft(done) == {"d": [("Q", "", "A")]}
    assert [(r["row_index"], r["code"], r["detail"]) for r in done.row_violations.collect()] == [(2, "OPTIONAL_NOT_STRING", "input")]


def test_repeated_json_key_keeps_the_last(spark):
    raw = spark.createDataFrame([("d", 1, '{"instruction": "x", "instruction": "Q", "output": "A"}')], "dataset_id string, row_index bigint, raw string")
    assert sft(convert.convert_dataset(rw.to_row_model(raw))) == {"d": [("Q", "", "A")]}


def test_strict_mode_raises_the_first_error(rows):
    good, bad = {"instruction": "Q", "output": "A"}, {"instruction": "Q", "output": " "}
    with pytest.raises(TableCheckError, match="BLANK_OR_NOT_STRING at row_index=2"):
        convert.convert_dataset(rows(d=[good, bad, bad])).strict()
    with pytest.raises(TableCheckError, match="TASK_UNSUPPORTED"):
        convert.convert_dataset(rows(d=[{"prompt": "P", "chosen": "A", "rejected": "B"}])).strict()
    assert convert.convert_dataset(rows(d=[good])).strict().count() == 1


def test_unified_check(spark):
    table = spark.createDataFrame([(1, "Q", "", "A"), (2, " ", "", "A"), (3, "Q", None, "A")], "k int, instruction string, input string, output string")
    assert {r["k"]: r["code"] for r in convert.validate_unified(table, ["k"]).collect()} == {2: "UNIFIED_BLANK", 3: "UNIFIED_INPUT"}
    assert convert.validate_unified(table.drop("input"), ["k"]).first()["code"] == "UNIFIED_FIELDS"


def test_columnar_null_is_a_violation_not_a_default(spark):
    table = spark.createDataFrame([(1, "Q", None, "A"), (2, "Q", "I", "A")], "k int, instruction string, input string, output string")
    assert convert.convert_columns(table, formats.ALPACA, ["k"]).collect() == [(2, "Q", "I", "A")]
    assert convert.convert_columns(table.drop("input"), formats.ALPACA, ["k"]).count() == 2


def test_same_file_is_refused(spark):
    files = spark.createDataFrame([("a", "d1"), ("b", "d2")], "path string, sha256 string")
    with pytest.raises(TableCheckError, match="SAME_FILE"):
        convert.require_disjoint_files(files, files.filter("path = 'b'"))
    convert.require_disjoint_files(files.filter("path = 'a'"), files.filter("path = 'b'"))
