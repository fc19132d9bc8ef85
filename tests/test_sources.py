import csv
import json
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sft_tables.operators import convert
from sft_tables.operators.rows import columns_to_rows, to_row_model
from sft_tables.sources import arrays, blocks, probe, readers, sinks, tables

MARKED = "﻿<|im_start|>user\nQ<|im_end|>\n<|im_start|>assistant\nA<|im_end|>"


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "data.json").write_text(json.dumps([{"instruction": "Q", "output": "A"}]))
    (tmp_path / "data.jsonl").write_text("﻿" + json.dumps({"prompt": "Q", "completion": "A"}) + "\n\n  \n" + "{bad}\n" + '"x"')
    (tmp_path / "data.csv").write_text('question;answer\nQ;A\n"a ""quoted""\nline";\nshort\nlong;1;2\n')
    pq.write_table(pa.Table.from_pylist([{"instruction": "Q", "response": "A"}]), tmp_path / "data.parquet")
    (tmp_path / "talk.txt").write_text(MARKED)
    (tmp_path / "object.json").write_text('{"a": 1}')
    (tmp_path / "broken.pq").write_bytes(b"PA")
    (tmp_path / "rows").write_text('{"a": 1}\n{"a": 2}\n')
    return tmp_path


def test_probe(spark, folder):
    chosen = probe.select_source(probe.probe_sources(spark, str(folder), 3)).collect()
    found = {r["path"].rsplit("/", 1)[1]: (r["adapter"], r["code"], r["confidence"] and float(r["confidence"])) for r in chosen}
    assert found.pop("data.csv")[0] == "csv"
    # the CSV sniffer accepts almost any text, so what nothing else claims may end there
    assert found == {
        "data.json": ("json", None, 0.99), "data.jsonl": ("csv", None, 0.82), "data.parquet": ("parquet", None, 1.0),
        "talk.txt": ("chatml_text", None, 0.99), "object.json": ("jsonl", None, 0.9), "broken.pq": ("csv", None, 0.82), "rows": ("jsonl", None, 0.9),
    }


def test_jsonl_positions_and_broken_lines(spark, folder):
    table = to_row_model(readers.read_jsonl(spark, str(folder / "data.jsonl"), positions=True)).orderBy("row_index").select("row_index", "kind").collect()
    assert table == [(1, "object"), (2, "corrupt"), (3, "string")]
    assert [r["line"] for r in readers.jsonl_errors(spark, str(folder / "data.jsonl")).collect()] == [4]
    head = to_row_model(readers.read_jsonl_head(spark, str(folder / "data.jsonl"), 2)).orderBy("row_index").select("row_index", "kind").collect()
    assert head == [(1, "object"), (2, "corrupt")]


def test_jsonl_line_numbers_over_many_blocks(spark, tmp_path):
    for name in "ab":
        (tmp_path / f"{name}.jsonl").write_text("".join(json.dumps({"f": name, "n": i}) + "\n" for i in range(1, 3001)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = readers.read_jsonl(spark, str(tmp_path), positions=True)
        assert rows.rdd.getNumPartitions() > 2
        wrong = rows.filter(F.get_json_object("raw", "$.n").cast("bigint") != F.col("row_index")).count()
        assert (rows.count(), wrong) == (6000, 0)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


VALUES = [{"a": "x" * 50, "n": i} for i in range(30)] + [1, "s", [2], None, 12345, {"b": "]"}, -1.5e3, True, "q\"],[\\", "\\\\", {"é": "日本\U0001f600"}, "\\" * 9]
ARRAYS = [" " + json.dumps(VALUES, indent=1) + "\n", json.dumps(VALUES, ensure_ascii=False), "\ufeff\r\n " + json.dumps(VALUES).replace(", ", ",\r\n"), "[]", " [ ] ", "[12]",
          '[{"b":1.50,"a":NaN}, -Infinity]', " " * 40 + "[1]" + " " * 40, json.dumps(["\\" * n + '"' * (n % 2) for n in range(40)]), '["' + "y" * 200 + '",  2]']
BROKEN_ARRAYS = ['[{"a":1},{"a":2} {"a":3}]', "[1,,2]", "[1", "[", "", "   \n ", "[1] x", "[1 2]", '["a', "[tru]", '{"a":1} x', "nope", "[1}", '[{"a":1],2}', "[1]]", '[1] [2]',
                 '[\n {"a": 1},\n {"a" 2}\n]', '["é日", "ü\n"]', '["a", b"c", "d"]', "\ufeff[1,\n2,\n é]", '[1,2' + " " * 60 + "}", "[" + "7," * 50 + " ,8]", '["\\"]', '["a"b", "c"]']
OTHER_JSON = ['{"a": [1]}', "7", '"s"', "\ufeff {}", '{"k": "' + "z" * 100 + '"}']


def array_elements(tmp_path, text, size):
    """What the blocks of a file give, from the states that a plain scan from its start finds."""
    raw = text.encode()
    path = tmp_path / "one.json"
    path.write_bytes(raw)
    uri, found, inside, depth, opened = f"file:{path}", [], False, 0, False
    for block in range(max(1, -(-len(raw) // size))):
        start, stop = block * size, min(len(raw), (block + 1) * size)
        elements = arrays.BlockElements(uri, start, stop, inside, depth, opened)
        found += [(block, r[2], r[3], r[4], r[5], r[6]) for r in arrays.block_records(uri, block, elements)]
        s = arrays.summary(uri, start, stop)
        depth += s["turn_inside"] if inside else s["turn_outside"]
        inside, opened = inside != bool(s["parity"]), opened or bool(s["filled"])
    return uri, found


@pytest.mark.parametrize("size", [3, 4, 7, 64, 1 << 20])
def test_arrays_in_blocks(tmp_path, size, monkeypatch):
    monkeypatch.setattr(arrays, "CHUNK", 5)
    for text in ARRAYS:
        _, found = array_elements(tmp_path, text, size)
        want = json.loads(text.removeprefix("\ufeff"))
        assert [str(json.loads(r[2])) for r in found] == [str(v) for v in want] and {r[3] for r in found} <= {None}, text
        assert all(a[0] < b[0] or a[0] == b[0] and a[1] + 1 == b[1] for a, b in zip(found, found[1:]))
    for text in BROKEN_ARRAYS:
        uri, found = array_elements(tmp_path, text, size)
        position, code, message = min((r[4], r[3], r[5]) for r in found if r[3])
        with pytest.raises(json.JSONDecodeError) as error:
            json.loads(text.removeprefix("\ufeff"))
        line, column = arrays.line_and_column(uri, 0, position, 0, 0)
        assert (code, line, column, message) == ("BAD_JSON", error.value.lineno, error.value.colno, error.value.msg), text
    for text in OTHER_JSON:
        assert min((r[4], r[3]) for r in array_elements(tmp_path, text, size)[1] if r[3])[1] == "NOT_ARRAY"
    _, found = array_elements(tmp_path, "[1,]", size)
    assert [r[3:] for r in found if r[3]] == [("BAD_JSON", 3, "Expecting value")]


@pytest.mark.parametrize("size", [16, 1 << 20])
def test_array_files_in_blocks(spark, tmp_path, size, monkeypatch):
    """Rows, their positions, and the lines and columns of errors do not depend on the blocks; Spark lists no empty files."""
    monkeypatch.setattr(blocks, "MOST_TASKS", 8)
    for i, text in enumerate(ARRAYS + BROKEN_ARRAYS + OTHER_JSON):
        (tmp_path / f"{i:02d}.json").write_bytes(text.encode())
    (tmp_path / "98.json").write_bytes(b'[1,\n"\xff", 2]')
    found = readers.read_json_table(spark, str(tmp_path), size).collect()
    by = {}
    for r in found:
        by.setdefault(int(r["dataset_id"][-7:-5]), []).append(r)
    for i, text in enumerate(ARRAYS):
        got = sorted(by.pop(i, []), key=lambda r: r["row_index"])
        assert [r["row_index"] for r in got] == list(range(1, len(got) + 1))
        assert [str(json.loads(r["raw"])) for r in got] == [str(v) for v in json.loads(text.removeprefix("\ufeff"))]
    for i, text in enumerate(BROKEN_ARRAYS, len(ARRAYS)):
        if not text:
            continue
        with pytest.raises(json.JSONDecodeError) as error:
            json.loads(text.removeprefix("\ufeff"))
        e = error.value
        assert [tuple(r)[1:] for r in by.pop(i)] == [(None, None, "BAD_JSON", f"line {e.lineno}, column {e.colno}: {e.msg}")]
    assert [tuple(r)[1:] for r in by.pop(98)] == [(None, None, "BAD_JSON", "line 2, column 2: not UTF-8")]
    assert {(len(v), v[0]["code"], v[0]["row_index"]) for v in by.values()} == {(1, "NOT_ARRAY", None)} and len(by) == len(OTHER_JSON)


def test_broken_files_give_one_violation_and_no_rows(spark, tmp_path):
    (tmp_path / "a.json").write_text("\ufeff" + json.dumps([{"instruction": "q", "output": 1}] * 3))
    (tmp_path / "b.json").write_text("[" + ",".join(["{}"] * 5000) + ", oops")
    (tmp_path / "c.json").write_text('{"a": [1]}')
    (tmp_path / "n.json").write_text('[{"a": NaN}, {"a": 1}]')
    rows = to_row_model(readers.read_json_array(spark, str(tmp_path)))
    assert sorted((r["dataset_id"][-6], r["row_index"], r["kind"], *r["keys"]) for r in rows.collect()) == [
        ("a", 1, "object", "instruction", "output"), ("a", 2, "object", "instruction", "output"), ("a", 3, "object", "instruction", "output"),
        ("n", 1, "object", "a"), ("n", 2, "object", "a")]
    assert {r["dataset_id"][-6:]: r["code"] for r in readers.json_array_errors(spark, str(tmp_path)).collect()} == {"b.json": "BAD_JSON", "c.json": "NOT_ARRAY"}


def test_broken_files_are_violations_of_the_conversion(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"instruction": "q", "output": "a"}] * 3))
    (tmp_path / "b.json").write_text("[{},")
    (tmp_path / "c.json").write_text(json.dumps([{"unknown": 1}]))
    done = convert.convert_dataset(to_row_model(readers.read_json_array(spark, str(tmp_path / "*.json"))))
    sinks.write_conversion(done, str(tmp_path / "out"), readers.json_array_errors(spark, str(tmp_path / "*.json")))
    found = [(r["dataset_id"][-6:], r["outcome"], r["code"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert sorted(found, key=str) == [("a.json", "row", None)] * 3 + [("b.json", "violation", "BAD_JSON"), ("c.json", "violation", "NOT_RECOGNIZED")]


def test_one_value_per_line(spark):
    rows = spark.createDataFrame([("d", i, t) for i, t in enumerate(['{"a":1} x', '{"a":1}', '{"a":NaN,"b":"x, NaN, y"}', "1 2", "", "1,2"])],
                                 "dataset_id string, row_index bigint, raw string")
    found = [r["kind"] for r in to_row_model(rows).orderBy("row_index").collect()]
    assert found == ["corrupt", "object", "object", "corrupt", "corrupt", "corrupt"]


def test_order_without_a_first_pass(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("".join(f"{i}\n" for i in range(3000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = readers.read_jsonl(spark, str(tmp_path)).orderBy("row_index").collect()
        assert [int(r["raw"]) for r in rows] == list(range(3000)) and len({r["row_index"] for r in rows}) == 3000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_csv_cells(spark, folder):
    rows = readers.read_csv(spark, str(folder / "data.csv"), sep=";").orderBy("row_index").collect()
    assert [json.loads(r["raw"]) for r in rows] == [
        {"question": "Q", "answer": "A"}, {"question": 'a "quoted"\nline', "answer": ""}, {"question": "short", "answer": None},
        {"question": "long", "answer": "1", "None": ["2"]}]


CSV_CELLS = ["a", "", "b c", 'say ""hi""', '"x\n,y"', '"\r\n"', '""', '"""q"""', "5\" disk", '"ends"tail', 'é日', '"' + "\n" * 9 + '"', "z" * 30]


def csv_text(seed, ends):
    rng = random.Random(seed)
    lines = ["k,v,w"] + [",".join(rng.choice(CSV_CELLS) for _ in range(rng.choice([1, 2, 3, 3, 3, 4]))) for _ in range(rng.randrange(0, 40))] + [""] * (seed % 3)
    return "\ufeff" * (seed % 2) + ends.join(lines) + ends * (seed % 4 > 0)


@pytest.mark.parametrize("ends", ["\n", "\r\n", "\r"])
@pytest.mark.parametrize("size", [1, 5, 17, 100])
def test_csv_blocks(tmp_path, size, ends, monkeypatch):
    monkeypatch.setattr(blocks, "CHUNK", 7)
    found_dialect = tables.dialect_of(",", '"', True, False)
    for seed in range(12):
        text = csv_text(seed, ends)
        path = tmp_path / f"{seed}.csv"
        path.write_bytes(text.encode())
        uri, length, inside, found = f"file:{path}", len(text.encode()), False, []
        for start in range(0, length, size):
            stop = min(length, start + size)
            found += tables.BlockCells(uri, start, stop, found_dialect, inside, True).records()
            inside = tables.ends_inside(uri, start, stop, found_dialect, inside)
        with path.open(encoding="utf-8-sig", newline="") as stream:
            assert found == [r for r in csv.reader(stream) if r], (seed, size)


@pytest.mark.parametrize("size", [40, 1 << 20])
def test_csv_files_in_blocks(spark, tmp_path, size, monkeypatch):
    """The same rows wherever files are cut, and files that cannot be read beside those that can."""
    monkeypatch.setattr(blocks, "MOST_TASKS", 8)
    for seed in range(9):
        (tmp_path / f"{seed}.csv").write_bytes(csv_text(seed, "\n").encode())
    (tmp_path / "long.csv").write_text("k,v\n" + "x" * 200_000 + ",1\n")
    (tmp_path / "headless.csv").write_text("k,,v\n1,2,3\n")
    (tmp_path / "bytes.csv").write_bytes(b"k,v\n" + b"1,2\n" * 30 + b"\xff,3\n4,5\n")
    table = readers.read_csv_table(spark, str(tmp_path), ",", size=size)
    found = {}
    for r in readers.rows_of(table).collect():
        found.setdefault(r["dataset_id"].rsplit("/")[-1], []).append((r["row_index"], json.loads(r["raw"])))
    assert {r["dataset_id"].rsplit("/")[-1]: r["code"] for r in readers.refused_of(table).collect()} == {"headless.csv": "CSV_HEADER", "bytes.csv": "BAD_CSV"}
    assert found.pop("long.csv") == [(1, {"k": "x" * 200_000, "v": "1"})]
    for seed in range(9):
        with (tmp_path / f"{seed}.csv").open(encoding="utf-8-sig", newline="") as stream:
            records = [r for r in csv.reader(stream) if r][1:]
        want = [{**dict(zip("kvw", [*r, None, None, None])), **({"None": r[3:]} if len(r) > 3 else {})} for r in records]
        assert sorted(found.pop(f"{seed}.csv", [])) == list(enumerate(want, 1))
    assert not found


def test_csv_files_of_unknown_separator(spark, tmp_path):
    (tmp_path / "one.csv").write_text("q\n1\n")
    (tmp_path / "two.csv").write_text("a;b\n1;2\n3;4\n")
    table = readers.read_csv_table(spark, str(tmp_path))
    assert [(r["dataset_id"][-7:], r["code"]) for r in readers.refused_of(table).collect()] == [("one.csv", "BAD_CSV")]
    assert sorted(json.loads(r["raw"])["b"] for r in readers.rows_of(table).collect()) == ["2", "4"]


def test_csv_lines_are_split_among_tasks(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k;v\n" + "".join(f"{i};x{i}\n" for i in range(2000)) + "\nshort\nlong;1;2\n")
    (tmp_path / "b.csv").write_text("q\n1\n")
    rows = readers.rows_of(readers.read_csv_table(spark, str(tmp_path), ";", multi_line=False, size=4096))
    found = {(r["dataset_id"][-5], r["row_index"]): json.loads(r["raw"]) for r in rows.collect()}
    assert found.pop(("b", 1)) == {"q": "1"} and found.pop(("a", 2001)) == {"k": "short", "v": None}
    assert found.pop(("a", 2002)) == {"k": "long", "v": "1", "None": ["2"]}
    assert found == {("a", i + 1): {"k": str(i), "v": f"x{i}"} for i in range(2000)}
    assert sorted(tuple(r)[1:] for r in readers.read_csv(spark, str(tmp_path), sep=";").collect()) == sorted(tuple(r)[1:] for r in rows.collect())


def test_a_header_without_names_is_a_violation(spark, tmp_path):
    (tmp_path / "bad.csv").write_text(",answer\nQ,A\n")
    assert [r["code"] for r in readers.csv_errors(spark, str(tmp_path / "bad.csv"), sep=",").collect()] == ["CSV_HEADER"]
    assert readers.read_csv(spark, str(tmp_path / "bad.csv"), sep=",").collect() == []


def test_parquet_and_chatml_reach_sft(spark, folder):
    typed = readers.read_parquet(spark, str(folder / "data.parquet"))
    raw = columns_to_rows(typed, ["instruction", "response"], F.lit("p"), F.col("row_index"))
    talk = readers.read_chatml_text(spark, str(folder / "talk.txt")).withColumn("dataset_id", F.lit("t"))
    done = convert.convert_dataset(to_row_model(raw.unionByName(talk)))
    assert {tuple(r) for r in done.rows.select("dataset_id", "instruction", "input", "output").collect()} == {("p", "Q", "", "A"), ("t", "Q", "", "A")}


def test_split_slices(spark):
    table = spark.createDataFrame([("en", "train", i) for i in range(10)] + [("en", "test", 4), ("de", "train", 4)], "subset string, split string, row_index bigint")
    assert [r["row_index"] for r in readers.select_split(table, "en", "train[4:5]").collect()] == [4]
    assert readers.select_split(table, None, "train").count() == 11
    assert readers.select_split(table, "en", "train[:3]").count() == 3
    with pytest.raises(ValueError):
        readers.select_split(table, "en", "train", {"split": "x"})


def test_file_digest(spark, folder):
    import hashlib

    found = {r["path"].rsplit("/", 1)[1]: (r["size"], r["sha256"]) for r in sinks.file_digest(spark, str(folder), 2).collect()}
    for path in folder.iterdir():
        data = path.read_bytes()
        assert found[path.name] == (len(data), hashlib.sha256(data).hexdigest())


def test_normalized_rows_keep_their_order(spark, tmp_path):
    data = [("d", i, None, f"q{i}", "", f"a{i}") for i in range(1, 500)]
    table = spark.createDataFrame(data, "dataset_id string, row_index bigint, turn bigint, instruction string, input string, output string").repartition(9)
    sinks.write_normalized(table, str(tmp_path / "out"))
    written = [json.loads(line)["instruction"] for f in sorted((tmp_path / "out" / "dataset_id=d").glob("*.json")) for line in f.read_text().splitlines()]
    assert written == [f"q{i}" for i in range(1, 500)]


def test_small_files_share_tasks_and_are_listed_once(spark, tmp_path):
    from sft_tables.sources.blocks import Blocks

    for i in range(300):
        (tmp_path / f"f{i}.csv").write_text("a;b\n1;2\n")
    blocks = Blocks(spark, str(tmp_path))
    assert blocks.tasks <= 10 and blocks.table.count() == 300
    for i in range(300):
        (tmp_path / f"f{i}.csv").unlink()
    assert blocks.files.count() == 300


def test_files_are_written_by_their_keys(spark, tmp_path):
    from sft_tables.plans import fixtures

    rows = spark.createDataFrame([(1, "a", "x"), (1, "a", "y"), (2, "b", "z"), (None, "b", None)], "k bigint, kind string, value string")
    fixtures.write_files(rows, ["k", "kind"], f"file://{tmp_path}/out")
    found = {str(p.parent.relative_to(tmp_path / "out")): p.read_text() for p in (tmp_path / "out").rglob("*.txt")}
    assert found.pop("k=1/kind=a") in ("x\ny\n", "y\nx\n")
    assert found == {"k=2/kind=b": "z\n", "k=__HIVE_DEFAULT_PARTITION__/kind=b": "\n"}
    assert not list((tmp_path / "out").rglob("_temporary")) and not (tmp_path / "out" / "_SUCCESS").exists()
