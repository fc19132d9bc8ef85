import ast
import random
import re
import time

import pandas as pd
import pytest
from pyspark.sql import Row

from sft_tables.operators import logs
from sft_tables.streaming import log_stream, tables

#: Two training phases around other work, each event with a twin that must not count.
LOG = (
    "\x1b[1mERROR: no cache, rebuilding\x1b[0m\nNum examples = 7\n{'loss': 9.0}\n 3/4 shards, 75%\r"
    "***** Running training *****\r\n  Num Epochs = 3\nTotal optimization steps=200\nshape (2/3)\n"
    "  0%| | 0/200 [00:00, ?it/s]\r  4%|.| 8/200 [00:04, 2.0it/s]\r  5%|.| 10/200 [00:05, 2.0it/s]\r  7%|.| 14/200 [00:07, 2.0it/s]\r"
    "{'grad_norm': 2, 'loss': 3.14159, 'tags': [['a'], ('b', {1: {}})]}\n{'epoch': 0.1}\n{'loss': 1 'epoch': 2}\n"
    " 11%|.| 22/200 [00:11, 2.0it/s]\r 11%|.| 22/200 [00:11, 2.0it/s]\rwarnings: none\nwarning: slow disk\n"
    "Traceback (most recent call last):\n  File 'step.py'\r\r  150/200 50%\nio.TimeoutError: gave up\n"
    " 16%|.| 31/200 [00:15, 2.0it/s]\r{'loss': 'inf', 'learning_rate': 0.00031415, 'train_runtime': 61.25}\n"
    "***** train metrics *****\n  epoch = 3\n{'loss': 0.5}\n 40/200 20%\ntraining completed in a minute\n{'loss': 0.25}\n"
    "***** Running training ***** again\n 90%|.| 9/10 [00:09, 1.0it/s]\r100%|.| 10/10 [00:10, 1.0it/s]\r 10%|.| 1/10 [00:01, 1.0it/s]\r"
    "100%|.| 10/10 [00:10, 1.0it/s]\r{'loss': True}\nTraceback (most recent call last):\nnot closed\ncritical state"
)
SHOWN = [
    "ERROR: no cache, rebuilding", "***** Running training *****", "Num Epochs = 3", "Total optimization steps=200",
    "Progress: 10/200 (5%)", "Step 14/200 | Loss 3.142 | GradNorm 2", "Progress: 22/200 (11%)", "warning: slow disk",
    "Traceback (most recent call last):", "File 'step.py'", "150/200 50%", "io.TimeoutError: gave up",
    "Step 31/200 | Loss inf | LR 0.000314 | Runtime 61.2s",
    "***** Running training ***** again", "Progress: 9/10 (90%)", "Progress: 10/10 (100%)", "Progress: 10/10 (100%)", "Step 10/10 | Loss 1",
    "Traceback (most recent call last):", "not closed", "critical state",
]


def chunked(spark, text, size, runs=(1,)):
    pieces = [(r, n + 1, text[i : i + size]) for r in runs for n, i in enumerate(range(0, len(text), size))]
    return spark.createDataFrame(pieces, "run_id bigint, chunk_no bigint, text string").repartition(5)


def shown(table):
    return [r["text"] for r in table.orderBy("run_id", "seq").collect()]


@pytest.mark.parametrize("size", [1, 17, 4096])
@pytest.mark.parametrize("block", [2, 16384])
def test_concise_view_does_not_depend_on_chunks_or_blocks(spark, size, block):
    if size == 1 and block == 2:
        pytest.skip("covered by the other sizes")
    records = logs.split_records(chunked(spark, LOG, size), block)
    assert shown(logs.filter_verbosity(records, "concise", block)) == SHOWN


def streamed(spark, folder, batches, pause=0, **options):
    """Shown lines of micro-batches of (run_id, chunk_no, text, last), in one query or in one for each of them."""
    source = spark.readStream.schema(log_stream.CHUNKS).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in/*")
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, log_stream.CHUNKS).coalesce(1).write.parquet(f"{folder}/in/{i:03}")
        if pause or i == len(batches) - 1:
            tables.run_to_end(log_stream.log_stream(source, f"{folder}/out", f"{folder}/state", **options))
            time.sleep(pause)
    found = spark.read.schema(log_stream.LINES).parquet(f"{folder}/out/lines").orderBy("run_id", "line_no").collect()
    return [(r["run_id"], r["text"]) for r in found]


def state_rows(spark, folder):
    """Runs that have state, by state variable."""
    found = {}
    for operator, names in enumerate([["carried"], ["place", "open", "early"]]):
        for name in names:
            state = spark.read.format("statestore").option("operatorId", operator).option("stateVarName", name).load(f"{folder}/state")
            found[name] = {r["key"]["run_id"] for r in state.collect()}
    return found


def test_stream_agrees_with_batch(spark, tmp_path):
    pieces = [LOG[i:i + 23] for i in range(0, len(LOG), 23)]
    chunks = [(run, n, text, n == len(pieces)) for run in (1, 2) for n, text in enumerate(pieces, 1)]
    rng = random.Random(3)
    mixed = chunks[:8] + rng.sample(chunks[8:], len(chunks) - 8)
    again = rng.sample(mixed[:40], 10)  # chunks that come twice change nothing
    batches = [mixed[i:i + 17] for i in range(0, len(mixed) - 20, 17)] + [again + [(3, 1, "ERROR c\nERROR", False), (3, 3, "", False)]]
    batches.append([c for c in mixed if not any(c in b for b in batches)])
    assert streamed(spark, tmp_path, batches) == [(1, t) for t in SHOWN] + [(2, t) for t in SHOWN] + [(3, "ERROR c")]
    assert state_rows(spark, tmp_path) == {"place": {3}, "open": {3}, "early": {3}, "carried": {3}}


def test_stream_gives_up_gaps_and_idle_runs(spark, tmp_path):
    """Each batch is a query of its own that goes on from the checkpoint; timers run between them."""
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    batches = [[(1, 1, "ERROR a\nERROR b", False), (2, 2, "ERROR late\n", False)], [(3, 1, "ERR", False)], [(3, 2, "OR y", False)], [(4, 1, "x", True)]]
    found = streamed(spark, tmp_path, batches, pause=1.5, patience=1, ttl=1)
    spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")
    # chunks are taken before timers, so the second chunk of run 3 is in time
    assert found == [(1, "ERROR a"), (1, "ERROR b"), (2, "ERROR late"), (3, "ERROR y")]
    assert not any(state_rows(spark, tmp_path).values())


def test_records_remember_their_terminator(spark):
    records = logs.split_records(chunked(spark, "a\rb\n\n\r\rc", 2)).orderBy("seq").collect()
    assert [(r["line"], r["cr"]) for r in records] == [("a", True), ("b", False), ("", False), ("c", False)]


def test_quiet_and_full(spark):
    records = logs.split_records(chunked(spark, "INFO x\nERROR y\nWARNING z\n", 5))
    assert shown(logs.filter_verbosity(records, "quiet")) == ["ERROR y"]
    assert shown(logs.filter_verbosity(records, "full")) == ["INFO x", "ERROR y", "WARNING z"]
    with pytest.raises(ValueError):
        logs.filter_verbosity(records, "loud")


def steps(pairs):
    return "***** Running training *****\n" + "".join(f" {c}%|x| {c}/{t} [1.0it/s]\r" for c, t in pairs)


def greedy(pairs):
    last, before, out = 0, None, []
    for c, t in pairs:
        if (c, t) != before and (c == t or c >= last + max(1, t // 20)):
            out.append((c, t))
            last = c
        before = (c, t)
    return out


def test_throttle(spark):
    rng = random.Random(11)
    walk = [(rng.randint(0, 60), rng.choice([40, 60])) for _ in range(120)]
    logs_by_run = {1: [(i, 100) for i in range(1, 101)], 2: walk, 3: [(2, 2), (2, 2), (1, 2), (2, 2)]}
    pieces = [(run, 1, steps(pairs)) for run, pairs in logs_by_run.items()]
    chunks = spark.createDataFrame(pieces, "run_id bigint, chunk_no bigint, text string")
    found = logs.throttle_progress(logs.classify(logs.split_records(chunks), 7)).orderBy("run_id", "seq").collect()
    for run, pairs in logs_by_run.items():
        assert [(r["current"], r["total"]) for r in found if r["run_id"] == run] == greedy(pairs)
    assert len([r for r in found if r["run_id"] == 1]) <= 21


def test_metric_numbers(spark):
    lines = ["{'loss': '1e-05', 'epoch': 2,}", "x {'loss': 1} y {'epoch': 2}", "{'loss': nan}", "{'other': 1}", "{'loss': True, 'loss': .5}",
             r"{'loss': 0.5, 'extra': [1, {'loss': 2}], 'note': 'it\'s {x}', 't': (1, 2,)}", "{'extra': {'loss': 3}}"]
    table = spark.createDataFrame(list(enumerate(lines)), "i int, line string")
    found = {r["i"]: (r["loss"], r["epoch"]) for r in logs.parse_metrics(table).collect()}
    assert found == {0: (1e-05, 2.0), 4: (0.5, None), 5: (0.5, None)}


def literal(rng, depth):
    if not depth or rng.random() < 0.4:
        return rng.choice(["1", "-2.5", ".5", "1e-3", "'a'", '"b,]"', "True", "None", "3."])
    items = [literal(rng, depth - 1) for _ in range(rng.randrange(4))]
    end = rng.choice(["", ","]) if items else ""
    kind = rng.choice("[({d")
    if kind == "d":
        return "{" + ", ".join(rng.choice(["'k'", "1", "(1, 2)", "'loss'"]) + ": " + x for x in items) + end + "}"
    if kind == "{":
        return "{" + " ,\n".join(rng.choice(["1", "'x'", "None"]) for _ in items) + end + "}"
    return kind + ",".join(items) + end + {"[": "]", "(": ")"}[kind]


def test_metrics_of_any_nesting(spark):
    """Which lines are literals, and what their metrics are, against Python's own reader."""
    rng = random.Random(5)
    lines = ["{'loss': 1, 'e': [[[[1]]]]}", "{'loss': 1, 'e': {1, 2}}", "{'loss': 1, 1: 2}", "{'loss'}", "{'loss': 1, 'b'}", "{'loss':: 1}", "{,}", "{'loss': [1,}"]
    for _ in range(400):
        text = "{" + ", ".join(rng.choice(["'loss'", "'epoch'", "'x'", "7"]) + ": " + literal(rng, 5) for _ in range(rng.randrange(1, 4))) + "}"
        if rng.random() < 0.4:
            at = rng.randrange(1, len(text) - 1)
            text = text[:at] + rng.choice(["", ",", "]", "}", ":", "x", " "]) + text[at + rng.randrange(2):]
        lines.append("log " + text)
    table = spark.createDataFrame(list(enumerate(lines)), "i int, line string")
    found = {r["i"]: r["p"] for r in table.select("i", logs.metric_pairs("line").alias("p")).collect()}
    for i, line in enumerate(lines):
        text = line[line.find("{"):line.rfind("}") + 1]
        try:
            value = ast.literal_eval(text)
        except (ValueError, SyntaxError, TypeError):
            value = None
        wanted = {k: v for k, v in value.items() if isinstance(k, str) and k in logs.METRIC_LABELS} if isinstance(value, dict) else {}
        last = {p["name"]: p["value"] for p in found[i] or []}
        assert last.keys() == wanted.keys(), text
        for name, v in wanted.items():
            assert last[name] == v or ast.literal_eval(last[name]) == v, text  # a value keeps its text, brackets around it too


def test_chunks_in_order_ask_the_state_once_a_run():
    asked = []

    class State:
        def __init__(self, name):
            self.name, self.value = name, None

        def __getattr__(self, call):
            asked.append((self.name, call))
            return {"exists": lambda: False, "get": lambda: None, "update": lambda value: setattr(self, "value", value)}[call]

    class Handle:
        getValueState = getListState = getMapState = staticmethod(lambda name, *_: State(name))

    records = log_stream.Records(None, None)
    records.init(Handle)
    chunks = pd.DataFrame({"chunk_no": range(1, 501), "text": ["x\n"] * 500, "last": [False] * 500})
    [found] = records.handleInputRows((1,), iter([chunks]), None)
    assert len(found) == 500 and records.place.value == (501, 500)
    assert len(asked) <= 4


class Kept:
    """State of one run as Spark keeps it, with a list of the calls to it."""

    def __init__(self, asked):
        self.asked, self.value = asked, []

    def __getattr__(self, call):
        def answer(*given):
            self.asked.append(call)
            if call in ("update", "put", "clear"):
                self.value = list(given[0]) if given else []
            elif call == "appendValue":
                self.value = [*self.value, *given]
            elif call == "appendList":
                self.value = [*self.value, *given[0]]
            return {"get": tuple(self.value) or None, "exists": bool(self.value)}.get(call)

        return answer


class KeptList(Kept):
    def get(self):
        self.asked.append("get")
        return iter(self.value)


def by_rows():
    asked = []

    class Handle:
        getValueState = staticmethod(lambda *_: Kept(asked))
        getListState = staticmethod(lambda *_: KeptList(asked))

    records = log_stream.RecordRows(None, None)
    records.init(Handle)

    def pieces(batch):
        rows = [Row(run_id=1, chunk_no=n, text=text, last=last) for n, text, last in batch]
        return [(row.seq + i + 1, p) for row in records.handleInputRows((1,), iter(rows), None) for i, p in enumerate(row.pieces)]

    return records, asked, pieces


def test_early_chunks_ask_the_state_once_a_batch():
    chunks = [(n, f"a{n}\nb", n == 900) for n in range(1, 901)]
    records, asked, pieces = by_rows()
    for batch in (chunks[600:], chunks[300:600]):
        assert pieces(batch) == [] and len(asked) <= 3
        asked.clear()
    found = pieces(chunks[:300])
    assert [p for _, p in found] == ["a1\n"] + [f"ba{n}\n" for n in range(2, 901)] + ["b", None]
    assert [seq for seq, _ in found] == list(range(1, 903)) and len(asked) <= 4
    assert not (records.place.value or records.open.value or records.early.value)


@pytest.mark.parametrize("seed", range(30))
def test_chunks_in_any_order_and_more_than_once(seed):
    rng = random.Random(seed)
    text = "".join(rng.choice("ab\r\n") for _ in range(300))
    cuts = [0, *sorted(rng.sample(range(1, 300), 60)), 300]
    chunks = [(n, text[a:b], b == 300) for n, (a, b) in enumerate(zip(cuts, cuts[1:]), 1)]
    if seed % 2:
        chunks = [chunk for i in range(0, len(chunks), 7) for chunk in rng.sample(chunks[i:i + 7], len(chunks[i:i + 7]))]
    else:
        rng.shuffle(chunks)
    records, _, pieces = by_rows()
    found, at = [], 0
    while at < len(chunks):
        size = rng.randrange(1, 12)
        found += pieces([*chunks[at:at + size], *rng.sample(chunks[:at], min(at, 3))])
        at += size
        assert bool(records.early.value) == (at < len(chunks) and records.place.value[0] < 0)
    assert [p for _, p in found] == [p for p in re.split(r"(?<=[\r\n])", text) if p] + [None]
    assert [seq for seq, _ in found] == list(range(1, len(found) + 1))
    assert not (records.place.value or records.open.value or records.early.value)
