"""Training-log operators over records (run_id, seq, line, cr), in batch.

The reading order inside a run matters, but only through a few "last marker" values (inside a traceback?
which phase? last progress?). Those are carried per block of ``seq`` (see functions.carry), so one run with
most of the rows is still spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sft_tables.functions.carry import BLOCK, BLOCK_COL, before, earlier_blocks, last_in_block, running_total, with_block
from sft_tables.functions.once import once
from sft_tables.functions.text import strip

# Markers, patterns, metric names and their labels, lifecycle prefixes.
ANSI = r"\x1b\[[0-?]*[ -/]*[@-~]"
TRACEBACK_START = "Traceback (most recent call last):"
TRACEBACK_END = r"(?U)\A[\w.]+(?:Error|Exception):"
IMPORTANT = r"(?iU)\b(?:ERROR|CRITICAL)\b"
WARNING = r"(?iU)\bWARNING\b"
PHASE_START = "***** Running training *****"
PHASE_METRICS = "***** train metrics *****"
PHASE_DONE = r"(?iU)\bTraining completed\b"
DETAIL = r"(?iU)(?:Num examples|Num Epochs|Total optimization steps)[\s\x1c-\x1f]*="
PROGRESS = r"(?U)(\d+)[\s\x1c-\x1f]*/[\s\x1c-\x1f]*(\d+)"
METRIC_LABELS = {
    "epoch": "Epoch", "loss": "Loss", "grad_norm": "GradNorm", "learning_rate": "LR", "train_loss": "Train loss",
    "train_runtime": "Runtime", "train_samples_per_second": "Samples/sec", "train_steps_per_second": "Steps/sec",
}
LIFECYCLE_PREFIXES = (
    "Created run ", "Starting LLaMA-Factory training", "Run completed successfully", "Run preparation failed",
    "Training run failed",
)
PROGRESS_SHARE = 20
STRING = r"""(?:'(?:[^'\\]|\\.)*+'|"(?:[^"\\]|\\.)*+")"""
NUMBER = r"[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?"


#: Pieces of a literal; every character belongs to one.
TOKEN = rf"(?s)({STRING}|{NUMBER}|[A-Za-z_]\w*|\s+|.)"
SHOWN = ("error", "warning", "phase_start", "progress", "metrics", "detail")


def split_records(chunks: DataFrame, block: int = BLOCK) -> DataFrame:
    """Records of a chunked character stream (run_id, chunk_no, text), cut after each \\r or \\n.

    A piece that starts and ends inside its chunk is a record already. Only pieces touching a chunk border
    are regrouped, by record number, so no run is ever concatenated as a whole.
    """
    terminated = F.length("text") - F.length(F.translate("text", "\r\n", ""))
    numbered = running_total(chunks, ["run_id"], "chunk_no", terminated, "_base", block)
    pieces = numbered.select(
        "run_id", "chunk_no", "_base", F.posexplode(F.split("text", r"(?<=[\r\n])")).alias("_pos", "piece")
    ).filter("piece <> ''").select(
        "run_id", "chunk_no", "piece", "_pos", (F.col("_base") + F.col("_pos") + 1).alias("seq"),
        F.right("piece", F.lit(1)).isin("\r", "\n").alias("_ended"),
    )
    inner = F.expr("_pos > 0 AND _ended")
    whole = pieces.filter(inner).select("run_id", "seq", "piece")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_no", "piece"))), lambda x: x["piece"]), "")
    spanning = pieces.filter(~inner).groupBy("run_id", "seq").agg(text.alias("piece"))
    piece = F.col("piece")
    records = whole.unionByName(spanning).select("run_id", "seq", record_line(piece).alias("line"), record_cr(piece).alias("cr"))
    return records.filter("NOT (cr AND line = '')")


def record_line(piece: Column) -> Column:
    """The line of a piece, without the character that ends it."""
    return F.regexp_replace(piece, r"[\r\n]\z", "")


def record_cr(piece: Column) -> Column:
    return F.endswith(piece, F.lit("\r"))


def strip_ansi(line: Column) -> Column:
    return strip(F.regexp_replace(line, ANSI, ""))


def said(line: Column) -> dict[str, Column]:
    """What a stripped line says by itself."""
    return {
        "blank": line == "", "tb_start": F.startswith(line, F.lit(TRACEBACK_START)),
        "tb_end": line.rlike(TRACEBACK_END), "important": line.rlike(IMPORTANT),
        "warning": line.rlike(WARNING), "starts": line.contains(PHASE_START),
        "summary": line.contains(PHASE_METRICS), "done": line.rlike(PHASE_DONE),
        "step": parse_progress(line),
    }


def marks(records: DataFrame) -> DataFrame:
    """What every record says by itself."""
    line = F.col("line")
    return once(records.select("run_id", "seq", "cr", strip_ansi(F.col("line")).alias("line")), line=line).select(
        "*", *[mark.alias(name) for name, mark in said(line).items()])


def tag_records(records: DataFrame, block: int = BLOCK) -> DataFrame:
    """Add in_traceback, phase ('train', 'table' or NULL), phase_seq (the record that opened it) and
    ``last_step`` (seq, current, total of the last progress record before, of any phase).

    Whether a block starts inside a traceback is not known inside the block, so the markers are found under both
    assumptions; block summaries then settle which one holds. One pass over the records carries everything.
    """
    keys = ["run_id"]
    w = before(keys, "seq")
    tb = F.when(F.col("tb_start"), F.lit(True)).when(F.col("tb_end") | (F.col("blank") & ~F.col("cr")), F.lit(False))
    state = F.when(F.col("starts"), "train").when(F.col("summary"), "table").when(F.col("done"), "none")

    def markers(entering: bool) -> dict[str, Column]:
        inside = F.col("tb_start") | F.coalesce(F.col("_tb_before"), F.lit(entering))
        plain = ~F.col("blank") & ~inside & ~F.col("important") & ~F.col("warning")
        return {
            "phase": F.when(plain & state.isNotNull(), F.struct(state.alias("phase"), F.col("seq").alias("at"))),
            "step": F.when(plain & state.isNull() & F.col("step").isNotNull(), F.struct("seq", "step.current", "step.total")),
        }

    base = with_block(marks(records), "seq", block).withColumn("_tb", tb)
    base = base.withColumn("_tb_before", F.last("_tb", ignorenulls=True).over(w))
    both = {f"_{kind}{int(entering)}": c for entering in (False, True) for kind, c in markers(entering).items()}
    base = base.withColumns(both)
    local = base.withColumns({f"{n}_before": F.last(n, ignorenulls=True).over(w) for n in both})

    over_blocks = earlier_blocks(keys)
    summary = base.groupBy(*keys, BLOCK_COL).agg(*[last_in_block(F.col(m), "seq").alias(m) for m in ("_tb", *both)])
    entering = summary.withColumn("_tb_in", F.coalesce(F.last("_tb", ignorenulls=True).over(over_blocks), F.lit(False)))
    settled = lambda kind: F.when(F.col("_tb_in"), F.col(f"_{kind}1")).otherwise(F.col(f"_{kind}0"))
    entering = entering.withColumns({"_phase": settled("phase"), "_step": settled("step")}).select(
        *keys, BLOCK_COL, "_tb_in", F.last("_phase", ignorenulls=True).over(over_blocks).alias("_phase_in"),
        F.last("_step", ignorenulls=True).over(over_blocks).alias("_step_in"),
    ).filter("_tb_in OR _phase_in IS NOT NULL OR _step_in IS NOT NULL")

    joined = local.join(entering, [*keys, BLOCK_COL], "left")
    tb_in = F.coalesce("_tb_in", F.lit(False))
    last = lambda kind: F.coalesce(
        F.when(tb_in, F.col(f"_{kind}1_before")).otherwise(F.col(f"_{kind}0_before")), F.col(f"_{kind}_in"))
    phase = F.nullif(last("phase")["phase"], F.lit("none"))
    return joined.select(
        "run_id", "seq", "cr", "line", "blank", "important", "warning", "starts", "summary", "done", "step",
        (F.col("tb_start") | F.coalesce("_tb_before", tb_in)).alias("in_traceback"),
        phase.alias("phase"), F.when(phase.isNotNull(), last("phase")["at"]).alias("phase_seq"), last("step").alias("last_step"),
    )


def parse_progress(line: Column) -> Column:
    """Struct (current, total) of the first 'a/b' of a progress line, else NULL; numbers beyond a long are none."""
    shape = line.rlike(PROGRESS) & (line.contains("%") | line.contains("it/s"))
    number = lambda i: F.regexp_extract(line, PROGRESS, i).try_cast("bigint")
    return F.when(shape & number(1).isNotNull() & number(2).isNotNull(), F.struct(number(1).alias("current"), number(2).alias("total")))


def _sql_text(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


BLANK_SQL = _sql_text(" \t\n\r\f\v")


def _token_kind(t: str) -> str:
    """SQL: 'b' blank, 'S' text, 'A' another plain value, a bracket, comma or colon itself, else 'x'."""
    return (f"CASE WHEN {t} IN ('[', '(', '{{', ']', ')', '}}', ':', ',') THEN {t} WHEN trim(BOTH {BLANK_SQL} FROM {t}) = '' THEN 'b' "
            f"WHEN left({t}, 1) IN ({_sql_text(chr(39))}, {_sql_text(chr(34))}) THEN CASE WHEN length({t}) > 1 THEN 'S' ELSE 'x' END "
            f"WHEN {t} IN ('True', 'False', 'None') OR {t} RLIKE '^[-+.]*[0-9]' THEN 'A' ELSE 'x' END")


def _literal_scan(kinds: str) -> str:
    """SQL: one walk over the kinds of a literal's tokens, for any depth of lists, tuples, sets and dictionaries.

    ``s`` holds the open brackets: '[' and '(' as they are, '{' while it may be a set or a dictionary, then 's', or 'D'
    before a key's colon and 'd' after it. ``w`` is what may come: 'v' a value, 'o' a value or the end, 'a' what follows a
    value, 'e' nothing more, 'x' is broken. ``p`` collects, for text keys of the outer dictionary, the places of the key
    and of the value's first token and of the token after it.
    """
    depth, top, filled = "length(a.s)", "right(a.s, 1)", "a.w IN ('v', 'o')"
    opens, closes, value = "k IN ('[', '(', '{')", "k IN (']', ')', '}')", "k IN ('S', 'A')"
    inner = "left(a.s, length(a.s) - 1)"
    fits = f"(k = ']' AND {top} = '[' OR k = ')' AND {top} = '(' OR k = '}}' AND {top} IN ('{{', 's', 'd', 'D'))"
    # a dictionary may end after a value or a comma, not after a lone key; the outermost must not be a set
    ended = f"(a.w = 'o' OR a.w = 'a' AND {top} <> 'D') AND NOT ({depth} = 1 AND ({top} = 's' OR {top} = '{{' AND a.w = 'a'))"
    fine = (f"CASE WHEN k = 'b' THEN true WHEN {opens} THEN {filled} AND ({depth} > 0 OR k = '{{') WHEN {value} THEN {filled} AND {depth} > 0 "
            f"WHEN k = ':' THEN a.w = 'a' AND {top} IN ('{{', 'D') WHEN k = ',' THEN a.w = 'a' AND {top} <> 'D' "
            f"WHEN {closes} THEN {depth} > 0 AND {fits} AND ({ended}) ELSE false END")
    stack = (f"CASE WHEN {opens} THEN a.s || k WHEN k = ':' THEN {inner} || 'd' "
             f"WHEN k = ',' THEN {inner} || CASE {top} WHEN '{{' THEN 's' WHEN 'd' THEN 'D' ELSE {top} END WHEN {closes} THEN {inner} ELSE a.s END")
    want = (f"CASE WHEN a.w = 'x' OR NOT {fine} THEN 'x' WHEN k = 'b' THEN a.w WHEN {opens} OR k = ',' THEN 'o' WHEN k = ':' THEN 'v' "
            f"WHEN {closes} AND {depth} = 1 THEN 'e' ELSE 'a' END")
    key = f"CASE WHEN {depth} = 1 AND {top} IN ('{{', 'D') AND k <> 'b' AND k <> ':' THEN CASE WHEN k = 'S' THEN a.n ELSE -1 END ELSE a.k END"
    begin = f"CASE WHEN k = ':' AND {depth} = 1 THEN a.n + 1 ELSE a.f END"
    pairs = f"CASE WHEN (k = ',' OR {closes}) AND {depth} = 1 AND {top} = 'd' AND a.k >= 0 THEN array_append(a.p, named_struct('k', a.k, 'f', a.f, 'n', a.n)) ELSE a.p END"
    zero = ("named_struct('s', '', 'w', 'v', 'n', 0, 'k', -1, 'f', 0, 'p', CAST(array() AS array<struct<k:int,f:int,n:int>>))")
    step = f"named_struct('s', {stack}, 'w', {want}, 'n', a.n + 1, 'k', {key}, 'f', {begin}, 'p', {pairs})"
    return f"aggregate({kinds}, {zero}, (a, k) -> CASE WHEN a.w = 'x' THEN a ELSE {step} END)"


def metric_pairs(line: str) -> Column:
    """Array of (name, value text) of the dictionary between the first { and the last } of a column, else NULL.

    Values are literals of any nesting and keep their text; a quoted name or value loses its quotes and escapes.
    """
    def bare(text: str) -> str:
        ends, escaped = _sql_text(r"""\A['"]|['"]\z"""), _sql_text(r"\\(.)")
        inner = f"regexp_replace(regexp_replace({text}, {ends}, ''), {escaped}, '$1')"
        quote = _sql_text(r"""\A['"]""")
        return f"CASE WHEN {text} RLIKE {quote} THEN {inner} ELSE {text} END"

    whole = f"regexp_extract({line}, {_sql_text('(?s)' + chr(92) + '{.*' + chr(92) + '}')}, 0)"
    value = f"trim(BOTH {BLANK_SQL} FROM array_join(slice(t, p.f + 1, p.n - p.f), ''))"
    named = f"named_struct('name', {bare('t[p.k]')}, 'value', {bare(value)})"
    walked = _literal_scan(f"transform(t, x -> {_token_kind('x')})")
    known = ", ".join(_sql_text(n) for n in METRIC_LABELS)
    # lists of one keep a value, so that each step stands in the plan once
    pairs = (f"transform(array(CASE WHEN {whole} <> '' THEN regexp_extract_all({whole}, {_sql_text(TOKEN)}, 1) END), t -> "
             f"transform(array({walked}), a -> CASE WHEN a.w = 'e' THEN filter(transform(a.p, p -> {named}), q -> q.name IN ({known})) END)[0])")
    return F.expr(f"get(filter({pairs}, f -> size(f) > 0), 0)")


def _value_sql(pairs: str, name: str) -> str:
    """Value text of one metric; a repeated name keeps the last value."""
    return f"try_element_at(filter({pairs}, p -> p.name = '{name}'), -1).value"


def parse_metrics(records: DataFrame, line: str = "line") -> DataFrame:
    """Metric lines with one DOUBLE column per known metric (NULL where absent or not a number)."""
    found = once(records, _pairs=metric_pairs(f"`{line}`")).filter("_pairs IS NOT NULL")
    return found.select(
        *records.columns, *[F.expr(f"try_cast({_value_sql('_pairs', n)} AS DOUBLE)").alias(n) for n in METRIC_LABELS])


def classify(records: DataFrame, block: int = BLOCK) -> DataFrame:
    """Tag every record with its kind; priority is the order of the CASE. ``progress`` is the step of a progress
    record, ``last_step`` the progress record before it in the same training phase."""
    return kinds(tag_records(records, block))


def kinds(tagged: DataFrame, *keep: str) -> DataFrame:
    """Kinds of tagged records, which know what they depend on; batch and stream share them."""
    training = F.coalesce(F.col("phase") == "train", F.lit(False))
    table = F.coalesce(F.col("phase") == "table", F.lit(False))
    line = F.col("line")
    plain = training & ~F.col("important") & ~F.col("in_traceback") & ~F.col("warning")
    parsed = once(tagged, pairs=F.when(plain & F.col("step").isNull() & line.contains("{"), metric_pairs("line")))
    loss = F.exists("pairs", lambda p: p["name"] == "loss")
    kind = (
        F.when(F.col("blank"), "blank").when(F.col("in_traceback") | F.col("important"), "error")
        .when(F.col("warning"), "warning").when(F.col("starts"), "phase_start").when(F.col("summary"), "phase_summary")
        .when(F.col("done"), "phase_done").when(table, "final_table").when(training & F.col("step").isNotNull(), "progress")
        .when(F.coalesce(loss, F.lit(False)), "metrics").when(training & line.rlike(DETAIL), "detail").otherwise("noise")
    )
    return once(parsed, kind=kind).select(
        "run_id", "seq", "cr", "line", "kind", "in_traceback", "phase", "phase_seq",
        F.when(F.col("kind") == "progress", F.col("step")).alias("progress"),
        F.when(F.col("last_step.seq") > F.col("phase_seq"), F.col("last_step")).alias("last_step"), "pairs", *keep)


def _repeated() -> Column:
    """A progress record equal to the one before it in the same phase."""
    same = (F.col("last_step.current") == F.col("progress.current")) & (F.col("last_step.total") == F.col("progress.total"))
    return F.coalesce((F.col("kind") == "progress") & same, F.lit(False))


def _distinct_progress(classified: DataFrame) -> DataFrame:
    return classified.filter((F.col("kind") == "progress") & ~_repeated()).select("run_id", "phase_seq", "seq", "progress.current", "progress.total")


def is_due(current: int, total: int, last: int) -> bool:
    """Whether a step is shown after ``last`` was."""
    return current == total or current >= last + max(1, total // PROGRESS_SHARE)


def _shown_steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (run_id, part, seq); of progress rows (with a ``current``) those to show, of others all.

    A phase is a fold, what is shown depending on what was shown before; it is read as a stream, and the last step that
    was shown is all that is kept.
    """
    phase, last = None, 0
    for batch in batches:
        keep = []
        for run, part, current, total in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("run_id", "part", "current", "total"))):
            if (run, part) != phase:
                phase, last = (run, part), 0
            due = current is None or is_due(current, total, last)
            if due and current is not None:
                last = current
            keep.append(due)
        yield batch.filter(pa.array(keep, pa.bool_()))


def _streamed(rows: DataFrame) -> DataFrame:
    ordered = rows.repartition("run_id", "part").sortWithinPartitions("run_id", "part", "seq")
    return ordered.mapInArrow(_shown_steps, rows.schema)


def _percent(current: Column, total: Column) -> Column:
    """Whole percent; a total of zero has none."""
    return F.bround(F.try_divide(F.lit(100.0) * current, total), 0).cast("bigint")


def throttle_progress(classified: DataFrame) -> DataFrame:
    """Progress records to show: the final step, or a twentieth of the total beyond the last one shown. Records that
    repeat the one before them, and those of a zero total, are not shown."""
    rows = _distinct_progress(classified).select("run_id", F.col("phase_seq").alias("part"), "seq", "current", "total")
    shown = _streamed(rows).filter("total <> 0")
    return shown.select("run_id", F.col("part").alias("phase_seq"), "seq", "current", "total", _percent(F.col("current"), F.col("total")).alias("percent"))


def _formatted(pattern: str):
    """Numbers by a C format, whole columns at a time: the JVM rounds decimal ties by another rule."""
    @F.pandas_udf(T.StringType())
    def run(x: pd.Series) -> pd.Series:
        known = x.notna().to_numpy()
        out = np.full(len(x), None, object)
        out[known] = np.char.mod(pattern, x.to_numpy(float, na_value=np.nan)[known])
        return pd.Series(out)

    return run


def metric_text(value: Column, name: str) -> Column:
    """How the console shows a metric; what is no number stays as it is."""
    number = F.when(value == "True", 1.0).when(value == "False", 0.0).otherwise(value.try_cast("double"))
    odd = F.when(F.isnan(number), "nan").when(number == float("inf"), "inf").when(number == float("-inf"), "-inf")
    pattern = "%.1f" if name == "train_runtime" else "%.3g" if name == "learning_rate" else "%.4g"
    shown = odd.otherwise(_formatted(pattern)(F.when(odd.isNull(), number)))
    return F.when(number.isNull(), value).otherwise(F.concat(shown, F.lit("s" if name == "train_runtime" else "")))


def format_metrics(metrics: DataFrame, step: Column | None = None) -> DataFrame:
    """Add ``text``: the optional step, then the known metrics in the order of their labels (input has ``pairs``)."""
    values = once(metrics, _m=F.struct(*[F.expr(_value_sql("pairs", n)).alias(n) for n in METRIC_LABELS]))
    shown = [F.concat(F.lit(f"{label} "), metric_text(F.col(f"_m.{n}"), n)) for n, label in METRIC_LABELS.items()]
    return values.withColumn("text", F.concat_ws(" | ", *([step] if step is not None else []), *shown)).drop("_m")


def filter_verbosity(records: DataFrame, mode: str = "concise", block: int = BLOCK) -> DataFrame:
    """Console text (run_id, seq, text): quiet shows errors, concise the shown kinds, full every record unchanged."""
    if mode == "full":
        return records.select("run_id", "seq", F.col("line").alias("text"))
    if mode not in ("quiet", "concise"):
        raise ValueError(f"verbosity must be concise, full or quiet, not {mode!r}")
    classified = classify(records, block)
    if mode == "quiet":
        return classified.filter("kind = 'error'").select("run_id", "seq", F.col("line").alias("text"))
    return shown_lines(classified, block).select("run_id", "seq", "text")


def shown_lines(classified: DataFrame, block: int = BLOCK) -> DataFrame:
    """(run_id, seq, kind, current, text) of all lines of the concise view, from one pass over classified records.

    Progress goes in order through its phase; other lines are dealt out by blocks and pass.
    """
    part = F.when(F.col("kind") == "progress", F.col("phase_seq")).otherwise(-1 - F.floor(F.col("seq") / block).cast("bigint"))
    rows = told(classified.filter(F.col("kind").isin(*SHOWN) & ~_repeated())).select(
        "run_id", part.alias("part"), "seq", F.col("progress.current").alias("current"), F.col("progress.total").alias("total"), "kind", "text")
    return _streamed(rows).filter("kind <> 'progress' OR total <> 0").select("run_id", "seq", "kind", "current", "text")


def told(classified: DataFrame) -> DataFrame:
    """Records with the ``text`` that the concise view shows for them."""
    lines = format_metrics(classified, _step(F.col("last_step")))
    progress = F.col("progress")
    percent = _percent(progress["current"], progress["total"])
    step = F.format_string("Progress: %d/%d (%d%%)", progress["current"], progress["total"], percent)
    kind = F.col("kind")
    return lines.withColumn("text", F.when(kind == "progress", step).when(kind == "metrics", F.col("text")).otherwise(F.col("line")))


def _step(last: Column) -> Column:
    return F.when(last.isNotNull(), F.format_string("Step %d/%d", last["current"], last["total"]))


def metric_lines(classified: DataFrame) -> DataFrame:
    """Metric records with the last progress of their phase and their console text."""
    return format_metrics(classified.filter("kind = 'metrics'"), _step(F.col("last_step")))


def quiet_lifecycle(log: DataFrame) -> DataFrame:
    """Rows (level, message) shown on a quiet console: warnings and above, or run lifecycle messages."""
    prefix = F.lit(False)
    for text in LIFECYCLE_PREFIXES:
        prefix = prefix | F.startswith("message", F.lit(text))
    return log.filter(F.col("level").isin("WARNING", "ERROR", "CRITICAL") | prefix)


def run_log_summary(records: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per run: errors, warnings, last step, last loss, and whether the run closed its training phase."""
    c = classify(records, block)
    kind = F.col("kind")
    loss = F.expr(f"try_cast({_value_sql('pairs', 'loss')} AS DOUBLE)")
    is_progress, is_metrics = kind == "progress", kind == "metrics"
    return c.groupBy("run_id").agg(
        F.count_if(kind == "error").alias("errors"), F.count_if(kind == "warning").alias("warnings"),
        F.max_by("progress.current", F.when(is_progress, F.col("seq"))).alias("last_step"),
        F.max_by(loss, F.when(is_metrics, F.col("seq"))).alias("last_loss"),
        F.coalesce(F.max(kind.isin("phase_summary", "phase_done")), F.lit(False)).alias("completed"),
    )
