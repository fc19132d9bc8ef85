"""Validation and conversion of raw rows of any format into SFT rows, one projection per scan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sft_tables.functions.errors import FAULT, TableCheckError, fault, first_fault, raise_first
from sft_tables.functions.once import once
from sft_tables.functions.text import is_blank, strip
from sft_tables.operators import chat
from sft_tables.operators.detect import detect_dataset_format, select_format
from sft_tables.operators.formats import DPO, FIELD_FORMATS, QA_PAIRS, FieldFormat, known_formats, lookup_column
from sft_tables.operators.rows import ColumnRow, JsonRow
from sft_tables.session import written

Row = JsonRow | ColumnRow
SFT = "array<struct<turn:bigint,instruction:string,input:string,output:string>>"
SFT_FIELDS = ("instruction", "input", "output")
CHAT_FORMATS = ("openai_chat", "sharegpt", "chatml")
FORMAT_TASK = {f.name: f.task for f in FIELD_FORMATS} | {n: "sft" for n in ("qa_json", *CHAT_FORMATS)}


def _filled(row: Row, name: str) -> Column:
    return row.is_string(name) & ~is_blank(row.text(name))


def field_fault(row: Row, fmt: FieldFormat) -> Column:
    """Object? required keys? required values filled strings? mapped optional values strings?"""
    missing = F.filter(F.array(*[F.when(~row.present(f), F.lit(f)) for f in fmt.required]), lambda x: x.isNotNull())
    rules = [
        (~row.is_object, fault("NOT_OBJECT")),
        (F.size(missing) > 0, fault("MISSING_FIELDS", F.array_join(missing, ","))),
    ]
    rules += [(~F.coalesce(_filled(row, f), F.lit(False)), fault("BLANK_OR_NOT_STRING", f)) for f in fmt.required]
    rules += [(row.present(f) & ~row.is_string(f), fault("OPTIONAL_NOT_STRING", f)) for f in fmt.output.values()]
    return first_fault(rules)


def field_projection(row: Row, fmt: FieldFormat) -> list[Column]:
    """Target columns; a default applies only where the key is absent."""
    def target(name: str, source: str) -> Column:
        default = F.lit(fmt.defaults.get(name)).cast("string")
        return F.when(row.present(source), row.text(source)).otherwise(default).alias(name)

    return [target(name, source) for name, source in fmt.output.items()]


def _qa_has(row: Row, pair: tuple[str, str]) -> Column:
    return row.present(pair[0]) & row.present(pair[1])


def qa_fault(row: Row) -> Column:
    first, second = QA_PAIRS
    rules = [
        (~row.is_object, fault("NOT_OBJECT")),
        (~_qa_has(row, first) & ~_qa_has(row, second), fault("QA_NO_PAIR")),
    ]
    for pair, applies in ((first, _qa_has(row, first)), (second, ~_qa_has(row, first))):
        rules += [(applies & ~F.coalesce(_filled(row, f), F.lit(False)), fault("BLANK_OR_NOT_STRING", f)) for f in pair]
    rules.append((row.present("context") & ~row.is_string("context"), fault("CONTEXT_NOT_STRING", "context")))
    return first_fault(rules)


def qa_projection(row: Row) -> list[Column]:
    (q1, a1), (q2, a2) = QA_PAIRS
    first = _qa_has(row, QA_PAIRS[0])
    return [
        F.when(first, row.text(q1)).otherwise(row.text(q2)).alias("instruction"),
        F.when(row.present("context"), row.text("context")).otherwise("").alias("input"),
        F.when(first, row.text(a1)).otherwise(row.text(a2)).alias("output"),
    ]


def chatml_text(row: JsonRow) -> Column:
    return F.coalesce(row.whole_text(), row.text("text"))


def chat_messages(row: JsonRow, name: str) -> Column:
    return {
        "openai_chat": lambda: chat.openai_messages(), "sharegpt": lambda: chat.sharegpt_messages(),
        "chatml": lambda: chat.parse_chatml(chatml_text(row)),
    }[name]()


def structure_fault(row: JsonRow, name: str) -> Column:
    return first_fault({
        "openai_chat": lambda: chat.openai_structure_faults(row),
        "sharegpt": lambda: chat.sharegpt_structure_faults(row),
        "chatml": lambda: chat.chatml_structure_faults(chatml_text(row)),
    }[name]())


def chat_fault(row: JsonRow, name: str, messages: Column) -> Column:
    return F.coalesce(structure_fault(row, name), chat.message_fault(messages))


def validate_fields(rows: DataFrame, fmt: FieldFormat) -> DataFrame:
    """Violations (dataset_id, row_index, code, detail) of rows held to one field format."""
    return (
        rows.select("dataset_id", "row_index", field_fault(JsonRow(), fmt).alias("f")).filter("f is not null")
        .select("dataset_id", "row_index", "f.code", "f.detail")
    )


def convert_fields(rows: DataFrame, fmt: FieldFormat) -> DataFrame:
    """Clean rows of one field format in its target columns."""
    row = JsonRow()
    return rows.filter(field_fault(row, fmt).isNull()).select("dataset_id", "row_index", *field_projection(row, fmt))


def convert_columns(df: DataFrame, fmt: FieldFormat, keys: list[str]) -> DataFrame:
    """The same over typed columns: plain column expressions, pruned and pushed down by the scan."""
    row = ColumnRow(df)
    return df.filter(field_fault(row, fmt).isNull()).select(*keys, *field_projection(row, fmt))


def convert_qa(rows: DataFrame) -> DataFrame:
    row = JsonRow()
    return rows.filter(qa_fault(row).isNull()).select("dataset_id", "row_index", *qa_projection(row))


def extract_messages(rows: DataFrame, name: str) -> DataFrame:
    """(dataset_id, row_index, messages) of chat rows; NULL messages where the structure is wrong."""
    return rows.select("dataset_id", "row_index", chat_messages(JsonRow(), name).alias("messages"))


def convert_chat(rows: DataFrame, name: str) -> DataFrame:
    row = JsonRow()
    held = once(rows, messages=chat_messages(row, name))
    clean = held.filter(chat_fault(row, name, F.col("messages")).isNull())
    return clean.select(
        "dataset_id", "row_index", F.explode_outer(chat.sft_of_messages()).alias("r")
    ).select("dataset_id", "row_index", "r.*")


def _tasks(extra: Sequence[FieldFormat]) -> dict[str, str]:
    return FORMAT_TASK | {f.name: f.task for f in extra}


def task_gate(selection: DataFrame, require: str = "sft", extra: Sequence[FieldFormat] = ()) -> DataFrame:
    """Datasets whose format serves another task than required."""
    task = lookup_column(F.col("format"), _tasks(extra))
    return selection.withColumn("task", task).filter(F.col("task") != require).select(
        "dataset_id", "format", "task", F.lit("TASK_UNSUPPORTED").alias("code"))


def require_non_empty(rows: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected datasets without any row."""
    present = rows.select("dataset_id").distinct()
    return expected.select("dataset_id").distinct().join(present, "dataset_id", "left_anti").withColumn(
        "code", F.lit("EMPTY_DATASET"))


def validate_unified(sft: DataFrame, keys: list[str]) -> DataFrame:
    """Final check of an SFT table: exactly the three fields, two of them filled, all strings."""
    if set(sft.columns) - set(keys) != set(SFT_FIELDS):
        return sft.select(*keys, F.lit("UNIFIED_FIELDS").alias("code"))
    types = dict(sft.dtypes)
    if any(types[f] != "string" for f in SFT_FIELDS):
        return sft.select(*keys, F.lit("UNIFIED_BLANK" if types["instruction"] != "string" or types["output"] != "string"
                                       else "UNIFIED_INPUT").alias("code"))
    blank = lambda f: F.coalesce(is_blank(f), F.lit(True))
    code = F.when(blank("instruction") | blank("output"), "UNIFIED_BLANK").when(F.col("input").isNull(), "UNIFIED_INPUT")
    return sft.select(*keys, code.alias("code")).filter("code is not null")


@dataclass
class Conversion:
    """Result of a conversion: every part is a lazy table over the same checked rows."""

    selection: DataFrame
    checked: DataFrame
    require: str | None
    extra: Sequence[FieldFormat] = ()

    @property
    def rows(self) -> DataFrame:
        return (
            self.checked.filter("fault IS NULL AND NOT gated")
            .select("dataset_id", "row_index", F.explode_outer("sft").alias("r"))
            .select("dataset_id", "row_index", "r.turn", "r.instruction", "r.input", "r.output")
        )

    @property
    def preference(self) -> DataFrame:
        return self.checked.filter("fault IS NULL AND preference IS NOT NULL").select("dataset_id", "row_index", "preference.*")

    @property
    def row_violations(self) -> DataFrame:
        return self.checked.filter("fault IS NOT NULL").select(
            "dataset_id", "row_index", "fault.turn", "fault.code", "fault.detail")

    @property
    def dataset_violations(self) -> DataFrame:
        refused = self.selection.filter("code IS NOT NULL").select("dataset_id", "code")
        if self.require:
            refused = refused.unionByName(task_gate(self.selection.filter("code IS NULL"), self.require, self.extra).select("dataset_id", "code"))
        return refused

    @property
    def violations(self) -> DataFrame:
        return self.dataset_violations.select(
            "dataset_id", F.lit(None).cast("bigint").alias("row_index"), F.lit(None).cast("bigint").alias("turn"),
            "code", F.lit(None).cast("string").alias("detail"),
        ).unionByName(self.row_violations)

    def strict(self) -> DataFrame:
        """The rows, or the first error: choice of format, then rows in order, then the task."""
        raise_first(self.selection.filter("code IS NOT NULL"), ["dataset_id"])
        raise_first(self.row_violations, ["row_index", "turn", "dataset_id"])
        raise_first(self.dataset_violations, ["dataset_id"])
        return self.rows


def convert_dataset(rows: DataFrame, requests: DataFrame | None = None, require: str | None = "sft",
                    extra: Sequence[FieldFormat] = ()) -> Conversion:
    """Detect or take the format of every dataset, then check and convert all rows in one projection. ``extra`` adds
    field formats of the caller to the known ones.

    Detection reads 25 rows per dataset and its choice (one row per dataset) is written down, so the planner knows its
    size when rows are joined with it: small choices are broadcast and raw text is not moved; beyond the broadcast limit
    adaptive execution splits a dataset with most of the rows.
    """
    chosen = select_format(detect_dataset_format(rows, extra=extra), requests, extra=extra)
    return convert_with(rows, written(chosen, "formats"), require, extra)


def convert_with(rows: DataFrame, selection: DataFrame, require: str | None = "sft", extra: Sequence[FieldFormat] = ()) -> Conversion:
    """Check and convert rows of datasets whose format is already chosen.

    Every input row is accounted for: it is converted, a row violation, or belongs to a dataset that ``selection`` refuses.
    Rows of datasets without a choice, and rows without a dataset, are violations (NO_FORMAT).
    """
    field_formats = known_formats(extra)
    selection = selection.filter("dataset_id IS NOT NULL")
    chosen = selection.select("dataset_id", "format", F.col("code").isNotNull().alias("_refused"))
    row = JsonRow()
    fmt = F.col("format")
    joined = rows.join(chosen, "dataset_id", "left").filter("NOT coalesce(_refused, false)").drop("_refused")

    messages = F.when(fmt == "openai_chat", chat_messages(row, "openai_chat")).when(
        fmt == "sharegpt", chat_messages(row, "sharegpt")).when(fmt == "chatml", chat_messages(row, "chatml"))
    held = once(joined, messages=messages)

    problem = F.when(fmt.isNull(), fault("NO_FORMAT")).when(fmt == "qa_json", qa_fault(row))
    for f in field_formats:
        problem = problem.when(fmt == f.name, field_fault(row, f))
    structure = F.when(fmt == CHAT_FORMATS[0], structure_fault(row, CHAT_FORMATS[0]))
    for name in CHAT_FORMATS[1:]:
        structure = structure.when(fmt == name, structure_fault(row, name))
    problem = problem.otherwise(F.coalesce(structure, chat.message_fault(F.col("messages"))))

    def single(columns: list[Column]) -> Column:
        return F.array(F.struct(F.lit(None).cast("bigint").alias("turn"), *columns)).cast(SFT)

    sft = F.when(fmt == "qa_json", single(qa_projection(row)))
    for f in field_formats:
        if f.task == "sft":
            sft = sft.when(fmt == f.name, single(field_projection(row, f)))
    sft = sft.when(fmt.isin(*CHAT_FORMATS), chat.sft_of_messages().cast(SFT))

    gated = F.coalesce(lookup_column(fmt, _tasks(extra)) != require, F.lit(False)) if require else F.lit(False)
    judged = once(held, fault=problem.cast(FAULT), gated=gated)
    checked = judged.select(
        "dataset_id", "row_index", "format", "fault", "gated", sft.alias("sft"),
        F.when(fmt == DPO.name, F.struct(*field_projection(row, DPO))).alias("preference"),
    )
    return Conversion(selection, checked, require, extra)


def train_benchmark_overlap(train: DataFrame, bench: DataFrame, text: str = "text") -> DataFrame:
    """Texts that occur on both sides. Each side is reduced to one row per digest before the join, so a
    text copied into a third of the rows costs one row."""
    def digests(df: DataFrame, n: str) -> DataFrame:
        return df.select(F.sha2(strip(text), 256).alias("digest")).groupBy("digest").agg(F.count(F.lit(1)).alias(n))

    return digests(train, "train_rows").join(digests(bench, "benchmark_rows"), "digest")


def require_disjoint_files(train: DataFrame, bench: DataFrame) -> None:
    """Refuse a benchmark file that is also a training file (tables of path, sha256)."""
    same = train.select(F.col("sha256").alias("digest")).distinct().join(
        bench.select(F.col("sha256").alias("digest")), "digest", "left_semi").first()
    if same is not None:
        raise TableCheckError("SAME_FILE", f"digest={same['digest']}")
