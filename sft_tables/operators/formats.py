"""The known record formats and source formats, as data."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sft_tables.functions.text import format_name


@dataclass(frozen=True)
class FieldFormat:
    """A record format made of named string fields. ``output`` maps target field to source field."""

    name: str
    required: tuple[str, ...]
    output: dict[str, str]
    confidence: str
    aliases: tuple[str, ...] = ()
    defaults: dict[str, str] = field(default_factory=dict)
    task: str = "sft"
    penalty_fields: tuple[str, ...] = ()


# Names, fields, confidences, aliases and priorities of the formats.
ALPACA = FieldFormat(
    "alpaca", ("instruction", "output"),
    {"instruction": "instruction", "input": "input", "output": "output"}, "0.990", defaults={"input": ""},
)
INSTRUCTION_RESPONSE = FieldFormat(
    "instruction_response", ("instruction", "response"),
    {"instruction": "instruction", "input": "input", "output": "response"}, "0.980",
    aliases=("instruction-response",), defaults={"input": ""},
)
PROMPT_COMPLETION = FieldFormat(
    "prompt_completion", ("prompt", "completion"),
    {"instruction": "prompt", "input": "input", "output": "completion"}, "0.980",
    aliases=("prompt-completion",), defaults={"input": ""},
)
RAG_QA = FieldFormat(
    "rag_qa", ("context", "question", "answer"),
    {"instruction": "question", "input": "context", "output": "answer"}, "1.000", aliases=("context_qa",),
)
DPO = FieldFormat(
    "dpo", ("prompt", "chosen", "rejected"),
    {"prompt": "prompt", "chosen": "chosen", "rejected": "rejected"}, "1.000",
    aliases=("preference",), task="preference",
)
FIELD_FORMATS = (ALPACA, INSTRUCTION_RESPONSE, PROMPT_COMPLETION, RAG_QA, DPO)
QA_PAIRS = (("question", "answer"), ("prompt", "response"))

SCHEMA_ALIASES = {
    "alpaca": (), "instruction_response": ("instruction-response",), "prompt_completion": ("prompt-completion",),
    "qa_json": ("qa", "question_answer"), "rag_qa": ("context_qa",), "openai_chat": ("openai", "messages"),
    "sharegpt": (), "chatml": (), "dpo": ("preference",),
}
SCHEMA_PRIORITY = {
    "alpaca": 0, "instruction_response": 0, "prompt_completion": 0, "qa_json": 0, "rag_qa": 0,
    "openai_chat": 20, "sharegpt": 20, "chatml": 20, "dpo": 0,
}
SOURCE_ALIASES = {
    "json": ("json_array",), "jsonl": ("ndjson",), "csv": (), "parquet": (), "chatml_text": ("text",),
    "huggingface": ("hf", "huggingface_dataset"),
}
SOURCE_PRIORITY = {"json": 20, "jsonl": 20, "csv": 10, "parquet": 30, "chatml_text": 40, "huggingface": 0}
AMBIGUITY_MARGIN = "0.030"
SAMPLE_ROWS = 25


def known_formats(extra: Sequence[FieldFormat] = ()) -> tuple[FieldFormat, ...]:
    """The field formats with those of the caller, whose names and aliases must be new."""
    alias_table_of(extra)
    return (*FIELD_FORMATS, *extra)


def alias_table_of(extra: Sequence[FieldFormat] = ()) -> dict[str, str]:
    """Lookup of all record formats' names and aliases."""
    names = [f.name for f in extra]
    twice = {n for n in names if n in SCHEMA_ALIASES or names.count(n) > 1}
    if twice:
        raise ValueError(f"format names that are taken: {sorted(twice)}")
    return alias_lookup(SCHEMA_ALIASES | {f.name: f.aliases for f in extra})


def alias_lookup(aliases: dict[str, tuple[str, ...]]) -> dict[str, str]:
    """Normalized name or alias -> format name. A name claimed twice is refused."""
    lookup: dict[str, str] = {}
    for name, others in aliases.items():
        for key in {n.strip().lower().replace("-", "_") for n in (name, *others)}:
            if lookup.get(key, name) != name:
                raise ValueError(f"format name {key!r} is claimed by {lookup[key]!r} and {name!r}")
            lookup[key] = name
    return lookup


def lookup_column(key: Column, table: dict[str, object], kind: str = "string") -> Column:
    """Constant lookup as an expression: no join for a fixed table of a few dozen entries."""
    entries = reduce(lambda acc, kv: acc + [F.lit(kv[0]), F.lit(kv[1])], table.items(), [])
    return F.element_at(F.create_map(*entries).cast(f"map<string,{kind}>"), key)


def resolve_format(df: DataFrame, requested: str, stage: str = "schema", extra: Sequence[FieldFormat] = ()) -> DataFrame:
    """Add ``requested_key`` and ``format``: 'auto', a known name, or NULL when unknown."""
    table = alias_table_of(extra) if stage == "schema" else alias_lookup(SOURCE_ALIASES)
    key = F.coalesce(format_name(F.coalesce(F.col(requested), F.lit("auto"))), F.lit(""))
    return df.withColumn("requested_key", key).withColumn(
        "format", F.when(key == "auto", F.lit("auto")).otherwise(F.try_element_at(
            F.create_map(*[F.lit(x) for kv in sorted(table.items()) for x in kv]), key))
    )


def alias_table(spark: SparkSession, stage: str = "schema") -> DataFrame:
    table = alias_lookup(SCHEMA_ALIASES if stage == "schema" else SOURCE_ALIASES)
    return spark.createDataFrame(sorted(table.items()), "alias string, format string")
