"""Raw rows, the row model, and the accessor the rules are written against."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sft_tables.functions.errors import first_error
from sft_tables.functions.once import once
from sft_tables.operators.formats import SAMPLE_ROWS


def json_value(raw: Column) -> Column:
    """The variant of a text that is one JSON value and nothing more; NULL otherwise. NaN and Infinity are numbers.

    The parser ignores what follows a value, so the text is read as the only element of a list.
    """
    listed = F.concat(F.lit("["), raw, F.lit("]"))
    elements = F.try_variant_get(F.coalesce(F.try_parse_json(listed), F.from_json(listed, "variant")), "$", "array<variant>")
    # a list of one, so that the parse stands in the plan once
    return F.transform(F.array(elements), lambda e: F.when(F.size(e) == 1, e[0]))[0]


def to_row_model(raw_rows: DataFrame) -> DataFrame:
    """(dataset_id, row_index, raw) plus the parsed variant ``v``, ``kind`` and ``keys``. One JSON parse per row;
    ``keys`` lists them in file order and costs a second pass only where it is read."""
    mark = F.substring("raw", 1, 1)
    mark = F.when(mark.isin(*[c for c in '{["tfn-0123456789']), mark).otherwise(
        F.regexp_extract("raw", r"\A\s*(\S)", 1))
    kind = (
        F.when(F.col("v").isNull(), "corrupt").when(mark == "{", "object").when(mark == "[", "array")
        .when(mark == '"', "string").when(mark.isin("t", "f"), "boolean").when(mark == "n", "null")
        .otherwise("number")
    )
    # keys in file order; a text with NaN or Infinity, which that parser refuses, has them in alphabetical order
    keys = F.when(F.col("kind") == "object", F.array_distinct(F.coalesce(
        F.json_object_keys("raw"), F.expr("map_keys(try_variant_get(v, '$', 'map<string,variant>'))"))))
    return once(raw_rows, v=json_value(F.col("raw"))).withColumn("kind", kind).withColumn("keys", keys)


class JsonRow:
    """Access to fields of a variant: key presence and JSON type, not just a cast value."""

    def __init__(self, v: str = "v", kind: str = "kind"):
        self.v, self.kind = v, kind

    @property
    def is_object(self) -> Column:
        return F.expr(f"{self.kind} = 'object'")

    def _get(self, name: str, kind: str) -> str:
        return f"try_variant_get({self.v}, '$.{name}', '{kind}')"

    def _is_string(self, name: str) -> str:
        return f"coalesce(schema_of_variant({self._get(name, 'variant')}) = 'STRING', false)"

    def present(self, name: str) -> Column:
        """An explicit JSON null is a variant value, so only an absent key is NULL here."""
        return F.expr(f"{self._get(name, 'variant')} IS NOT NULL")

    def variant(self, name: str) -> Column:
        return F.expr(self._get(name, "variant"))

    def is_string(self, name: str) -> Column:
        return F.expr(self._is_string(name))

    def text(self, name: str) -> Column:
        """The value when it is a string, else NULL."""
        return F.expr(f"CASE WHEN {self._is_string(name)} THEN {self._get(name, 'string')} END")

    def items(self, name: str) -> Column:
        """The value as array of variants, NULL when it is not a list."""
        return F.expr(self._get(name, "array<variant>"))

    def whole_text(self) -> Column:
        return F.expr(f"CASE WHEN {self.kind} = 'string' THEN try_variant_get({self.v}, '$', 'string') END")


class ColumnRow:
    """The same access over typed columns: every column is a present key, NULL an explicit null."""

    def __init__(self, df: DataFrame):
        self.types = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    @property
    def is_object(self) -> Column:
        return F.lit(True)

    def present(self, name: str) -> Column:
        return F.lit(name in self.types)

    def is_string(self, name: str) -> Column:
        return F.col(f"`{name}`").isNotNull() if self.types.get(name) == "string" else F.lit(False)

    def text(self, name: str) -> Column:
        return F.col(f"`{name}`") if self.types.get(name) == "string" else F.lit(None).cast("string")


def columns_to_rows(df: DataFrame, fields: Sequence[str], dataset_id: Column, row_index: Column) -> DataFrame:
    """Typed columns as raw rows; NULL columns stay explicit nulls in the JSON text."""
    raw = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return df.select(dataset_id.alias("dataset_id"), row_index.alias("row_index"), raw.alias("raw"))


def sample_rows(rows: DataFrame, n: int = SAMPLE_ROWS) -> DataFrame:
    """First n rows per dataset. ``row_index`` is the 1-based position, so this is a plain filter:
    no sort, no shuffle, and it reaches the scan when the source is columnar."""
    return rows.filter(F.col("row_index") <= n)


def first_rows(rows: DataFrame, order: str, n: int = SAMPLE_ROWS, key: str = "dataset_id") -> DataFrame:
    """First n rows per dataset when positions have gaps; the rank limit is applied before the shuffle."""
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy(key).orderBy(order))
    return rows.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def detected_fields(sample: DataFrame) -> DataFrame:
    """Sorted union of object keys per dataset (input: the bounded sample)."""
    return (
        sample.select("dataset_id", F.explode("keys").alias("key"))
        .groupBy("dataset_id").agg(F.array_sort(F.collect_set("key")).alias("fields"))
    )


def _checked_mapping(mapping: dict[str, str]) -> dict[str, str]:
    if not mapping or any(not isinstance(x, str) or not x.strip() for kv in mapping.items() for x in kv):
        raise ValueError("column mapping must be non-empty, with non-empty names")
    return mapping


def map_columns(rows: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Copy source fields to target fields of each JSON row, all from the original row; sources stay.

    Rows that are no object or lack a source keep their raw text and get ``map_error``.
    """
    row = JsonRow()
    mapping = _checked_mapping(mapping)
    error = first_error([
        ("MAP_NOT_OBJECT", ~row.is_object),
        *[("MAP_MISSING_SOURCE", ~row.present(source)) for source in mapping.values()],
    ])
    entries = F.try_variant_get(F.col("v"), "$", "map<string,variant>")
    kept = F.map_filter(entries, lambda k, _: ~k.isin(list(mapping)))
    copied = F.map_from_arrays(
        F.array(*[F.lit(t) for t in mapping]),
        F.array(*[row.variant(s) for s in mapping.values()]),
    )
    mapped = F.to_json(F.map_concat(kept, copied))
    out = rows.withColumn("map_error", error)
    copied_raw = F.when(F.col("map_error").isNull(), mapped).otherwise(F.col("raw"))
    return to_row_model(once(out.drop("keys"), raw=copied_raw).drop("v", "kind"))


def map_table_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """The same for typed columns: one select over the original columns."""
    missing = [s for s in _checked_mapping(mapping).values() if s not in df.columns]
    if missing:
        raise ValueError(f"mapped source columns are missing: {missing}")
    return df.select(
        *[F.col(c) for c in df.columns if c not in mapping],
        *[F.col(source).alias(target) for target, source in mapping.items()],
    )
