"""Removing secrets from text, nested columns and JSON text, and finding literal secrets."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sft_tables.functions.text import squeeze, strip

# The mark, the accepted reference form, sensitive key names and suffixes, text patterns.
REDACTED = "<redacted>"
REFERENCE = r"\A\$\{[A-Za-z_][A-Za-z0-9_]*\}\z"
SENSITIVE_NAMES = (
    "api_key", "apikey", "token", "access_token", "auth_token", "refresh_token", "id_token", "hf_token",
    "bearer_token", "secret", "secret_key", "client_secret", "master_key", "password", "passwd", "authorization",
    "credential", "credentials", "private_key",
)
SENSITIVE_SUFFIXES = (
    "_api_key", "_access_token", "_auth_token", "_refresh_token", "_id_token", "_bearer_token", "_secret",
    "_secret_key", "_password", "_credential", "_credentials", "_private_key",
)
BEARER = r"(?iU)(authorization[\s\x1c-\x1f]*[:=][\s\x1c-\x1f]*bearer[\s\x1c-\x1f]+)[^\s\x1c-\x1f,;]+"
ASSIGNED = (
    r"(?iU)((?:api[_-]?key|token|secret|password)[\s\x1c-\x1f]*[:=][\s\x1c-\x1f]*)['\"]?[^\s\x1c-\x1f,'\";}]+"
)
ERROR_LIMIT = 240


def redact_text(text: Column, secrets: Sequence[str] = ()) -> Column:
    """Known secrets (longest first, as literal text), then bearer headers, then ``token=...`` shapes."""
    for secret in sorted((s for s in secrets if s), key=len, reverse=True):
        text = F.replace(text, F.lit(secret), F.lit(REDACTED))
    return F.regexp_replace(F.regexp_replace(text, BEARER, f"$1{REDACTED}"), ASSIGNED, f"$1{REDACTED}")


def redact_columns(df: DataFrame, columns: Sequence[str], secrets: Sequence[str] = ()) -> DataFrame:
    return df.withColumns({c: redact_text(F.col(c), secrets) for c in columns})


def redacted_error(kind: Column, message: Column, secrets: Sequence[str] = ()) -> Column:
    """Struct (type, message): redacted, whitespace squeezed, at most 240 characters, never empty."""
    short = F.substring(squeeze(redact_text(message, secrets)), 1, ERROR_LIMIT)
    return F.struct(kind.alias("type"), F.when(short != "", short).otherwise(kind).alias("message"))


def _either(names: Sequence[str]) -> str:
    """Any of the names, where any run of other characters may stand for an underscore."""
    return "|".join(n.replace("_", "[^a-z0-9]+") for n in names)


#: One pattern for whole lower-cased keys, in the schema and in the data. Marks around a key do not count.
SENSITIVE_KEY = f"(?s)[^a-z0-9]*(?:{_either(SENSITIVE_NAMES)}|.*(?:{_either(SENSITIVE_SUFFIXES)}))[^a-z0-9]*"


def is_sensitive_key(key: str) -> bool:
    """For keys that are known when the plan is made."""
    return re.fullmatch(SENSITIVE_KEY, key.lower()) is not None


def sensitive_key(key: Column) -> Column:
    """For keys that are data (map keys)."""
    return F.lower(key).rlike(rf"\A(?:{SENSITIVE_KEY})\z")


def _is_reference(value: Column) -> Column:
    return F.coalesce(strip(value).rlike(REFERENCE), F.lit(False))


def _hidden(value: Column, kind: T.DataType) -> Column:
    if not isinstance(kind, T.StringType):
        return F.lit(REDACTED)
    return F.when(_is_reference(value), value).otherwise(REDACTED)


def _redacted(value: Column, kind: T.DataType) -> Column:
    """Rebuild a value of a nested type; the schema walk happens once, when the plan is made."""
    if isinstance(kind, T.StructType):
        return F.when(value.isNotNull(), F.struct(*[
            (_hidden(value[f.name], f.dataType) if is_sensitive_key(f.name) else _redacted(value[f.name], f.dataType)).alias(f.name)
            for f in kind.fields
        ]))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _redacted(x, kind.elementType))
    if isinstance(kind, T.MapType):
        if isinstance(kind.valueType, (T.StringType, T.VariantType)):
            return F.transform_values(value, lambda k, x: F.when(sensitive_key(k), _mark(x, kind.valueType)).otherwise(_redacted(x, kind.valueType)))
        # only a variant can hold both the mark and what the other keys have
        return F.transform_values(value, lambda k, x: F.when(sensitive_key(k), _variant(F.lit(REDACTED), T.StringType())).otherwise(
            _variant(_redacted(x, kind.valueType), kind.valueType)))
    if isinstance(kind, T.VariantType):
        return F.try_parse_json(redact_json(F.to_json(value)))
    return value


def _variant(value: Column, kind: T.DataType) -> Column:
    nested = isinstance(kind, (T.StructType, T.ArrayType, T.MapType))
    return F.to_variant_object(value) if nested else value.cast("variant")


def _mark(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.VariantType):
        text = F.try_variant_get(value, "$", "string")
        return F.when(_is_reference(text), value).otherwise(F.lit(REDACTED).cast("variant"))
    return _hidden(value, kind)


def redact_data(df: DataFrame) -> DataFrame:
    """Values under sensitive keys become the mark, unless they are exactly an ``${NAME}`` reference.

    A map with string values keeps its type. Other maps come back with variant values, which can hold the mark beside
    whatever the other keys have. Variant columns are redacted through their JSON text.
    """
    row = T.StructType(df.schema.fields)
    return df.select(*[
        (_hidden(F.col(f"`{f.name}`"), f.dataType) if is_sensitive_key(f.name) else _redacted(F.col(f"`{f.name}`"), f.dataType))
        .alias(f.name) for f in row.fields
    ])


def _object(pairs: list[tuple[str, object]]) -> dict:
    """An object of a JSON text, as the parser closes it: inner objects come first, so no descent is needed."""
    reference = re.compile(REFERENCE.replace(r"\z", r"\Z"))
    return {
        k: v if not is_sensitive_key(k) or isinstance(v, str) and reference.search(v.strip()) else REDACTED for k, v in pairs
    }


@F.pandas_udf(T.StringType())
def redact_json(text: pd.Series) -> pd.Series:
    """JSON text of unknown nesting; text that is no JSON becomes NULL rather than passing unchecked."""
    def one(item):
        try:
            return json.dumps(json.loads(item, object_pairs_hook=_object), ensure_ascii=False, separators=(",", ":"))
        except (TypeError, ValueError):
            return None

    return text.map(one)


NONE_FOUND = "array<string>"


def _is_literal(value: Column, kind: T.DataType) -> Column:
    return value.isNotNull() & ~_is_reference(value) if isinstance(kind, T.StringType) else value.isNotNull()


def _literals(value: Column, kind: T.DataType, path: Column) -> Column | None:
    """Paths of literals under sensitive keys below a value; nothing where the type has no keys."""
    none = F.array().cast(NONE_FOUND)
    if isinstance(kind, T.VariantType):
        raise ValueError("the keys of a variant are not known when the plan is made: give it a type first")
    if isinstance(kind, T.StructType):
        parts = []
        for f in kind.fields:
            below = F.concat(path, F.lit(f".{f.name}"))
            if is_sensitive_key(f.name):
                parts.append(F.when(_is_literal(value[f.name], f.dataType), F.array(below)).otherwise(none))
            elif (deeper := _literals(value[f.name], f.dataType, below)) is not None:
                parts.append(deeper)
        return F.coalesce(F.concat(*parts), none) if parts else None
    if isinstance(kind, T.ArrayType):
        if _literals(value[0], kind.elementType, path) is None:
            return None
        each = F.transform(value, lambda x, i: _literals(x, kind.elementType, F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))))
        return F.coalesce(F.flatten(each), none)
    if isinstance(kind, T.MapType):
        def entry(e: Column) -> Column:
            below = F.concat(path, F.lit("."), e["key"].cast("string"))
            deeper = _literals(e["value"], kind.valueType, below)
            return F.when(sensitive_key(e["key"].cast("string")), F.when(_is_literal(e["value"], kind.valueType), F.array(below)).otherwise(none)).otherwise(
                none if deeper is None else deeper)

        return F.coalesce(F.flatten(F.transform(F.map_entries(value), entry)), none)
    return None


def literal_secret_audit(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key paths that hold a literal value under a sensitive key: (keys..., path), at any depth of structs, lists (with
    the position) and maps of any value. Values are not shown."""
    row = T.StructType([f for f in df.schema.fields if f.name not in keys])
    found = _literals(F.struct(*[F.col(f"`{f.name}`") for f in row.fields]), row, F.lit("")) if row.fields else None
    paths = F.array().cast(NONE_FOUND) if found is None else found
    return df.select(*keys, F.explode(paths).alias("_path")).select(*keys, F.substr("_path", F.lit(2)).alias("path"))
