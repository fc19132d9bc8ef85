"""Checks on paths of a variant column ``v``: JSON types, not casts (a boolean is no integer, '5' no number)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _kind(path: str) -> str:
    return f"schema_of_variant(try_variant_get(v, '{path}', 'variant'))"


def _is_int(path: str) -> str:
    """Integers are BIGINT, or decimals beyond 64 bits; a shorter decimal was written with a point."""
    return f"({_kind(path)} = 'BIGINT' OR {_kind(path)} RLIKE '^DECIMAL[(](19|[23][0-9]),0[)]$')"


def _is_number(path: str) -> str:
    return f"({_kind(path)} IN ('BIGINT', 'DOUBLE', 'FLOAT') OR {_kind(path)} LIKE 'DECIMAL%')"


def _known(condition: str) -> Column:
    return F.expr(f"coalesce({condition}, false)")


def text_at(path: str) -> str:
    """SQL of the value when it is a string."""
    return f"(CASE WHEN {_kind(path)} = 'STRING' THEN try_variant_get(v, '{path}', 'string') END)"


def present(path: str) -> Column:
    return F.expr(f"try_variant_get(v, '{path}', 'variant') IS NOT NULL")


def is_null(path: str) -> Column:
    """Missing or an explicit JSON null."""
    return F.expr(f"coalesce({_kind(path)}, 'VOID') = 'VOID'")


def is_text(path: str) -> Column:
    """A string with something other than whitespace in it."""
    return _known(f"{text_at(path)} RLIKE '(?U)[^\\\\s\\\\x1c-\\\\x1f]'")


def matches(path: str, pattern: str) -> Column:
    """The stripped string value matches an ASCII pattern (given without anchors)."""
    escaped = pattern.replace("\\", "\\\\")
    stripped = f"regexp_replace({text_at(path)}, '(?U)\\\\A[\\\\s\\\\x1c-\\\\x1f]+|[\\\\s\\\\x1c-\\\\x1f]+\\\\z', '')"
    return _known(f"{stripped} RLIKE '\\\\A(?:{escaped})\\\\z'")


def in_set(path: str, choices: Sequence[str]) -> Column:
    """The stripped, lower-cased string value is one of the choices."""
    return matches(path, "(?i:" + "|".join(choices) + ")")


def is_bool(path: str) -> Column:
    return _known(f"{_kind(path)} = 'BOOLEAN'")


def is_positive_int(path: str) -> Column:
    return _known(f"{_is_int(path)} AND try_variant_get(v, '{path}', 'decimal(38,0)') > 0")


def is_positive_number(path: str) -> Column:
    value = f"try_variant_get(v, '{path}', 'double')"
    return _known(f"{_is_number(path)} AND {value} > 0 AND {value} < CAST('Infinity' AS DOUBLE)")


def is_number_from_zero_below_one(path: str) -> Column:
    value = f"try_variant_get(v, '{path}', 'double')"
    return _known(f"{_is_number(path)} AND {value} >= 0 AND {value} < 1")


def mapping(path: str) -> Column:
    return F.expr(f"try_variant_get(v, '{path}', 'map<string,variant>')")


def unknown_keys(path: str, allowed: Sequence[str]) -> Column:
    names = ", ".join(f"'{a}'" for a in allowed)
    return F.expr(f"size(array_except(map_keys(try_variant_get(v, '{path}', 'map<string,variant>')), array({names}))) > 0")


def missing_keys(path: str, required: Sequence[str]) -> Column:
    names = ", ".join(f"'{a}'" for a in required)
    return F.expr(f"size(array_except(array({names}), map_keys(try_variant_get(v, '{path}', 'map<string,variant>')))) > 0")
