"""Text expressions. Whitespace means Unicode white space plus the four ASCII separators 1C..1F."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\s\x1c-\x1f]"
NOT_SPACE = r"[^\s\x1c-\x1f]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nonblank(c: Column | str) -> Column:
    return _col(c).rlike(f"(?U){NOT_SPACE}")


def is_blank(c: Column | str) -> Column:
    return ~nonblank(c)


def strip(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), rf"(?U)\A{SPACE}+|{SPACE}+\z", "")


def squeeze(c: Column | str) -> Column:
    """Strip, and turn every inner run of whitespace into one space."""
    return F.regexp_replace(strip(c), rf"(?U){SPACE}+", " ")


def format_name(c: Column | str) -> Column:
    """Lookup key of a format name; NULL when the name is blank."""
    key = F.replace(F.lower(strip(c)), F.lit("-"), F.lit("_"))
    return F.when(key != "", key)


def slug(c: Column | str, fallback: str, limit: int = 48) -> Column:
    dashed = F.regexp_replace(F.lower(_col(c)), "[^a-z0-9]+", "-")
    trimmed = F.regexp_replace(dashed, r"\A-+|-+\z", "")
    return F.substring(F.coalesce(F.nullif(trimmed, F.lit("")), F.lit(fallback)), 1, limit)


def safe_identifier(c: Column | str, fallback: str, limit: int = 63) -> Column:
    """Lower-case name from letters, digits, dot, underscore and dash, with no doubled or outer marks."""
    dashed = F.regexp_replace(F.lower(_col(c)), "[^a-z0-9._-]+", "-")
    trimmed = F.regexp_replace(dashed, r"\A[-._]+|[-._]+\z", "")
    single = F.regexp_replace(trimmed, "[-._]{2,}", "-")
    cut = F.substring(F.coalesce(F.nullif(single, F.lit("")), F.lit(fallback)), 1, limit)
    tidy = F.regexp_replace(cut, r"[-._]+\z", "")
    return F.coalesce(F.nullif(tidy, F.lit("")), F.lit(fallback))


def last_path_part(c: Column | str) -> Column:
    return F.substring_index(_col(c), "/", -1)
