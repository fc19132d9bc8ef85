"""First-error columns and the strict-mode error."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class TableCheckError(ValueError):
    """Strict mode: the first violation of a table, in rule order."""

    def __init__(self, code: str, where: str):
        super().__init__(f"{code} at {where}")
        self.code = code


def first_error(rules: Iterable[tuple[str, Column]]) -> Column:
    """Code of the first rule whose condition holds. A NULL condition does not hold."""
    whens = [F.when(condition, F.lit(code)) for code, condition in rules]
    return F.coalesce(*whens) if len(whens) > 1 else whens[0]


FAULT = "struct<code:string,turn:bigint,detail:string>"


def fault(code: str | Column, detail: Column | str | None = None, turn: Column | None = None) -> Column:
    if isinstance(code, str) and turn is None and (detail is None or isinstance(detail, str)):
        text = "NULL" if detail is None else f"'{detail}'"
        return F.expr(f"CAST(struct('{code}' AS code, NULL AS turn, {text} AS detail) AS {FAULT})")
    as_col = lambda x: F.lit(x) if x is None or isinstance(x, str) else x
    return F.struct(
        as_col(code).cast("string").alias("code"), as_col(turn).cast("bigint").alias("turn"),
        as_col(detail).cast("string").alias("detail"),
    )


def first_fault(rules: Iterable[tuple[Column, Column]]) -> Column:
    """First (condition, fault) whose condition holds, as one CASE; NULL when the row is clean."""
    rules = list(rules)
    case = F.when(rules[0][0], rules[0][1])
    for condition, value in rules[1:]:
        case = case.when(condition, value)
    return case


def raise_first(violations: DataFrame, order: list[str]) -> None:
    """Raise for the smallest violation by ``order``; one aggregated row reaches the driver."""
    first = violations.agg(F.min(F.struct(*order, "code")).alias("v")).first()["v"]
    if first is not None:
        where = ", ".join(f"{name}={first[name]}" for name in order)
        raise TableCheckError(first["code"], where)
