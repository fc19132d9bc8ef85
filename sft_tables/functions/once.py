"""Evaluate columns once per row.

Filters are pushed through projections, and each reference to a derived column then repeats its expression
(a JSON parse per rule, for example). A one-element ``inline`` keeps the result as a value: predicates over
the other columns still move below it to the scan, predicates over these columns stay above.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, **columns: Column) -> DataFrame:
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
