"""All registered queries and their SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

MODULES = (
    "chat_queries", "dataset_queries", "log_queries", "planning_queries", "run_queries", "io_queries",
)


def _merged(attribute: str) -> dict:
    merged: dict = {}
    for name in MODULES:
        part = getattr(importlib.import_module(f"sft_tables.plans.{name}"), attribute)
        clash = merged.keys() & part.keys()
        if clash:
            raise ValueError(f"registered twice: {sorted(clash)}")
        merged.update(part)
    return merged


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _merged("QUERIES")


def oracles() -> dict[str, str]:
    return _merged("ORACLES")
