"""Run registered queries next to their SQL in DuckDB and compare rows, columns and values."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def session(cpus: int = 8):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("sft-tables")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").config("spark.python.sql.dataFrameDebugging.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.10g}")
    if isinstance(value, (int, decimal.Decimal)):
        return float(f"{float(value):.10g}") if isinstance(value, decimal.Decimal) else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return str(value)


def arrow_kind(t) -> str:
    name = str(t).replace("large_", "")
    return "timestamp" if name.startswith("timestamp") else name


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> str | None:
    left = query(spark, sf_dir).toArrow()
    right = con.execute(sql).to_arrow_table()
    if sorted(left.column_names) != sorted(right.column_names):
        return f"columns {sorted(left.column_names)} != {sorted(right.column_names)}"
    names = sorted(left.column_names)
    kinds = [(n, arrow_kind(left.schema.field(n).type), arrow_kind(right.schema.field(n).type)) for n in names]
    differing = [k for k in kinds if k[1] != k[2]]
    rows = [sorted((tuple(plain(v) for v in r) for r in zip(*(t.column(n).to_pylist() for n in names))), key=repr)
            for t in (left, right)]
    if len(rows[0]) != len(rows[1]):
        extra = [r for r in rows[0] if r not in set(rows[1])][:2]
        lacking = [r for r in rows[1] if r not in set(rows[0])][:2]
        return f"rows {len(rows[0])} != {len(rows[1])}; extra {str(extra)[:400]} lacking {str(lacking)[:400]}"
    for a, b in zip(*rows):
        if a != b:
            return f"{names}\n   {str(a)[:500]}\n   {str(b)[:500]}"
    if differing:
        return f"types {differing}"
    if not rows[0]:
        return "both empty"
    return None


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:]
    spark, con = session(), duck(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, query in queries.items():
        if wanted and not any(w in name for w in wanted):
            continue
        started = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, name, query, oracles[name], sf_dir)
                label = "ok" if problem is None else "MISMATCH"
            else:
                problem, label = None, f"rows-only {query(spark, sf_dir).count()}"
        except Exception as error:  # noqa: BLE001
            problem, label = f"{type(error).__name__}: {str(error)[:900]}", "ERROR"
        bad += problem is not None
        print(f"{label:10s} {name} {time.time() - started:.1f}s", *( [problem] if problem else []), flush=True)
    print("queries", len(queries), "oracles", len(oracles), "bad", bad)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.path.insert(0, ".")
    sys.exit(1 if main(sys.argv[1:]) else 0)
