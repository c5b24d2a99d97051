"""Run registered queries next to their SQL: ``python tests/compare.py <sf_dir> [query ...]``."""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{directory}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, Decimal):
        return f"decimal {value}"
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, con, query, sql: str, directory: str) -> str | None:
    """None when both sides hold the same rows, else what differs."""
    df = query(spark, directory)
    ours = rows_of(df.columns, df.collect())
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    theirs = rows_of(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


if __name__ == "__main__":
    import __spark_entry__ as contract
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    folder, chosen = sys.argv[1], sys.argv[2:]
    sql_by_name, con = contract.oracle_sql(), duck(folder)
    for name, query in contract.queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            verdict = compare(session, con, query, sql_by_name[name], folder) or "same"
        except Exception as problem:
            verdict = f"ERROR {str(problem)[:600]}"
        print(f"{name:32s} {time.time() - start:6.2f}s  {verdict}", flush=True)
