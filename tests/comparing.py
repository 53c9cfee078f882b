"""Compare a query with its SQL on DuckDB. Also a command: ``python -m tests.comparing <table folder> [query ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from __spark_entry__ import oracle_sql, queries
from pairwright.session import SETTINGS


def session(**conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("checks")
        .config(map=SETTINGS)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _plain(value: object) -> str:
    if value is None:
        return "~"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9e}"
    return str(value)


def _rows(columns: list[str], rows: list[tuple]) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def difference(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when columns and rows agree, otherwise what differs."""
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = _rows(names, cursor.fetchall())
    if sorted(names) != sorted(result.columns):
        return f"columns {sorted(result.columns)} and {sorted(names)}"
    found = _rows(result.columns, [tuple(r) for r in result.collect()])
    if found == expected:
        return None
    only_found, only_expected = set(found) - set(expected), set(expected) - set(found)
    return (
        f"{len(found)} rows and {len(expected)}; only in result {sorted(only_found)[:3]}, "
        f"only in SQL {sorted(only_expected)[:3]}"
    )


def main(folder: str, names: list[str]) -> int:
    spark, connection, failed = session(), duck(folder), 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        start = time.monotonic()
        sql = oracle_sql().get(name)
        if sql is None:
            outcome = f"{query(spark, folder).count()} rows"
        else:
            outcome = difference(query(spark, folder), connection, sql) or "same"
            failed += outcome != "same"
        print(f"{name:28} {time.monotonic() - start:6.1f}s  {outcome}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
