"""Run registered queries next to their SQL and compare the rows.

``python -m tests.compare [sf_dir] [name prefix ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for name in TABLES.split():
        connection.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _cell(value: object) -> object:
    if value is None:
        return "null"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return f"{type(value).__name__}:{value}"


def _sorted(columns: list[str], rows: list) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda at: columns[at])
    cells = [tuple(_cell(row[at]) for at in order) for row in rows]
    return [columns[at] for at in order], sorted(cells)


def difference(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when both sides hold the same columns and rows, else what differs."""
    cursor = connection.execute(sql)
    names, expected = _sorted([column[0] for column in cursor.description], cursor.fetchall())
    found_names, found = _sorted(result.columns, result.collect())
    if names != found_names:
        return f"columns {found_names}, expected {names}"
    if len(found) != len(expected):
        return f"{len(found)} rows, expected {len(expected)}"
    unlike = [pair for pair in zip(found, expected, strict=True) if pair[0] != pair[1]]
    return f"{len(unlike)} rows differ, first {unlike[0]}" if unlike else ""


def main() -> None:
    import __spark_entry__ as entry
    from reclake.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    spark: SparkSession = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracles, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            result = run(spark, sf_dir)
            problem = difference(result, connection, oracles[name]) if name in oracles else ""
            kind = "sql" if name in oracles else f"rows {result.count()}"
        except Exception as error:  # report every query
            problem, kind = f"{type(error).__name__}: {str(error)[:1500]}", "error"
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok'} {name} [{kind}] {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{bad} problems in {Path(sf_dir).name}")
    spark.stop()


if __name__ == "__main__":
    main()
