"""Compare registered queries with their SQL: `python -m acceptance.check [sf_dir] [name ...]`."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from acceptance import CASES
from solvind.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        if Path(f"{sf_dir}/{table}.parquet").exists():
            connection.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return connection


SQL_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def _ordered(rows: list[tuple], names: list[str]) -> list[tuple]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def difference(spark: SparkSession, connection: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> str | None:
    """None when column names, types, rows and values agree; otherwise what differs first."""
    case = CASES[name]
    frame = case.run(spark, sf_dir)
    actual = _ordered([tuple(row) for row in frame.collect()], frame.columns)
    if not actual:
        return "no rows"
    if case.sql is None:
        return None
    relation = connection.sql(case.sql)
    found = {column: SQL_TYPES.get(dtype, dtype) for column, dtype in frame.dtypes}
    wanted = dict(zip(relation.columns, map(str, relation.types)))
    if found != wanted:
        return f"columns {sorted(found.items())} != {sorted(wanted.items())}"
    expected = _ordered(relation.fetchall(), relation.columns)
    if len(actual) != len(expected):
        return f"{len(actual)} rows != {len(expected)}"
    unequal = [(left, right) for left, right in zip(actual, expected) if left != right]
    return f"{len(unequal)} rows differ, first {unequal[0][0]} != {unequal[0][1]}" if unequal else None


def main(arguments: list[str]) -> int:
    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    names = arguments[1:] or list(CASES)
    spark = build_session(
        "acceptance", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8"
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(sf_dir)
    failed = 0
    for name in names:
        start = time.perf_counter()
        try:
            found = difference(spark, connection, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:600]}"
        failed += found is not None
        kind = "sql " if CASES[name].sql else "rows"
        print(f"{'FAIL' if found else 'ok  '} {kind} {time.perf_counter() - start:6.2f}s {name} {found or ''}", flush=True)
    print(f"{len(names) - failed}/{len(names)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
