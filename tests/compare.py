"""Order-insensitive comparison of a Spark result with its SQL twin."""

from __future__ import annotations

import datetime
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, datetime.datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(_cell(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(cells, key=repr)


KINDS = {
    "int": "int", "bigint": "bigint", "double": "double", "string": "text", "date": "date", "boolean": "boolean",
    "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "text", "DATE": "date", "BOOLEAN": "boolean",
}


def compare(df, connection, sql: str) -> list[str]:
    """Differences in names, types, row count and values; empty when equal."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: KINDS.get(str(d[1]), str(d[1])) for d in result.description}
    expected = table(names, result.fetchall())
    actual = table(df.columns, [tuple(r) for r in df.collect()])
    problems = []
    if expected[0] != actual[0]:
        return [f"columns {actual[0]} != {expected[0]}"]
    spark_types = {n: KINDS.get(t, t) for n, t in df.dtypes}
    if spark_types != types:
        problems.append(f"types { {n: (spark_types[n], types[n]) for n in types if types[n] != spark_types[n]} }")
    if len(expected[1]) != len(actual[1]):
        problems.append(f"rows {len(actual[1])} != {len(expected[1])}")
    wrong = [(a, e) for a, e in zip(actual[1], expected[1]) if a != e]
    if wrong:
        problems.append(f"{len(wrong)} rows differ, first: {wrong[0]}")
    if not actual[1]:
        problems.append("no rows at all")
    return problems
