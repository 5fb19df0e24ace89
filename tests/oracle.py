"""Run a query and its SQL side by side and compare rows and column types."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

FAMILIES = {
    "bigint": "int", "int": "int", "string": "text", "double": "double", "boolean": "bool",
    "timestamp_ntz": "time", "date": "date",
    "BIGINT": "int", "INTEGER": "int", "HUGEINT": "int", "VARCHAR": "text", "JSON": "text",
    "DOUBLE": "double", "BOOLEAN": "bool", "TIMESTAMP": "time", "DATE": "date",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def compare(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if equal, else what differs."""
    result = con.execute(sql)
    sql_types = {d[0]: FAMILIES[str(d[1])] for d in result.description}
    types = {f.name: FAMILIES[f.dataType.simpleString()] for f in spark_df.schema.fields}
    if types != sql_types:
        return f"columns {types} against {sql_types}"
    names = sorted(types)
    order = [list(sql_types).index(n) for n in names]
    expected = Counter(tuple(_cell(row[i]) for i in order) for row in result.fetchall())
    actual = Counter(tuple(_cell(row[n]) for n in names) for row in spark_df.collect())
    if actual == expected:
        return None
    extra, missing = actual - expected, expected - actual
    return (
        f"{sum(actual.values())} rows against {sum(expected.values())}; "
        f"{sum(extra.values())} extra, such as {next(iter(extra), None)}; "
        f"{sum(missing.values())} missing, such as {next(iter(missing), None)}"
    )
