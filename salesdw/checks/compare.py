"""Run a query in Spark and its SQL in DuckDB and compare names, types and values."""

from __future__ import annotations

import math
from collections import Counter
from datetime import datetime
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame

GIVEN = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

_KINDS = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "decimal(10,2)": "DECIMAL(10,2)",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in GIVEN:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else float(f"{value:.10g}")
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, datetime):
        return value.date() if value.time() == datetime.min.time() else value
    return value


def differences(spark_result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str, types: bool = True) -> list[str]:
    """What differs, in words; empty when the results agree as multisets of rows."""
    relation = connection.sql(sql)
    ours = {field.name: _KINDS.get(field.dataType.simpleString(), "?") for field in spark_result.schema}
    theirs = {name: str(kind) for name, kind in zip(relation.columns, relation.types)}
    found = []
    if set(ours) != set(theirs):
        return [f"columns {sorted(ours)} against {sorted(theirs)}"]
    if types and ours != theirs:
        found.append(f"types {[(n, ours[n], theirs[n]) for n in ours if ours[n] != theirs[n]]}")
    names = sorted(ours)
    left = Counter(tuple(_plain(row[name]) for name in names) for row in spark_result.collect())
    places = [relation.columns.index(name) for name in names]
    right = Counter(tuple(_plain(row[place]) for place in places) for row in relation.fetchall())
    if left != right:
        found.append(
            f"{left.total()} rows against {right.total()}; only here {list((left - right).items())[:3]}, "
            f"only there {list((right - left).items())[:3]} in {names}"
        )
    return found
