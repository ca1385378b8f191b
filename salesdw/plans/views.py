"""The text of the named views: SQL over the catalog's tables, so a view shows whatever they hold when it is asked."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesdw.plans.fact import MEASURES
from salesdw.schema import DIMENSIONS, STAGE_TABLE, TABLES, Dimension

SAMPLE_KEYS, KEYS_A_BUCKET = 1024, 16


def literal(value) -> str:
    """A key as SQL. Text goes as bytes, so that no sign in it needs care."""
    if isinstance(value, str):
        return f"CAST(X'{value.encode().hex()}' AS STRING)"
    return f"DATE '{value}'" if isinstance(value, date) else str(value)


def bucket_bounds(staged: DataFrame, spec: Dimension) -> list:
    """Some keys in order that cut the dimension's members into buckets of like size; from a bounded sample by hash."""
    key = F.col(spec.source_key).cast(TABLES[spec.table][spec.key].dataType).alias("key")
    keys = staged.select(key).where("key IS NOT NULL").distinct()
    sample = sorted(row["key"] for row in keys.orderBy(F.xxhash64("key"), "key").limit(SAMPLE_KEYS).collect())
    return sample[KEYS_A_BUCKET::KEYS_A_BUCKET]


def dimension_select(spec: Dimension, database: str, bounds: list) -> str:
    """The distinct members of the staged batch, numbered from 1 in key order (nulls first).

    A number is the member's place in its bucket plus the members of the buckets before, so no window holds all
    members. The bounds are part of the view; later batches number just as well by them, only less evenly.
    """
    kinds = TABLES[spec.table]
    fields = [(spec.source_key, spec.key), *[(name, name) for name in spec.attributes]]
    typed = ", ".join(f"CAST({source} AS {kinds[name].dataType.simpleString()}) AS {name}" for source, name in fields)
    names = ", ".join(name for _, name in fields)
    order = ", ".join(f"{name} NULLS FIRST" for _, name in fields)
    bucket = f"size(filter(array({', '.join(map(literal, bounds))}), bound -> bound <= {spec.key}))" if bounds else "0"
    number = f"coalesce(before, 0) + row_number() OVER (PARTITION BY bucket ORDER BY {order})"
    kind = kinds[spec.surrogate].dataType.simpleString()
    return (
        f"WITH members AS (SELECT DISTINCT {typed} FROM {database}.{STAGE_TABLE}), "
        f"dealt AS (SELECT *, {bucket} AS bucket FROM members), "
        "sizes AS (SELECT bucket, count(*) AS n FROM dealt GROUP BY bucket), "
        "earlier AS (SELECT bucket, sum(n) OVER (ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM sizes) "
        f"SELECT {names}, CAST({number} AS {kind}) AS {spec.surrogate} FROM dealt JOIN earlier USING (bucket)"
    )


def fact_select(database: str, null_safe: bool) -> str:
    same = "<=>" if null_safe else "="
    joins = " ".join(
        f"LEFT JOIN {database}.{spec.table} ON s.{spec.source_key} {same} {spec.table}.{spec.key}" for spec in DIMENSIONS
    )
    fields = ", ".join([*[f"s.{name}" for name in MEASURES], *[spec.surrogate for spec in DIMENSIONS]])
    return f"SELECT {fields} FROM {database}.{STAGE_TABLE} s {joins}"
