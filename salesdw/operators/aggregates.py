"""Mode, first-per-group and their fills."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesdw.functions.columns import MISSING_PATTERN


def mode_value(df: DataFrame, column: str) -> DataFrame:
    """One row: the most frequent non-null value and its count; ties go to the lowest value."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), F.asc(column))
        .limit(1)
    )


def mode_fill(df: DataFrame, column: str, source: DataFrame | None = None) -> DataFrame:
    """Put the mode of ``source`` (default ``df``) in place of the missing-value text and of nulls.

    The mode is a scalar subquery: Spark computes the one value first and uses it as a constant.
    """
    mode = mode_value(df if source is None else source, column).select(column).scalar()
    replaced = F.regexp_replace(F.col(column), F.lit(MISSING_PATTERN), mode)
    return df.withColumn(column, F.coalesce(replaced, mode))


def first_per_group(df: DataFrame, key: str, value: str, order: str, name: str) -> DataFrame:
    """The non-null ``value`` with the lowest ``order`` for each non-null ``key``.

    First one row per (key, value) by hash aggregation, so that a hot key is reduced before it meets.
    """
    pairs = (
        df.filter(F.col(key).isNotNull() & F.col(value).isNotNull())
        .groupBy(key, value)
        .agg(F.min(order).alias("_first"))
    )
    return pairs.groupBy(key).agg(F.min_by(value, "_first").alias(name))
