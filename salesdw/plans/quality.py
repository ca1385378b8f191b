"""Data-quality reports as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_profile(df: DataFrame) -> DataFrame:
    """One row: the number of nulls in each column, from one pass."""
    return df.agg(*[F.count_if(F.col(f"`{name}`").isNull()).alias(name) for name in df.columns])


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: its name, type and number of nulls, from one pass."""
    kinds = {field.name: field.dataType.simpleString() for field in df.schema}
    profile = null_profile(df)
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("data_type"),
            F.col(f"`{name}`").alias("null_count"),
        )
        for name, kind in kinds.items()
    ]
    return profile.select(F.inline(F.array(*rows)))


def columns_agree_count(df: DataFrame, left: str, right: str) -> DataFrame:
    """One row: all rows, and those where the columns are equal or the right one is null."""
    agrees = (F.col(left) == F.col(right)) | F.col(right).isNull()
    return df.agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(agrees).alias("matching_rows"))


def inspect_null_rows(df: DataFrame, column: str, shown: list[str]) -> DataFrame:
    """The rows whose ``column`` is null, as the columns ``shown``."""
    return df.filter(F.col(column).isNull()).select(*shown)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))
