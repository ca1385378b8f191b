"""Lookups and the type-1 upsert."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is broadcast only when its measured size is below this.
BROADCAST_BYTES = 128 * 1024 * 1024
_BYTES_PER_VALUE = 16
# Rows a key from which on a side counts as one that multiplies rows; below, the approximate count may be what differs.
MULTIPLIES = 1.2


DUPLICATE_KEYS = "several source rows match one target row on"


class DuplicateSourceKeys(ValueError):
    """Several source rows of an upsert match the same target row."""


def value_bytes(df: DataFrame) -> Column:
    """The size of a table as an aggregate: a fixed width per value plus the true length of all text."""
    texts = [field.name for field in df.schema if isinstance(field.dataType, T.StringType)]
    lengths = [F.coalesce(F.sum(F.octet_length(name)), F.lit(0)) for name in texts]
    return reduce(lambda size, length: size + length, lengths, F.count(F.lit(1)) * (_BYTES_PER_VALUE * len(df.columns)))


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure ``df``; use on staged tables."""
    return df.agg(value_bytes(df).alias("size")).first()["size"] <= max_bytes


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Beyond the bound the join is a sort-merge join, whose hot partitions adaptive execution splits."""
    return F.broadcast(df) if fits_broadcast(df, max_bytes) else df


def key_match(left: Column, right: Column, null_safe: bool) -> Column:
    return left.eqNullSafe(right) if null_safe else left == right


class Side(NamedTuple):
    """The rows of one side of a plan's joins, marked for broadcast or not, by its place among the sides, and how many
    rows of it a row meets on average; 1 where that is no more than ``MULTIPLIES``."""

    place: int
    rows: DataFrame
    times: float


def measured_sides(sides: Sequence[DataFrame], max_bytes: int = BROADCAST_BYTES, key: str | None = None) -> list[Side]:
    """All ``sides`` of one plan in the order in which to join them, those to broadcast marked and first.

    One job measures all of them. Every executor holds the broadcast sides together, so their sum keeps to the bound:
    the smallest ones are taken, which are the most that fit. The others follow from small to large. With ``key``, the
    sides' column to join by, those that have several rows a key, so that they multiply the rows, come after all others,
    the least so first: no shuffle for another side then moves the multiplied rows. Only the order follows from that
    measure, whose distinct keys are counted approximately.
    """
    rows = F.count(F.lit(1)) if key is None else F.count(key)
    keys = rows if key is None else F.approx_count_distinct(key)
    parts = [
        side.agg(value_bytes(side).alias("size"), (rows / F.greatest(keys, F.lit(1))).alias("times")).select(
            F.lit(place).alias("place"), "size", "times"
        )
        for place, side in enumerate(sides)
    ]
    measured = sorted((row["size"], row["place"], row["times"]) for row in reduce(DataFrame.unionByName, parts).collect())  # a row a side
    ordered, total = [], 0
    for size, place, times in measured:
        total += size
        multiplies = times if times > MULTIPLIES else 1.0
        ordered.append(Side(place, F.broadcast(sides[place]) if total <= max_bytes else sides[place], multiplies))
    return sorted(ordered, key=lambda side: side.times)


def broadcast_together(
    sides: Sequence[DataFrame], max_bytes: int = BROADCAST_BYTES, key: str | None = None
) -> list[tuple[int, DataFrame]]:
    """(place, side) of ``measured_sides``."""
    return [(side.place, side.rows) for side in measured_sides(sides, max_bytes, key)]


def lookup_keys(dimension: DataFrame, key: str, surrogate: str) -> DataFrame:
    """The two columns of a dimension that a lookup needs."""
    return dimension.select(F.col(key).alias("_key"), F.col(surrogate))


def lookup(rows: DataFrame, keys: DataFrame, row_key: str, null_safe: bool = True) -> DataFrame:
    """Left join that adds the surrogate key to ``rows``; ``keys`` comes from ``lookup_keys``, marked for broadcast or not."""
    return rows.join(keys, key_match(rows[row_key], keys["_key"], null_safe), "left").drop("_key")


def fill_from_group(df: DataFrame, column: str, key: str, values: DataFrame, value: str) -> DataFrame:
    """Fill nulls of ``column`` from ``values`` (unique on ``key``). Only rows with a gap and a key are joined."""
    fillable = F.col(column).isNull() & F.col(key).isNotNull()
    filled = df.filter(fillable).join(values, key, "left").withColumn(column, F.col(value))
    return df.filter(~fillable).unionByName(filled.select(*df.columns))


def merge_upsert(target: DataFrame, source: DataFrame, key: str, null_safe: bool = False) -> DataFrame:
    """MERGE with "update all" on a match and "insert all" otherwise; columns are matched by name.

    The job fails when a target row matches several source rows (see ``DUPLICATE_KEYS``). The rows of a source key are
    counted where the join needs them anyway, so each side is read and shuffled once. Without ``null_safe`` a null key
    matches nothing, so it stays on both sides.
    """
    left = target.withColumn("_in_target", F.lit(True)).alias("t")
    right = source.select("*", F.count(F.lit(1)).over(Window.partitionBy(key)).alias("_copies"), F.lit(True).alias("_in_source")).alias("s")
    joined = left.join(right, key_match(F.col(f"t.{key}"), F.col(f"s.{key}"), null_safe), "full_outer")
    clash = F.col("_in_target") & F.col("_in_source") & (F.col("_copies") > 1)
    checked = joined.where(F.when(clash, F.raise_error(F.lit(f"{DUPLICATE_KEYS} {key}")).cast("boolean")).otherwise(F.lit(True)))
    updated = F.col("_in_source").isNotNull()
    return checked.select(
        *[F.when(updated, F.col(f"s.{name}")).otherwise(F.col(f"t.{name}")).alias(name) for name in target.columns]
    )
