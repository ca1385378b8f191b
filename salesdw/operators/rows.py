"""Row cleaning: empty rows, duplicates, columns and constant fills."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesdw.functions import lenient_int
from salesdw.operators.joins import fits_broadcast
from salesdw.staging import Staging


def drop_empty_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Drop rows in which every one of ``columns`` (default: all) is null."""
    return df.na.drop("all", subset=columns)


def drop_duplicate_rows(df: DataFrame, row_id: str | None = None) -> DataFrame:
    """Keep one row of each group of equal rows; with ``row_id``, the one with the lowest id.

    A hash aggregate: copies collapse on the map side, so a huge group of copies crosses the network
    as one row per task.
    """
    if row_id is None:
        return df.dropDuplicates()
    data = [name for name in df.columns if name != row_id]
    return df.groupBy(*data).agg(F.min(row_id).alias(row_id))


def row_hash(columns: list[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{column}`") for column in columns])


def first_of_copies(df: DataFrame, data: list[str], row_id: str, row_hash: str, staging: Staging) -> DataFrame:
    """``df`` with one row, that of the lowest ``row_id``, of each group of rows equal in all ``data`` columns.

    ``df`` is a staged table and ``row_hash`` its column with the hash of ``data``; other columns follow from ``data``.
    Only hashes are counted over all rows. Rows whose hash repeats, all copies among them, are compared exactly and
    staged beside; the others are read from where they are. Repeated hashes beyond the broadcast bound are matched by a
    shuffle, whose result is staged too, so that later readers do not repeat it.
    """
    counts = df.groupBy(row_hash).agg(F.count(F.lit(1)).alias("_copies"))
    repeated = staging.put(counts.filter("_copies > 1").select(row_hash), "repeated-hashes")
    small = fits_broadcast(repeated)
    side = F.broadcast(repeated) if small else repeated
    others = [name for name in df.columns if name not in (*data, row_id)]
    copies = df.join(side, row_hash, "left_semi").groupBy(*[F.col(f"`{name}`") for name in data])
    distinct = copies.agg(F.min(row_id).alias(row_id), *[F.any_value(F.col(f"`{name}`")).alias(name) for name in others])
    distinct = staging.put(distinct.select(*[f"`{name}`" for name in df.columns]), "distinct-copies")
    single = df.join(side, row_hash, "left_anti")
    if not small:
        single = staging.put(single, "single-rows")
    return single.select(*[f"`{name}`" for name in df.columns]).unionByName(distinct)


def keep_castable(df: DataFrame, column: str) -> DataFrame:
    return df.filter(lenient_int(F.col(column)).isNotNull())


def keep_uncastable(df: DataFrame, column: str) -> DataFrame:
    return df.filter(lenient_int(F.col(column)).isNull())


def exclude_values(df: DataFrame, column: str, values: tuple[str, ...]) -> DataFrame:
    """Rows whose value is not listed. As in SQL, a null value is dropped too: fill nulls first."""
    return df.filter(~F.col(column).isin(*values))


def in_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Rows whose value is listed. A null in the list matches nothing, as in SQL."""
    return df.filter(F.col(column).isin(*values))


def equal_rows(df: DataFrame, few: DataFrame) -> DataFrame:
    """The rows of ``df`` that equal, nulls alike, one of the ``few`` rows of the same columns."""
    own = F.broadcast(few.distinct().select(*[F.col(name).alias(f"_{name}") for name in few.columns]))
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in few.columns]
    return df.join(own, same, "left_semi")


def newest_rows(df: DataFrame, column: str, count: int) -> DataFrame:
    """The ``count`` rows with the highest ``column``; ties follow the other columns in name order.

    Each task keeps only its own top rows, so no task sorts the table.
    """
    others = sorted(name for name in df.columns if name != column)
    return df.orderBy(F.desc_nulls_last(column), *[F.asc_nulls_first(name) for name in others]).limit(count)
