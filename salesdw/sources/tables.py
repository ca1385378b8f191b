"""Reading and writing catalog tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesdw.operators.joins import broadcast_if_small
from salesdw.operators.ordering import sum_before
from salesdw.staging import FULL_ROWS, Staging, partitions_for


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def overwrite_table(df: DataFrame, name: str) -> None:
    """Replace a managed table; the new schema may differ. The table must not be read by ``df``."""
    df.write.mode("overwrite").format("parquet").option("compression", FULL_ROWS).saveAsTable(name)


def sort_for_write(
    df: DataFrame,
    key: str,
    row_id: str,
    staging: Staging,
    partitions: int | None = None,
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Order by ``key`` in partitions of consecutive keys, so that readers skip files and row groups by it.

    The rows of each key are counted first, for which only the key's own columns are computed; running sums of these
    counts say which partitions a key belongs to, so the full rows are computed once, for the shuffle itself. Without
    ``partitions`` their number follows the rows, so that a task sorts its share in memory. A key
    with more rows than a partition takes is dealt over several by the hash of ``row_id``, which is dropped afterwards.
    ``finish`` adds, behind the shuffle, what need not be moved; it must leave rows where they are and keep both columns.
    """
    counts = staging.put(df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_rows")), "key-counts")
    total = counts.agg(F.sum("_rows")).first()[0] or 1
    parts = partitions or partitions_for(df.sparkSession, total)
    share = F.lit(-(-total // parts))
    placed = sum_before(counts, ["_key"], "_rows", "_before", staging)
    first = F.floor(F.col("_before") / share)
    last = F.floor((F.col("_before") + F.col("_rows") - 1) / share)
    spans = staging.put(placed.select("_key", first.alias("_first"), (last - first + 1).alias("_span")), "key-spans")
    joined = df.join(broadcast_if_small(spans), F.col(key).eqNullSafe(F.col("_key")), "left")
    # One number is moved with each row, not the columns it is made of.
    part = (F.col("_first") + F.pmod(F.xxhash64(row_id), F.col("_span"))).cast("int").alias("_part")
    dealt = joined.select(*df.columns, part).repartitionById(parts, "_part").drop("_part")
    # Sorted last: a join behind it would let the sort be left out.
    whole = dealt if finish is None else finish(dealt)
    return whole.sortWithinPartitions(key, row_id).drop(row_id)
