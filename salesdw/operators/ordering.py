"""Order-dependent operators without a single-partition window over the rows.

Rows are placed by a range sort whose partitions hold consecutive key ranges. A row's place is then
(partition number, position in the partition), the two parts of ``monotonically_increasing_id``.
Only one row per partition (or per block of rows) ever meets in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesdw.operators.joins import broadcast_if_small
from salesdw.staging import FULL_ROWS, Staging

# Fixed by Spark: monotonically_increasing_id keeps the position in the low 33 bits.
POSITION_BITS = 33
# Rows per block of a running computation, and blocks per block one level up (1,024 partitions).
ROW_BLOCK_BITS = 20
BLOCK_BLOCK_BITS = POSITION_BITS - ROW_BLOCK_BITS + 10


def scan_row_ids(df: DataFrame, name: str) -> DataFrame:
    """Unique rising ids from 1, gaps allowed. Apply directly on a scan, before any shuffle."""
    return df.withColumn(name, F.monotonically_increasing_id() + 1)


def file_row_ids(df: DataFrame, name: str, staging: Staging) -> DataFrame:
    """Unique ids that rise in source order, gaps allowed: files by path, then rows by their place in the file.

    Spark deals out file splits by size, so ids of the scan keep the source order inside a split only. The rows are
    scanned once and staged with their split's path and start; the distinct splits of that table are ranked by both, and
    the rank is the id's high part. So neither a later scan's other splits nor a lost task can part rows from their
    rank. Apply directly on a scan; rows that come from no files get ids in scan order.
    """
    split = [F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_start")]
    try:
        placed = df.select("*", *split, F.monotonically_increasing_id().alias("_place"))
    except AnalysisException:
        return staging.put(scan_row_ids(df, name), "scanned", FULL_ROWS)
    placed = staging.put(placed, "scanned", FULL_ROWS)
    splits = placed.select("_path", "_start").distinct()
    ranks = staging.put(number_rows(splits, ["_path", "_start"], "_split", staging), "splits")
    position = F.col("_place").bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    row_id = (F.shiftleft("_split", POSITION_BITS) + position).alias(name)
    return placed.join(broadcast_if_small(ranks), ["_path", "_start"]).select(*[placed[f"`{c}`"] for c in df.columns], row_id)


def sorted_row_ids(df: DataFrame, keys: list, name: str, partitions: int | None = None) -> DataFrame:
    """Unique ids from 1, gaps allowed, that rise with ``keys`` over the whole table.

    ``keys`` should tell all rows apart; equal rows may swap. The sampled range bounds differ between
    evaluations, so stage the result before reading it twice.
    """
    ranges = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    return scan_row_ids(ranges.sortWithinPartitions(*keys), name)


def range_of(value: Column, bounds: Sequence[int]) -> Column:
    """Which of the ranges that begin at the rising ``bounds`` holds ``value``: from 0, which takes all lower values too.

    A binary search in an array that each task has, so it suits some thousands of bounds.
    """
    firsts = F.array(*[F.lit(bound).cast("bigint") for bound in bounds])
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(max(1, (len(bounds) - 1).bit_length())))])
    # Beyond the array there is no bound, which compares as null.
    step_on = lambda found, step: F.when(F.get(firsts, found + step) <= value, found + step).otherwise(found)
    return F.aggregate(steps, F.lit(0), step_on)


def number_rows(df: DataFrame, keys: list, name: str, staging: Staging) -> DataFrame:
    """``row_number() over (order by keys)`` as BIGINT, sorted in parallel.

    A row's number is its position in its range partition plus the sizes of the partitions before it.
    """
    placed = staging.put(sorted_row_ids(df, keys, "_place"), f"placed-{name}")
    part = F.shiftright(F.col("_place") - 1, POSITION_BITS)
    position = (F.col("_place") - 1).bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per sort partition, so both the window and the broadcast are bounded by that setting.
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + position + 1)
        .drop("_part", "_place", "_before")
    )


def sum_before(df: DataFrame, keys: list, value: str, name: str, staging: Staging) -> DataFrame:
    """The sum of ``value`` over the rows before each row in key order (0 for the first), sorted in parallel."""
    return sum_before_places(staging.put(sorted_row_ids(df, keys, "_place"), f"placed-{name}"), "_place", value, name)


def sum_before_places(placed: DataFrame, place: str, value: str, name: str) -> DataFrame:
    """``sum_before`` of a staged table whose ids ``place``, which are dropped, come from ``sorted_row_ids``."""
    placed = placed.withColumn("_part", F.shiftright(F.col(place) - 1, POSITION_BITS))
    sums = placed.groupBy("_part").agg(F.sum(value).alias("_sum"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per sort partition.
    offsets = sums.select("_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_earlier"))
    within = Window.partitionBy("_part").orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(value).over(within), F.lit(0))
    summed = placed.withColumn(name, inside).join(F.broadcast(offsets), "_part")
    return summed.withColumn(name, F.col(name) + F.col("_earlier")).drop("_part", place, "_earlier")


def dense_rank_rows(df: DataFrame, keys: list[str], name: str, staging: Staging) -> DataFrame:
    """``dense_rank() over (order by keys)``: only the distinct keys are sorted, then looked up."""
    ranks = number_rows(df.select(*keys).distinct(), keys, name, staging)
    ranks = staging.put(ranks, "ranks").withColumnsRenamed({key: f"_{key}" for key in keys})
    same = [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys]
    return df.join(broadcast_if_small(ranks), same, "left").drop(*[f"_{key}" for key in keys])


def previous_value(
    df: DataFrame, order: str, value: str, name: str, block_bits: tuple[int, ...] = (ROW_BLOCK_BITS, BLOCK_BLOCK_BITS)
) -> DataFrame:
    """Add the last non-null ``value`` among the rows strictly before each row in a unique BIGINT order.

    The order is cut into blocks of 2^bits ids. Inside a block a window finds the value; the last
    value of each block is handed on by the same computation over the (far fewer) blocks.
    """
    before = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    if not block_bits:
        return df.withColumn(name, F.last(value, ignorenulls=True).over(before))

    level = len(block_bits)
    block, tail, carry = f"_block{level}", f"_tail{level}", f"_carry{level}"
    blocked = df.withColumn(block, F.shiftright(F.col(order), block_bits[0]))
    within = Window.partitionBy(block).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    known = F.col(value).isNotNull()
    tails = blocked.groupBy(block).agg(F.max_by(value, F.when(known, F.col(order))).alias(tail))
    carried = previous_value(tails, block, tail, carry, block_bits[1:]).select(block, carry)
    # The window has already placed the rows by block, so this join moves only the block rows.
    return (
        blocked.withColumn(name, F.last(value, ignorenulls=True).over(within))
        .join(carried, block, "left")
        .withColumn(name, F.coalesce(F.col(name), F.col(carry)))
        .drop(block, carry)
    )


def forward_fill(
    df: DataFrame, column: str, row_id: str, history: DataFrame | None = None, staging: Staging | None = None
) -> DataFrame:
    """Fill nulls of ``column`` with the last earlier non-null value in ``row_id`` order.

    ``history`` gives the rows to look back on, where they are more than those of ``df``. Only the id
    and the column of the history are shuffled, and only rows of ``df`` with a gap are joined. With ``staging`` the
    fills of the gaps are written, so that a result that is read twice shuffles the history once.
    """
    source = (df if history is None else history).select(row_id, column)
    gap: Column = F.col(column).isNull()
    fills = previous_value(source, row_id, column, "_filled").filter(gap).select(row_id, "_filled")
    if staging is not None:
        fills = staging.put(fills, "fills")
    filled = df.filter(gap).join(fills, row_id, "left").withColumn(column, F.col("_filled"))
    return df.filter(~gap).unionByName(filled.select(*df.columns))
