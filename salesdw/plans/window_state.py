"""The load window: which dates the next batch reads, and how the window advances."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class LoadPolicy:
    """First two windows, width of later ones, and the two choices of the incremental load.

    ``overlap``: a later window starts on the last day of the one before (that day is then read
    twice) instead of the day after. ``rekey``: a batch numbers its members from 1 again and
    overwrites the keys of matched members, instead of keeping a member's key for good. ``null_unfit``:
    amounts that the fact table's types cannot hold become null and are counted, instead of failing the
    batch before its window moves. ``keep_unfit``: rows with such amounts go to the table of rejects, whole and with
    the reason, and not to the fact table.
    """

    first_start: date = date(2016, 1, 1)
    first_end: date = date(2016, 12, 31)
    second_start: date = date(2017, 1, 1)
    second_end: date = date(2017, 12, 31)
    step_days: int = 365
    overlap: bool = False
    rekey: bool = False
    null_unfit: bool = False
    keep_unfit: bool = False


def current_window(state: DataFrame, policy: LoadPolicy = LoadPolicy()) -> DataFrame:
    """One row, also for an empty state: id, start_date, end_date of the window to read now."""
    some = F.count(F.lit(1)) > 0
    return state.agg(
        F.coalesce(F.max("id"), F.lit(0)).cast("bigint").alias("id"),
        F.when(some, F.max_by("start_date", "id")).otherwise(F.lit(policy.first_start)).alias("start_date"),
        F.when(some, F.max_by("incremental_date", "id")).otherwise(F.lit(policy.first_end)).alias("end_date"),
    )


def next_window(state: DataFrame, policy: LoadPolicy = LoadPolicy()) -> DataFrame:
    """One row to append to the state. The id counts on from the highest one."""
    some = F.count(F.lit(1)) > 0
    end = F.max("incremental_date")
    start = end if policy.overlap else F.date_add(end, 1)
    return state.agg(
        (F.coalesce(F.max("id"), F.lit(0)) + 1).cast("bigint").alias("id"),
        F.when(some, start).otherwise(F.lit(policy.second_start)).alias("start_date"),
        F.when(some, F.date_add(end, policy.step_days)).otherwise(F.lit(policy.second_end)).alias("incremental_date"),
    )


def rows_in_window(cleaned: DataFrame, start: date, end: date) -> DataFrame:
    """Rows dated from ``start`` to ``end``, both included. The constants reach the Parquet scan."""
    return cleaned.filter(F.col("created_at").between(F.lit(start), F.lit(end)))
