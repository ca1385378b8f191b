"""The sales fact: measures plus six surrogate keys."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from math import ceil, prod

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from salesdw.operators.joins import broadcast_if_small, lookup, lookup_keys, measured_sides
from salesdw.schema import DIMENSIONS, FACT_TABLE, TABLES
from salesdw.staging import partitions_for

MEASURES = ("price", "qty_ordered", "grand_total", "discount_amount", "mv")
# Facts that a task makes at most on average where lookups multiply the rows.
TASK_FACTS = 1 << 22


def fact_view(staged: DataFrame, dimension: Callable[[str], DataFrame], null_safe: bool = True) -> DataFrame:
    """Measures of the staged rows with the surrogate key of each dimension; a missing member gives null.

    ``dimension`` maps a table name to its rows. With ``null_safe`` a null finds the null member. A member key that
    stands in several rows multiplies the facts, so such dimensions are looked up last.
    """
    return _looked_up(staged, MEASURES, dimension, null_safe)


def _looked_up(staged: DataFrame, columns: Sequence[str], dimension: Callable[[str], DataFrame], null_safe: bool) -> DataFrame:
    """``columns`` of the staged rows with the surrogate keys. Rows are spread over more tasks before they are multiplied
    beyond ``TASK_FACTS`` a task."""
    keys = dict.fromkeys(spec.source_key for spec in DIMENSIONS)
    rows = staged.select(*columns, *keys)
    sides = measured_sides([lookup_keys(dimension(spec.table), spec.key, spec.surrogate) for spec in DIMENSIONS], key="_key")
    times = prod(side.times for side in sides)
    facts = staged.count() * times if times > 1 else 0
    for side in sides:
        source_key = DIMENSIONS[side.place].source_key
        if side.times > 1 and facts > TASK_FACTS:
            parts = max(partitions_for(rows.sparkSession, 0), ceil(facts / TASK_FACTS))
            # Rows of one key stay together, but for a hot one, and few of them are moved, as none is multiplied yet. Generated
            # code puts a projection off to where it is used, so without this shuffle the casts would run once a fact.
            rows, facts = rows.repartitionByRange(parts, source_key, F.xxhash64(*rows.columns)), 0
        rows = lookup(rows, side.rows, source_key, null_safe)
    return rows.select(*columns, *[spec.surrogate for spec in DIMENSIONS])


def fitted_values() -> tuple[dict[str, Column], dict[str, Column]]:
    """The columns of the fact table in its types (null where a value does not fit), and whether a measure is lost so."""
    fitted = {field.name: F.col(field.name).try_cast(field.dataType) for field in TABLES[FACT_TABLE].fields}
    return fitted, {name: F.col(name).isNotNull() & fitted[name].isNull() for name in MEASURES}


def fact_rows(
    staged: DataFrame, dimension: Callable[[str], DataFrame], null_safe: bool = True, rejects: Observation | None = None
) -> DataFrame:
    """``fact_view`` in the types of the fact table. A value that does not fit fails the job; with ``rejects`` it becomes
    null instead, and the lost values are counted per column while the facts are written, without another pass.

    Measures are fitted before the lookups, so where rows are spread once a staged row, however many facts it becomes.
    """
    fitted, lost = fitted_values()
    marks: dict[str, Column] = {}
    for name, is_lost in lost.items():
        if rejects is not None:
            marks[f"_lost_{name}"] = is_lost
        else:
            message = F.concat(F.lit(f"{name} does not fit the fact table: "), F.col(name).cast("string"))
            fitted[name] = F.when(is_lost, F.raise_error(message).cast(TABLES[FACT_TABLE][name].dataType)).otherwise(fitted[name])
    measures = staged.withColumns({name: fitted[name] for name in MEASURES} | marks)
    view = _looked_up(measures, [*MEASURES, *marks], dimension, null_safe)
    if rejects is not None:
        view = view.observe(rejects, *[F.count_if(f"_lost_{name}").alias(name) for name in MEASURES])
    return view.select(*[F.col(field.name).cast(field.dataType) for field in TABLES[FACT_TABLE].fields])


def fact_or_reject(view: DataFrame, rejects: Observation | None = None) -> DataFrame:
    """All rows of the view with ``rejected``: facts in their types, and rejects as they are with the reason. ``rejects``
    counts the lost values per column while the rows are written."""
    fitted, lost = fitted_values()
    if rejects is not None:
        view = view.observe(rejects, *[F.count_if(is_lost).alias(name) for name, is_lost in lost.items()])
    reasons = [F.when(is_lost, F.concat(F.lit(f"{name} does not fit: "), F.col(name).cast("string"))) for name, is_lost in lost.items()]
    reason = F.concat_ws("; ", *reasons)
    rejected = reason != ""
    raw = [F.when(rejected, F.col(name).cast("double")).alias(f"raw_{name}") for name in MEASURES]
    values = [value.alias(name) for name, value in fitted.items()]
    return view.select(*values, *raw, F.when(rejected, reason).alias("reason"), rejected.alias("rejected"))


def facts_by_date(facts: DataFrame, dates: DataFrame) -> DataFrame:
    """Facts with their date row, newest first.

    The row id only breaks ties, so that the sort can split a date that holds many of the rows.
    """
    dates = broadcast_if_small(dates.withColumnRenamed("DimDateKey", "_date_key"))
    joined = facts.join(dates, F.col("DimDateKey") == F.col("_date_key"), "left").drop("_date_key")
    spread = joined.withColumn("_row", F.monotonically_increasing_id())
    return spread.orderBy(F.desc("created_at"), "_row").drop("_row")
