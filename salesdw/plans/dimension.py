"""Dimensions: members of a batch, surrogate keys, type-1 upsert.

All dimensions of a load are made together. A table of members holds the rows of several dimensions: ``dim`` is the
place of the dimension in the list, the other columns are those of all of them, null where they are another one's. One pass over
the staged rows with one shuffle finds all distinct members, and one range sort numbers them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesdw.operators.joins import merge_upsert
from salesdw.operators.ordering import number_rows
from salesdw.schema import TABLES, Dimension
from salesdw.staging import Staging

Specs = Sequence[Dimension]


def member_columns(specs: Specs) -> list[str]:
    return [name for spec in specs for name in [spec.key, *spec.attributes]]


def distinct_members(staged: DataFrame, specs: Specs) -> DataFrame:
    """The distinct keys with their attributes, and ``_date``, when they were last seen. A key with several attribute
    values keeps several rows.

    Each row counts for every dimension (a grouping set each); the first half of the aggregation runs before the shuffle.
    """
    date = F.col("created_at").alias("_date") if "created_at" in staged.columns else F.lit(None).cast("date").alias("_date")
    fields = [(spec, source, name) for spec in specs for source, name in zip([spec.source_key, *spec.attributes], [spec.key, *spec.attributes])]
    typed = staged.select(date, *[F.col(source).cast(TABLES[spec.table][name].dataType).alias(name) for spec, source, name in fields])
    names = member_columns(specs)
    sets = [[spec.key, *spec.attributes] for spec in specs]
    # The grouping id has a bit for each column, the first one highest, which is set where the column is not grouped.
    ids = [sum(1 << (len(names) - 1 - place) for place, name in enumerate(names) if name not in own) for own in sets]
    members = typed.groupingSets([[F.col(name) for name in own] for own in sets], *names).agg(
        F.grouping_id().alias("_set"), F.max("_date").alias("_date")
    )
    dim = reduce(lambda rest, pair: F.when(F.col("_set") == pair[1], pair[0]).otherwise(rest), enumerate(ids), F.lit(None).cast("int"))
    return members.select(dim.alias("dim"), *names, "_date")


def latest_members(staged: DataFrame, specs: Specs) -> DataFrame:
    """One row per key: the attributes seen last by date, ties going to the highest values.

    Only distinct members reach the second aggregation.
    """
    members = distinct_members(staged, specs)
    attributes = [name for spec in specs for name in spec.attributes]
    if not attributes:
        return members.drop("_date")
    keys = [spec.key for spec in specs]
    newest = members.groupBy("dim", *keys).agg(F.max(F.struct("_date", *attributes)).alias("_new"))
    return newest.select("dim", *keys, "_new.*").select("dim", *member_columns(specs))


def numbered(members: DataFrame, specs: Specs, staging: Staging) -> DataFrame:
    """Adds ``_number``, from 1 in the order of key, then attributes (nulls first), for each dimension; one sort for all."""
    placed = staging.put(number_rows(members, ["dim", *member_columns(specs)], "_overall", staging), "numbered-members")
    sizes = placed.groupBy("dim").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("dim").rowsBetween(Window.unboundedPreceding, -1)  # one row a dimension
    before = sizes.select("dim", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    joined = placed.join(F.broadcast(before), "dim")
    return joined.withColumn("_number", F.col("_overall") - F.col("_before")).drop("_overall", "_before")


def rows_of(members: DataFrame, specs: Specs, spec: Dimension) -> DataFrame:
    """Key and attributes of one dimension's members, and ``_number`` where there is one."""
    kept = [spec.key, *spec.attributes, *(["_number"] if "_number" in members.columns else [])]
    return members.where(F.col("dim") == list(specs).index(spec)).select(*kept)


def keyed(members: DataFrame, spec: Dimension) -> DataFrame:
    """The number as surrogate key, in the type of the dimension table; one too large for it fails the job."""
    kind = TABLES[spec.table][spec.surrogate].dataType
    return members.withColumn(spec.surrogate, F.col("_number").cast(kind)).select(*spec.columns)


def dimension_views(staged: DataFrame, specs: Specs, staging: Staging) -> list[DataFrame]:
    """For each dimension the distinct members of a batch, numbered from 1 in key order (nulls first)."""
    members = numbered(distinct_members(staged, specs).drop("_date"), specs, staging)
    return [keyed(rows_of(members, specs, spec), spec) for spec in specs]


def upsert_stable(currents: Sequence[DataFrame], members: DataFrame, specs: Specs, staging: Staging) -> list[DataFrame]:
    """Type-1 upsert in which a member keeps its surrogate key for good.

    ``members`` has one row per key. Matched members take the new attributes. Only members that the tables ``currents``
    do not have are sorted and numbered, in key order on from the highest key in use. Null is a member like others.
    """
    members = staging.put(members, "members")
    empty = members.limit(0).select("dim", *[F.col(spec.key).alias(f"_known_{spec.key}") for spec in specs])
    known, highest = empty, []
    for place, (spec, current) in enumerate(zip(specs, currents)):
        own = current.select(F.lit(place).alias("dim"), F.col(spec.key).alias(f"_known_{spec.key}"))
        known = known.unionByName(own, allowMissingColumns=True)
        highest.append(current.agg(F.coalesce(F.max(spec.surrogate), F.lit(0)).cast("bigint")).scalar())
    known = known.withColumnRenamed("dim", "_known_dim")
    same = [F.col(name).eqNullSafe(F.col(f"_known_{name}")) for name in ["dim", *[spec.key for spec in specs]]]
    fresh = numbered(members.join(known, same, "left_anti"), specs, staging)
    results = []
    for spec, current, top in zip(specs, currents, highest):
        names = [spec.key, *spec.attributes]
        seen = rows_of(members, specs, spec).select(F.lit(True).alias("_seen"), *[F.col(n).alias(f"_new_{n}") for n in names])
        matched = current.join(seen, F.col(spec.key).eqNullSafe(F.col(f"_new_{spec.key}")), "left")
        latest = [F.when(F.col("_seen"), F.col(f"_new_{n}")).otherwise(F.col(n)).alias(n) for n in spec.attributes]
        added = keyed(rows_of(fresh, specs, spec).withColumn("_number", F.col("_number") + top), spec)
        results.append(matched.select(spec.key, *latest, spec.surrogate).unionByName(added))
    return results


def upsert_rekeyed(currents: Sequence[DataFrame], staged: DataFrame, specs: Specs, staging: Staging) -> list[DataFrame]:
    """Type-1 upsert in which the batch's own numbering overwrites the key of matched members."""
    views = dimension_views(staged, specs, staging)
    return [merge_upsert(current, view, spec.key) for spec, current, view in zip(specs, currents, views)]
