import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows_of
from salesdw.operators import aggregates, joins, rows


def table(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_empty_and_duplicate_rows(spark):
    df = table(spark, [(1, "a"), (1, "a"), (None, None), (None, "b")], "i int, s string")
    assert rows_of(rows.drop_empty_rows(df)) == rows_of(table(spark, [(1, "a"), (1, "a"), (None, "b")], "i int, s string"))
    assert rows.drop_duplicate_rows(df).count() == 3
    numbered = table(spark, [(1, "a", 5), (1, "a", 3), (None, "b", 4)], "i int, s string, r long")
    assert rows_of(rows.drop_duplicate_rows(numbered, "r")) == [(1, "a", 3), (None, "b", 4)]


@pytest.mark.parametrize("small", [True, False])
def test_first_of_copies(spark, staging, monkeypatch, small):
    """Copies are compared in all columns, also where different rows have one hash; extra columns come along."""
    monkeypatch.setattr(rows, "fits_broadcast", lambda df: small)
    df = spark.range(1000).select(
        (F.col("id") % 700).alias("a"), F.lit("x").alias("b c"), F.col("id").alias("r"), (F.col("id") % 5).alias("hash")
    ).withColumn("twice", F.col("a") * 2)
    kept = rows.first_of_copies(staging.put(df, "t"), ["a", "b c"], "r", "hash", staging)
    assert kept.columns == df.columns
    assert rows_of(kept) == [(i, "x", i, i % 5, 2 * i) for i in sorted(range(700), key=lambda i: repr((i, "x", i, i % 5, 2 * i)))]


def test_first_of_copies_moves_hashes_only(spark, staging):
    df = spark.range(1000).select((F.col("id") % 700).alias("a"), F.lit("x").alias("b"), F.col("id").alias("r"))
    hashed = staging.put(df.withColumn("hash", rows.row_hash(["a", "b"])), "t")
    plan = rows.first_of_copies(hashed, ["a", "b"], "r", "hash", staging)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan


def test_null_never_matches_a_list(spark):
    df = table(spark, [("\\N",), (None,), ("x",)], "c string")
    assert rows_of(rows.in_values(df, "c", ["\\N", None])) == [("\\N",)]
    assert rows_of(rows.exclude_values(df, "c", ("\\N",))) == [("x",)]


def test_mode(spark):
    df = table(spark, [("b",), ("a",), ("b",), ("a",), ("\\N",), (None,), (None,), (None,)], "s string")
    assert rows_of(aggregates.mode_value(df, "s")) == [("a", 2)]
    assert [r[0] for r in rows_of(aggregates.mode_fill(df, "s"))] == ["a"] * 6 + ["b"] * 2


def test_first_per_group_skips_nulls(spark):
    data = [("k", None, 1), ("k", "late", 9), ("k", "early", 2), (None, "x", 3), ("n", None, 4)]
    df = table(spark, data, "k string, v string, r long")
    assert rows_of(aggregates.first_per_group(df, "k", "v", "r", "f")) == [("k", "early")]


def test_merge_updates_and_inserts(spark):
    target = table(spark, [(1, "old", 7), (2, "keep", 8), (None, "null", 9)], "k int, v string, s int")
    source = table(spark, [(1, "new", 1), (3, "add", 2), (None, "again", 3)], "k int, v string, s int")
    merged = rows_of(joins.merge_upsert(target, source, "k"))
    assert merged == rows_of(
        table(
            spark,
            [(1, "new", 1), (2, "keep", 8), (3, "add", 2), (None, "null", 9), (None, "again", 3)],
            "k int, v string, s int",
        )
    )
    safe = rows_of(joins.merge_upsert(target, source, "k", null_safe=True))
    assert (None, "again", 3) in safe and (None, "null", 9) not in safe


def test_merge_takes_a_null_from_the_source(spark):
    target = table(spark, [(1, "old")], "k int, v string")
    source = table(spark, [(1, None)], "k int, v string")
    assert rows_of(joins.merge_upsert(target, source, "k")) == [(1, None)]


def test_merge_with_repeated_source_keys(spark):
    """A repeated key fails when the target has it, and is inserted twice when not."""
    source = table(spark, [(1, "7/2016"), (1, "8/2016")], "k int, v string")
    with pytest.raises(PySparkException, match=joins.DUPLICATE_KEYS):
        joins.merge_upsert(table(spark, [(1, "x")], "k int, v string"), source, "k").count()
    assert joins.merge_upsert(table(spark, [(2, "x")], "k int, v string"), source, "k").count() == 3
    nulls = table(spark, [(None, "a"), (None, "b")], "k int, v string")
    assert joins.merge_upsert(table(spark, [(None, "x")], "k int, v string"), nulls, "k").count() == 3


@pytest.mark.parametrize("null_safe", [True, False])
def test_lookup_is_the_same_beyond_the_broadcast_bound(spark, null_safe):
    """A third of the rows share one key; the sort-merge path must give the same result."""
    sales = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 17 == 0, None).otherwise(F.col("id") % 500).alias("k"), "id"
    )
    members = table(spark, [(n, n + 1000) for n in range(400)] + [(None, 5)], "k long, s int")
    keys = joins.lookup_keys(members, "k", "s")
    small = joins.lookup(sales, joins.broadcast_if_small(keys), "k", null_safe)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        large = joins.lookup(sales, joins.broadcast_if_small(keys, max_bytes=0), "k", null_safe)
        assert "SortMergeJoin" in large._jdf.queryExecution().executedPlan().toString()
        assert rows_of(small) == rows_of(large)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    found = small.filter("k IS NULL").select("s").distinct().collect()
    assert [row["s"] for row in found] == ([5] if null_safe else [None])


def test_each_side_of_a_merge_is_read_once(spark, staging):
    target = staging.put(table(spark, [(1, "x"), (2, "y")], "k int, v string"), "target")
    source = staging.put(table(spark, [(2, "z"), (3, "w")], "k int, v string"), "source")
    plan = joins.merge_upsert(target, source, "k")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and plan.count("Exchange hashpartitioning") == 2


def test_broadcast_sides_keep_to_one_bound(spark):
    """Two sides that fit alone but not together: the smaller one is broadcast, and comes first."""
    small, large = table(spark, [("x" * 100,)] * 10, "s string"), table(spark, [("x" * 100,)] * 12, "s string")
    hint = lambda df: "broadcast" in df._jdf.queryExecution().logical().toString().lower()
    assert [(place, hint(side)) for place, side in joins.broadcast_together([large, small], 1500)] == [(1, True), (0, False)]
    assert [(place, hint(side)) for place, side in joins.broadcast_together([large, small], 3000)] == [(1, True), (0, True)]
    assert [(place, hint(side)) for place, side in joins.broadcast_together([large, small], 1000)] == [(1, False), (0, False)]


def test_size_is_measured(spark):
    df = table(spark, [("x" * 1000,)] * 10, "s string")
    assert joins.fits_broadcast(df, 10_160) and not joins.fits_broadcast(df, 10_159)


def test_sides_that_multiply_rows_are_joined_behind_all_others(spark):
    """Also behind larger ones that are beyond the bound; null keys, which match nothing, do not count."""
    several = spark.createDataFrame([(k % 3, k) for k in range(12)], "_key int, v int")
    twice = spark.createDataFrame([(k % 10, k) for k in range(20)], "_key int, v int")
    once = spark.createDataFrame([(k, k) for k in range(40)], "_key int, v int")
    nulls = spark.createDataFrame([(None, k) for k in range(60)], "_key int, v int")
    sides = [several, twice, once, nulls, once.limit(0)]
    assert [place for place, _ in joins.broadcast_together(sides)] == [4, 0, 1, 2, 3]
    for bound in (joins.BROADCAST_BYTES, 1000):
        assert [place for place, _ in joins.broadcast_together(sides, bound, key="_key")] == [4, 2, 3, 1, 0]
