"""Plans whose partitions follow the rows, on rows of their own."""

import glob
from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from salesdw import staging as stages
from salesdw.checks import fixtures, queries
from salesdw.operators import ordering, rows
from salesdw.plans import clean
from salesdw.sources import files, tables


@pytest.fixture
def few_tables(spark, tmp_path):
    """Eight orders, one of them twice, one without a customer; lines with repeated and missing keys."""
    n = spark.range(60)
    line = n.select(
        (F.col("id") % 9).alias("l_orderkey"), (F.col("id") % 7 + 1).cast("int").alias("l_linenumber"), (F.col("id") % 5).alias("l_partkey"),
        F.lit(1).cast("long").alias("l_suppkey"), (F.col("id") * 100.5).alias("l_extendedprice"), F.lit(3.0).alias("l_quantity"),
        F.lit(0.04).alias("l_discount"), F.lit("A").alias("l_returnflag"),
    )
    line = line.unionByName(line.limit(1)).unionByName(line.limit(1).withColumn("l_orderkey", F.lit(None).cast("long")))
    orders = [(k, k % 3 if k else 99, "F", date(1996, 1, k + 1), "1-URGENT") for k in [*range(8), 5]]
    parts = [(k, f"name {k}", f"Brand#{k}", "TYPE", 10.0 + k) for k in range(5)]
    made = {
        "lineitem": line,
        "orders": spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate date, o_orderpriority string"),
        "part": spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string, p_retailprice double"),
        "customer": spark.createDataFrame([(k,) for k in range(3)], "c_custkey long"),
    }
    for name, df in made.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_messy_sales_follows_the_lines(spark, few_tables, monkeypatch):
    """More partitions than the session's for many lines, ids in source order, and the rows of the plain SQL."""
    monkeypatch.setattr(stages, "TASK_ROWS", 4)
    asked = []
    plain_ids = fixtures.sorted_row_ids
    monkeypatch.setattr(fixtures, "sorted_row_ids", lambda df, keys, name, n=None: asked.append(n) or plain_ids(df, keys, name, n))
    found = fixtures.messy_sales(spark, few_tables)
    sources = {name: fixtures.read_table(spark, few_tables, name) for name in fixtures.SOURCES}
    assert asked == [16]
    assert rows_of(found.drop(fixtures.ROW_ID)) == rows_of(spark.sql(fixtures.MESSY_SQL, **sources))
    ordered = [tuple(r) for r in found.orderBy(fixtures.ROW_ID).select(*fixtures.ORDER).collect()]
    assert ordered == sorted(ordered)


def test_sorted_write_follows_the_rows(spark, staging, monkeypatch):
    monkeypatch.setattr(stages, "TASK_ROWS", 5)
    df = spark.range(100).select(F.col("id"), (F.col("id") % 50).alias("day"))
    placed = tables.sort_for_write(df, "day", "id", staging)
    assert placed.rdd.getNumPartitions() == 20
    assert rows_of(placed) == sorted([(n % 50,) for n in range(100)], key=repr)
    assert tables.sort_for_write(df.limit(0), "day", "id", staging).collect() == []


def test_text_files_follow_the_rows(spark, few_tables, monkeypatch):
    """More than three files, each of several splits, where there are many rows."""
    monkeypatch.setattr(queries, "TASK_ROWS", 10)
    seen = []
    stored = files.stored_bytes
    monkeypatch.setattr(files, "stored_bytes", lambda spark, path: seen.append(len(glob.glob(f"{path}/part-*"))) or stored(spark, path))
    found = queries.clean_sales_csv_order(spark, few_tables)
    assert seen[0] > 3
    assert rows_of(found) == rows_of(queries.clean_sales(spark, few_tables))
    assert rows_of(queries.clean_sales_scan_order(spark, few_tables)) == rows_of(found)


def test_equal_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (None, "c"), (3, "d")], "k int, v string")
    few = spark.createDataFrame([(1, "a"), (2, None), (9, "z")], df.schema)
    assert rows_of(rows.equal_rows(df, few)) == [(1, "a"), (1, "a"), (2, None)]
    assert few.exceptAll(rows.equal_rows(df, few)).collect() == few.exceptAll(df).collect()


def test_cleaned_rows_move_without_names(spark, staging, few_tables, monkeypatch):
    """Sorted rows are those of the plain cleaning in date order, with and without the names put in behind the shuffle."""
    raw = fixtures.raw_sales(spark, few_tables)
    expected = rows_of(clean.clean_sales(raw, staging, row_id=fixtures.ROW_ID))
    moved = []
    plain = clean.sort_for_write
    monkeypatch.setattr(clean, "sort_for_write", lambda df, *given, **named: moved.append(df.columns) or plain(df, *given, **named))
    late = staging.put(clean.sorted_sales(raw, staging, row_id=fixtures.ROW_ID), "late")
    monkeypatch.setattr(clean, "fits_broadcast", lambda df: False)
    early = clean.sorted_sales(raw, staging, row_id=fixtures.ROW_ID)
    assert rows_of(late) == rows_of(early) == expected and expected
    assert not {"sku", "category", "_sku", "_category", "fy", "grand_total"} & set(moved[0])
    assert {"_sku", "_category"} <= set(moved[1])
    for file in glob.glob(f"{staging.path}/*-late/*.parquet"):
        days = [row[0] for row in spark.read.parquet(file).select("created_at").collect()]
        assert days == sorted(days)


def test_fill_shuffles_the_history_once(spark, staging):
    """The written fills are what a second reader of the filled rows needs, not the history."""
    df = spark.range(50).select("id", F.when(F.col("id") % 5 == 1, F.col("id")).alias("v"))
    filled = ordering.forward_fill(df, "v", "id", staging=staging)
    assert rows_of(filled) == sorted([(n, (n - 1) // 5 * 5 + 1 if n else None) for n in range(50)], key=repr)
    assert "Window" not in filled._jdf.queryExecution().executedPlan().toString()


def test_raw_file_sorts_order_keys_only(spark, few_tables, monkeypatch):
    """Only keys are sorted over the whole table; ids count on without gaps from order to order."""
    sorted_columns = []
    plain = fixtures.sorted_row_ids
    monkeypatch.setattr(fixtures, "sorted_row_ids", lambda df, *given: sorted_columns.append(df.columns) or plain(df, *given))
    fixtures._files.clear()
    ids = sorted({row[0] for row in fixtures.messy_sales(spark, few_tables).select(fixtures.ROW_ID).collect()})
    assert sorted_columns == [["l_orderkey", "_lines"]]
    lines = fixtures.read_table(spark, few_tables, "lineitem").where("l_orderkey is not null").select("l_orderkey").collect()
    met = sorted(row[0] for row in lines)
    assert ids == [place + 1 for place, key in enumerate(met) if key < 8 and key != 0]


def test_facts_and_rejects_are_stored_small(spark, few_tables):
    """Staged rows and facts of a batch are written in the codec of full rows."""
    house = queries.warehouse(spark, queries.WHOLE)
    house.run_batch(queries.cleaned_sales(spark, few_tables))
    written = [path for table in ("fact", "stag") for path in glob.glob(f"{house.root.removeprefix('file:')}/*{table}*/**/*.parquet", recursive=True)]
    assert len({path.split("/")[-2] for path in written}) == 2
    assert all(".zstd." in path for path in written)
