from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, rows_of
from salesdw.checks.fixtures import RAW_COLUMNS, ROW_ID, raw_sales
from salesdw.operators import rows
from salesdw.plans import clean
from salesdw.sources import files, tables


@pytest.fixture(scope="module")
def expected(spark):
    from salesdw.staging import Staging

    return rows_of(clean.clean_sales(raw_sales(spark, SMALL), Staging(spark), row_id=ROW_ID))


@pytest.mark.parametrize("partitions", [1, 64])
def test_result_does_not_depend_on_partitions(spark, staging, expected, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        shuffled = raw_sales(spark, SMALL).repartition(partitions)
        assert rows_of(clean.clean_sales(shuffled, staging, row_id=ROW_ID)) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)


def test_other_paths_beyond_the_broadcast_bounds(spark, staging, expected, monkeypatch):
    monkeypatch.setattr(rows, "fits_broadcast", lambda df: False)
    monkeypatch.setattr(clean, "fits_broadcast", lambda df: False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert rows_of(clean.clean_sales(raw_sales(spark, SMALL), staging, row_id=ROW_ID)) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_with_equal_hashes_are_compared(spark, staging, expected, monkeypatch):
    monkeypatch.setattr(rows.F, "xxhash64", lambda *columns: F.length(columns[0]).cast("bigint"))
    assert rows_of(clean.clean_sales(raw_sales(spark, SMALL), staging, row_id=ROW_ID)) == expected


def test_a_third_of_the_rows_are_copies(spark, staging, expected):
    raw = raw_sales(spark, SMALL)
    hot = raw.filter(F.col(ROW_ID) == raw.agg(F.min(ROW_ID)).first()[0])
    many = hot.select("*", F.explode(F.sequence(F.lit(1), F.lit(3000))).alias("_n")).drop("_n")
    assert rows_of(clean.clean_sales(raw.unionByName(many), staging, row_id=ROW_ID)) == expected


RAW = "item_id,status,created_at,sku,price,qty_ordered,grand_total,increment_id,category_name_1,sales_commission_code," \
    "discount_amount,payment_method,Working Date,BI Status, MV ,Year,Month,Customer Since,M-Y,FY,Customer ID,,,,,"
LINES = [
    "1,complete,7/1/2016,a,100,2,1,1,\\N,,10,cod,7/1/2016,Net,\"1,950\",2016,7,7-2016,7-2016,FY17,1,,,,,",
    "2,order_refunded,#REF!,a,50,1,1,2,,,0,,7/1/2016,Net, - ,,,7-2016,7-2016,,2,,,,,",
    "x,complete,7/3/2016,b,50,1,1,3,Books,,0,cod,7/1/2016,Net,1,2016,7,7-2016,7-2016,FY17,2,,,,,",
    "3,,,,50,1.5,1,4,,,0,cod,,Net,7,2016,7,7-2016,7-2016,FY17,3,,,,,",
    "4,\\N,7/4/2016,test-product,50,1,1,5,Soap,,0,cod,,Net,7,2016,7,7-2016,7-2016,FY17,3,,,,,",
    "5,complete,7/5/2016,c,50,1,1,6,Soap,,0,cod,,Net,7,2016,7,7-2016,7-2016,FY17,,,,,,",
    "1,complete,7/1/2016,a,100,2,1,1,\\N,,10,cod,7/1/2016,Net,\"1,950\",2016,7,7-2016,7-2016,FY17,1,,,,,",
    ",,,,,,,,,,,,,,,,,,,,,,,,,",
]


def test_the_source_is_read_once(spark, staging, tmp_path, monkeypatch):
    """Another number of splits after the plan was built loses no rows; the raw files may even be gone by then."""
    path = str(tmp_path / "raw")
    raw = raw_sales(spark, SMALL).repartitionByRange(3, ROW_ID).sortWithinPartitions(ROW_ID)
    raw.write.parquet(path)
    numbered = spark.read.parquet(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        source = clean.source_rows(numbered.drop(ROW_ID), staging)
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        for file in (tmp_path / "raw").iterdir():
            file.write_bytes(b"")
        given = clean.source_rows(raw_sales(spark, SMALL), staging, ROW_ID)
        names = [name for name in source.columns if name != clean.ROW_ID]
        assert rows_of(source.select(*names)) == rows_of(given.select(*names))
        order = [row["item_id"] for row in source.orderBy(clean.ROW_ID).select("item_id").collect()]
        assert order == [row["item_id"] for row in given.orderBy(clean.ROW_ID).select("item_id").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.fixture
def raw_file(tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text("\n".join([RAW, *LINES]) + "\n")
    return str(path)


def test_file_by_hand(spark, staging, raw_file):
    raw = files.read_sales(spark, raw_file)
    assert raw.columns == [*RAW_COLUMNS, "_c21", "_c22", "_c23", "_c24", "_c25"]
    cleaned = clean.clean_sales(raw, staging)
    found = {row["customer_id"]: row for row in cleaned.collect()}
    assert cleaned.count() == 3 and set(found) == {1, 2, 3}
    assert found[1]["mv"] == 1950 and found[1]["grand_total"] == 190.0 and found[1]["fy"] == "FY2016"
    assert found[1]["category"] == "NA" and found[2]["category"] == "NA"
    assert found[2]["status"] == "refund" and found[2]["created_at"] == date(2016, 7, 1)
    assert found[2]["year"] == 2016 and found[2]["month"] == 7 and found[2]["mv"] is None
    # The date comes from a row that is itself dropped for its item id; quantity is cut, not rounded.
    assert found[3]["created_at"] == date(2016, 7, 3) and found[3]["qty_ordered"] == 1
    assert found[3]["sku"] == "N/A" and found[3]["category"] == "N/A" and found[3]["status"] == "complete"
    assert {row["item_id_new"] for row in found.values()} == {1, 2}


def test_all_text_schema_gives_the_same(spark, staging, raw_file):
    from pyspark.sql import types as T

    inferred = files.read_sales(spark, raw_file)
    schema = T.StructType([T.StructField(name, T.StringType()) for name in inferred.columns])
    text = files.read_sales(spark, raw_file, schema=schema)
    text = text.withColumn("price", F.col("price").cast("double"))
    result = clean.clean_sales(text, staging).withColumn("customer_id", F.col("customer_id").cast("int"))
    again = clean.clean_sales(inferred, staging).withColumn("price", F.col("price").cast("double"))
    assert rows_of(result) == rows_of(again)


def test_exploration_pass(spark, staging, raw_file):
    cleaned = clean.clean_sales(files.read_sales(spark, raw_file), staging, clean.EXPLORATION)
    assert "item_id" in cleaned.columns and "item_id_new" not in cleaned.columns
    skus = {row["item_id"]: row for row in cleaned.collect()}
    assert set(skus) == {"1", "2", "3", "4"}
    assert skus["1"]["fy"] == "FY17" and skus["1"]["category"] == "\\N" and skus["1"]["grand_total"] == 1.0


def test_load_writes_sorted_files(spark, raw_file):
    spark.sql("CREATE DATABASE IF NOT EXISTS clean_test")
    clean.load_cleaned(raw_sales(spark, SMALL), "clean_test.sales", row_id=ROW_ID)
    table = spark.table("clean_test.sales")
    spans = (
        table.groupBy(F.input_file_name().alias("f"))
        .agg(F.min("created_at").alias("low"), F.max("created_at").alias("high"))
        .orderBy("low", "high")
        .collect()
    )
    assert all(left["high"] <= right["low"] for left, right in zip(spans, spans[1:]))
    assert table.columns == clean.output_columns()
    spark.sql("DROP DATABASE clean_test CASCADE")


def test_one_hot_date_is_spread(spark, staging):
    df = spark.range(40000).select(F.lit(date(2016, 7, 1)).alias("created_at"), F.col("id").alias("r"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        sorted_rows = tables.sort_for_write(df.repartition(4), "created_at", "r", staging)
        parts = sorted_rows.groupBy(F.spark_partition_id()).count()
        assert max(row["count"] for row in parts.collect()) < 20000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_sorted_write_computes_rows_once(spark, staging):
    """One evaluation of the full rows; the dates' counts need the date's columns only."""
    days = F.date_add(F.lit("2016-01-01"), (F.col("id") % 50).cast("int"))
    df = staging.put(spark.range(5000).select(F.when(F.col("id") % 9 > 0, days).alias("d"), F.col("id").alias("r"), "id"), "t")
    seen = spark.sparkContext.accumulator(0)
    counting = F.udf(lambda value: seen.add(1) or value, "bigint")
    rows_out = tables.sort_for_write(df.withColumn("id", counting.asNondeterministic()("id")), "d", "r", staging, 7)
    spans = [[row["d"] for row in part] for part in rows_out.rdd.glom().collect()]
    assert seen.value == 5000 and len(spans) == 7 and sum(map(len, spans)) == 5000
    flat = [(day is not None, day) for part in spans for day in part]
    assert flat == sorted(flat, key=lambda pair: (pair[0], pair[1] or date.min))
    assert max(map(len, spans)) < 2 * 5000 / 7


def test_full_rows_are_not_shuffled(spark, staging):
    """Rows without a copy and without a gap go from the scan to the result without an exchange."""
    plan = clean.clean_sales(raw_sales(spark, SMALL), staging, row_id=ROW_ID)
    text = plan._jdf.queryExecution().executedPlan().toString()
    for line in text.split("\n"):
        if "Exchange hashpartitioning" in line:
            assert "price" not in line
