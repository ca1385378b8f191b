import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows_of
from salesdw.operators import ordering


def gappy(spark, count=5000):
    """Ids with jumps and leading, scattered and long runs of nulls."""
    df = spark.range(count).select((F.col("id") * 7 + F.col("id") % 3 + 1).alias("id"))
    null = (F.col("id") < 200) | (F.col("id") % 11 < 5) | F.col("id").between(9000, 21000)
    return df.withColumn("v", F.when(~null, F.date_add(F.lit("2016-01-01"), (F.col("id") % 977).cast("int"))))


@pytest.mark.parametrize("bits", [(20, 23), (4, 3), (3, 2, 2), (6,), ()])
def test_previous_value_equals_plain_window(spark, bits):
    df = gappy(spark)
    window = Window.orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    plain = df.withColumn("p", F.last("v", True).over(window))
    assert rows_of(ordering.previous_value(df, "id", "v", "p", bits)) == rows_of(plain)


def test_forward_fill(spark, staging):
    df = gappy(spark)
    window = Window.orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    plain = df.withColumn("v", F.last("v", True).over(window))
    assert rows_of(ordering.forward_fill(df, "v", "id")) == rows_of(plain)
    some = df.filter("id % 5 = 0")
    assert rows_of(ordering.forward_fill(some, "v", "id", history=df)) == rows_of(plain.filter("id % 5 = 0"))


@pytest.mark.parametrize("partitions", [1, 8, 64])
def test_number_rows_equals_plain_window(spark, staging, partitions):
    """Nulls first, any number of sort partitions, one prefix holding most keys."""
    df = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("a"),
        F.when(F.col("id") % 97 != 0, F.col("id").cast("string")).alias("b"),
    ).distinct()
    plain = df.withColumn("n", F.row_number().over(Window.orderBy("a", "b")))
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert rows_of(ordering.number_rows(df, ["a", "b"], "n", staging)) == rows_of(plain)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)


def test_number_rows_of_nothing(spark, staging):
    assert ordering.number_rows(spark.range(0), ["id"], "n", staging).count() == 0


def test_dense_rank_rows(spark, staging):
    df = spark.range(3000).select(
        F.when(F.col("id") % 10 < 4, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 40)).alias("sku"),
        F.when(F.col("id") % 7 != 0, F.concat(F.lit("c"), F.col("id") % 5)).alias("category"),
        "id",
    )
    plain = df.withColumn("n", F.dense_rank().over(Window.orderBy("sku", "category")))
    assert rows_of(ordering.dense_rank_rows(df, ["sku", "category"], "n", staging)) == rows_of(plain)


def test_scan_ids_rise_from_one(spark):
    ids = [row["i"] for row in ordering.scan_row_ids(spark.range(100).repartition(4), "i").collect()]
    assert len(set(ids)) == 100 and min(ids) == 1


def test_rows_never_meet_in_one_task(spark, staging):
    """Only block rows, not the rows themselves, reach the one window without partitions."""
    df = staging.put(gappy(spark), "gappy")
    plan = ordering.forward_fill(df, "v", "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") == 1
    single = plan[plan.index("SinglePartition"):].split("\n")[1]
    assert "HashAggregate" in single and "_block1" in single


def test_file_row_ids_follow_the_paths(spark, staging, tmp_path):
    """A small file comes before a large one by its path, although Spark scans the large one first."""
    for name, low, high in (("2016", 0, 3), ("2017", 3, 50_000), ("2018", 50_000, 50_010)):
        spark.range(low, high, numPartitions=1).write.parquet(str(tmp_path / f"year={name}"))
    ids = ordering.file_row_ids(spark.read.parquet(str(tmp_path)).drop("year"), "n", staging)
    assert [row["id"] for row in ids.orderBy("n").collect()] == list(range(50_010))
    assert ids.select("n").distinct().count() == 50_010


def test_file_row_ids_without_files(spark, staging):
    df = spark.createDataFrame([(3,), (1,)], "a int").coalesce(1)
    assert [row["a"] for row in ordering.file_row_ids(df, "n", staging).orderBy("n").collect()] == [3, 1]
