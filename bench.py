"""Time the headline queries; prints one JSON line.

Each query runs once to warm up and twice (BENCH_RUNS) for the median; its result is consumed by Spark's
``noop`` sink. The raw file and the cleaned table are written before the clock starts, as they are the
inputs of the measured steps. ``plain`` holds the same work as ordinary one-partition window plans.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesdw import functions as X
from salesdw.checks.fixtures import ROW_ID, messy_sales
from salesdw.checks.queries import all_queries, cleaned_sales, fill_constant

HEADLINE = (
    "clean_sales",
    "sorted_write",
    "forward_fill_dates",
    "dense_rank_item",
    "category_fill_by_sku",
    "mode_fill_status",
    "dedupe_rows",
    "scd1_customer",
    "view_dim_product",
    "lookup_customer",
    "view_fact",
    "incremental_run_3",
)


def plain_forward_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = messy_sales(spark, sf_dir).withColumn("created_at", X.parse_date(F.col("created_at")))
    window = Window.orderBy(ROW_ID).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("created_at", F.last("created_at", True).over(window))


def plain_dense_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    rank = F.dense_rank().over(Window.orderBy("sku", "category"))
    return fill_constant(spark, sf_dir).withColumn("item_id_new", rank)


def seconds(query, spark: SparkSession, sf_dir: str, runs: int) -> float:
    times = []
    for _ in range(runs + 1):
        start = time.perf_counter()
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times[1:]), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("salesdw-bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        # One warehouse run generates more classes than the default cache of 100 holds.
        .config("spark.sql.codegen.cache.maxEntries", "3000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    messy_sales(spark, sf_dir)
    cleaned_sales(spark, sf_dir)
    named = all_queries()
    chosen = sys.argv[1:] or HEADLINE
    times = {name: seconds(named[name], spark, sf_dir, runs) for name in chosen}
    plain = {
        "forward_fill_dates": seconds(plain_forward_fill, spark, sf_dir, runs),
        "dense_rank_item": seconds(plain_dense_rank, spark, sf_dir, runs),
    }
    result = {
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "plain": plain,
        "sf": sf_dir.rsplit("sf", 1)[-1],
        "cores": int(cores),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
