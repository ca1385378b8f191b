"""The raw sales rows used by the checks, derived from the given tables.

One SQL text serves both engines; only the quoting of names and of the table references differs.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesdw.operators.joins import broadcast_if_small
from salesdw.operators.ordering import range_of, sorted_row_ids, sum_before_places
from salesdw.staging import FULL_ROWS, TASK_ROWS, Staging, partitions_for

# Helper columns that give the source order; they are no data of the raw file.
ORDER = ["src_order", "src_line", "src_part", "src_supp", "src_price"]
# Rises with ORDER.
ROW_ID = "src_id"
# Column that tells the files of ordered rows apart; all its numbers have as many digits, so that paths sort like them.
RANGE = "part-range"
LOWEST_RANGE = 100_000
LEAST_FILES = 8
# With a high value for both a scan neither splits a file nor puts several in a task.
WHOLE_FILES = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")

RAW_COLUMNS = [
    "item_id",
    "status",
    "created_at",
    "sku",
    "price",
    "qty_ordered",
    "grand_total",
    "increment_id",
    "category_name_1",
    "sales_commission_code",
    "discount_amount",
    "payment_method",
    "Working Date",
    "BI Status",
    " MV ",
    "Year",
    "Month",
    "Customer Since",
    "M-Y",
    "FY",
    "Customer ID",
]

MESSY_SQL = """
SELECT
  CASE WHEN l.l_partkey % 53 = 7 THEN '#REF!' ELSE CAST(l.l_partkey AS STRING) END AS item_id,
  CASE WHEN l.l_orderkey % 43 = 1 THEN NULL
       WHEN l.l_orderkey % 47 = 1 THEN chr(92) || 'N'
       WHEN o.o_orderstatus = 'F' THEN 'order_refunded'
       WHEN o.o_orderstatus = 'O' THEN 'complete' ELSE 'canceled' END AS status,
  CASE WHEN l.l_orderkey % 67 = 3 THEN '#REF!' WHEN l.l_orderkey % 71 = 3 THEN NULL
       ELSE CAST(month(o.o_orderdate) AS STRING) || '/' || CAST(day(o.o_orderdate) AS STRING)
            || '/' || CAST(year(o.o_orderdate) AS STRING) END AS created_at,
  CASE WHEN l.l_partkey % 41 = 5 THEN NULL
       WHEN l.l_partkey % 59 = 5 THEN 'test-product'
       WHEN l.l_partkey % 37 = 5 THEN '"' || p.p_name || '-' || p.p_brand || '"'
       ELSE p.p_name || '-' || p.p_brand END AS sku,
  p.p_retailprice AS price,
  CAST(CAST(floor(l.l_quantity) AS INT) AS STRING) AS qty_ordered,
  CAST(CAST(floor(l.l_extendedprice) AS INT) AS STRING) AS grand_total,
  CAST(l.l_orderkey AS STRING) AS increment_id,
  CASE WHEN (l.l_orderkey + l.l_linenumber) % 29 = 2 THEN NULL
       WHEN l.l_partkey % 31 = 2 THEN chr(92) || 'N' ELSE p.p_type END AS category_name_1,
  CAST(NULL AS STRING) AS sales_commission_code,
  CAST(CAST(round(l.l_discount * 100, 0) AS INT) AS STRING) AS discount_amount,
  CASE WHEN l.l_orderkey % 61 = 4 THEN NULL ELSE o.o_orderpriority END AS payment_method,
  CASE WHEN l.l_orderkey % 73 = 9 THEN NULL
       ELSE CAST(month(o.o_orderdate) AS STRING) || '/' || CAST(day(o.o_orderdate) AS STRING)
            || '/' || CAST(year(o.o_orderdate) AS STRING) END AS `Working Date`,
  CASE l.l_returnflag WHEN 'A' THEN 'Net' WHEN 'R' THEN 'Gross' ELSE 'Valid' END AS `BI Status`,
  CASE WHEN l.l_linenumber = 7 THEN ' - '
       WHEN l.l_extendedprice >= 1000
       THEN CAST(CAST(floor(l.l_extendedprice / 1000) AS INT) AS STRING) || ','
            || lpad(CAST(CAST(floor(l.l_extendedprice) AS INT) % 1000 AS STRING), 3, '0')
       ELSE CAST(CAST(floor(l.l_extendedprice) AS INT) AS STRING) END AS ` MV `,
  CASE WHEN l.l_orderkey % 67 = 3 THEN NULL ELSE CAST(year(o.o_orderdate) AS INT) END AS `Year`,
  CASE WHEN l.l_orderkey % 67 = 3 THEN NULL ELSE CAST(month(o.o_orderdate) AS INT) END AS `Month`,
  CAST(1 + c.c_custkey % 12 AS STRING) || '/' || CAST(1990 + c.c_custkey % 5 AS STRING) AS `Customer Since`,
  CAST(month(o.o_orderdate) AS STRING) || '-' || CAST(year(o.o_orderdate) AS STRING) AS `M-Y`,
  CASE WHEN l.l_orderkey % 67 = 3 THEN NULL
       ELSE 'FY' || CAST(year(o.o_orderdate) % 100 AS STRING) END AS `FY`,
  CASE WHEN l.l_orderkey % 79 = 11 THEN NULL ELSE c.c_custkey END AS `Customer ID`,
  l.l_orderkey AS src_order, l.l_linenumber AS src_line, l.l_partkey AS src_part,
  l.l_suppkey AS src_supp, l.l_extendedprice AS src_price
FROM {lineitem} l
JOIN {orders} o ON l.l_orderkey = o.o_orderkey
JOIN {part} p ON l.l_partkey = p.p_partkey
JOIN {customer} c ON o.o_custkey = c.c_custkey
"""

SOURCES = ("lineitem", "orders", "part", "customer")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_files: dict[tuple[str, str], DataFrame] = {}


def messy_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw sales file: rows with planted dirt, plus the ORDER columns and a row id in that order.

    Written once per session and data folder, as the engine starts from a file. Lines are joined while they are narrow:
    with parts, then with orders, which have met their customers before; the plan is the same at every size and its
    partitions follow the lines. Of the lines only the order keys, each once with its count, are sorted over the whole
    table. Their running sums cut them into ranges of as many lines each, to which lines and orders are moved, so that
    each file holds one range in the order of its ids: a row id is the number of lines of smaller ranges plus the line's
    place in its range.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _files:
        staging = Staging(spark)
        sources = {name: read_table(spark, sf_dir, name) for name in SOURCES}
        keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
        used = sources["lineitem"].select(*keys, "l_quantity", "l_discount", "l_returnflag")
        total = used.count()
        used = used.where(F.col("l_orderkey").isNotNull())  # others meet no order
        counts = used.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("_lines"))
        placed = staging.put(sorted_row_ids(counts, ["l_orderkey"], "_place", partitions_for(spark, total)), "placed-orders")
        before = sum_before_places(placed, "_place", "_lines", "_before")
        ranges = max(LEAST_FILES, -(-total // TASK_ROWS))
        share = F.floor(F.col("_before") / F.lit(-(-total // ranges) or 1))
        starts = before.groupBy(share).agg(F.min("l_orderkey").alias("first"), F.min("_before").alias("before")).orderBy("first")
        starts = starts.select("first", "before").collect() or [(0, 0)]  # a row a range

        # Copies of a part repeat a line, whose id they share.
        copy = F.row_number().over(Window.partitionBy("p_partkey").orderBy("p_name"))
        products = sources["part"].select("p_partkey", "p_name", "p_brand", "p_type", "p_retailprice").withColumn("_copy", copy)
        products = staging.put(products, "parts")  # a window in the join would keep it from splitting hot parts
        lines = used.join(products.hint("merge"), F.col("l_partkey") == F.col("p_partkey"))
        orders = sources["orders"].select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
        customers = broadcast_if_small(sources["customer"].select("c_custkey"))
        orders = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))

        firsts = [first for first, _ in starts]
        lines = lines.withColumn("_range", range_of(F.col("l_orderkey"), firsts)).repartitionById(len(starts), "_range")
        orders = orders.withColumn("_order_range", range_of(F.col("o_orderkey"), firsts)).repartitionById(len(starts), "_order_range")
        # Both windows need the same sort. Of lines equal in all keys each shares its id with its own copies.
        so_far = (Window.unboundedPreceding, Window.currentRow)
        in_range = Window.partitionBy("_range").orderBy(*keys, "_copy")
        in_equals = Window.partitionBy("_range", *keys).orderBy("_copy")
        is_line = F.when(F.col("_copy") == 1, 1).otherwise(0)
        lines = lines.withColumn("_lines", F.sum(is_line).over(in_range.rowsBetween(*so_far)))
        lines = lines.withColumns({"_equals": F.sum(is_line).over(in_equals.rowsBetween(*so_far)), "_row": F.row_number().over(in_equals)})
        place = F.col("_lines") - F.col("_equals") + (F.col("_row") - 1) % F.col("_equals") + 1
        lines = lines.withColumn(ROW_ID, F.get(F.array(*[F.lit(n).cast("bigint") for _, n in starts]), F.col("_range")) + place)
        same = (F.col("_range") == F.col("_order_range")) & (F.col("l_orderkey") == F.col("o_orderkey"))
        joined = lines.join(orders.hint("merge"), same)
        select = MESSY_SQL[: MESSY_SQL.index("\nFROM ")].replace("SELECT", f"SELECT {ROW_ID},", 1)
        select = re.sub(r"\b[lopc]\.(?=[lopc]_)", "", select)  # one table has all columns
        _files[key] = staging.put(spark.sql(f"{select}\nFROM {{joined}}", joined=joined), "raw", FULL_ROWS)
    return _files[key]


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw columns and the row id, with copies of some rows and ten rows of nulls."""
    messy = messy_sales(spark, sf_dir)
    times = F.when(F.col("src_order") % 101 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    copied = messy.select(*[F.col(f"`{name}`") for name in messy.columns], F.explode(times).alias("_time")).drop("_time")
    nulls = [F.lit(None).cast(field.dataType).alias(field.name) for field in messy.schema]
    empty = spark.range(10).select(*nulls)
    return copied.unionByName(empty).select(*RAW_COLUMNS, ROW_ID)


def write_in_order(spark: SparkSession, sf_dir: str, write: Callable[[DataFrame], None], others: dict[str, Column] | None = None) -> int:
    """Give ``write`` the raw rows in files to be partitioned by ``others``, then by ``RANGE``; returns the ranges.

    Each file of ``messy_sales`` holds a range of ids, so a task that reads whole files and sorts them writes what
    follows the files of lower ranges: paths in their order give the rows in the order of their ids, those without one
    first, and none is moved.
    """
    lowest = messy_sales(spark, sf_dir).groupBy("_metadata.file_path").agg(F.min(ROW_ID).alias("first"))
    firsts = sorted(row["first"] for row in lowest.collect()) or [0]  # a row a file
    place = F.when(F.col(ROW_ID).isNull(), LOWEST_RANGE).otherwise(LOWEST_RANGE + 1 + range_of(F.col(ROW_ID), firsts)).cast("int")
    rows = raw_sales(spark, sf_dir).withColumns({**(others or {}), RANGE: place})
    names = [f"`{name}`" for name in [*(others or {}), RANGE]]
    before = {name: spark.conf.get(name) for name in WHOLE_FILES}
    try:
        for name in WHOLE_FILES:
            spark.conf.set(name, 1 << 40)
        write(rows.sortWithinPartitions(*names, ROW_ID).drop(ROW_ID))
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    return len(firsts)


def duckdb_messy_sql() -> str:
    return MESSY_SQL.replace("`", '"').format(**{name: name for name in SOURCES})


def duckdb_raw_sql() -> str:
    """CTE bodies for ``messy`` and ``raw``."""
    return f"""messy AS ({duckdb_messy_sql()}),
raw AS (
  SELECT * FROM messy
  UNION ALL SELECT * FROM messy WHERE src_order % 101 = 0
  UNION ALL SELECT m.* FROM range(10) r LEFT JOIN messy m ON FALSE
)"""
