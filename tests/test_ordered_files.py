"""Raw files in the order of their ids, and files written from them without moving a row."""

import bisect
import glob

from pyspark.sql import functions as F

from conftest import rows_of
from salesdw.checks import fixtures, queries
from salesdw.operators import ordering
from salesdw.sources import files
from test_scale import few_tables  # noqa: F401


def test_range_of(spark):
    for bounds in ([5], [0, 3], [-4, 0, 7, 8, 20], list(range(0, 90, 3))):
        found = spark.range(-10, 100).select("id", ordering.range_of(F.col("id"), bounds).alias("place")).collect()
        assert [row.place for row in found] == [max(0, bisect.bisect_right(bounds, row.id) - 1) for row in found]


def test_each_raw_file_holds_one_range(spark, few_tables):  # noqa: F811
    """Also with a part that stands twice, whose copies of a line share its id, a line whose part is missing, and an order
    whose lines stand twice, each with an id of its own."""
    parts = spark.read.parquet(f"{few_tables}/part.parquet")
    own = parts.where("p_partkey != 4").unionByName(parts.where("p_partkey = 2").withColumn("p_name", F.lit("other")))
    own.write.parquet(f"{few_tables}/twice")
    spark.read.parquet(f"{few_tables}/twice").write.mode("overwrite").parquet(f"{few_tables}/part.parquet")
    lines = spark.read.parquet(f"{few_tables}/lineitem.parquet")
    lines.unionByName(lines.where("l_orderkey = 2")).write.parquet(f"{few_tables}/more")
    spark.read.parquet(f"{few_tables}/more").write.mode("overwrite").parquet(f"{few_tables}/lineitem.parquet")
    fixtures._files.clear()
    messy = fixtures.messy_sales(spark, few_tables)
    sources = {name: fixtures.read_table(spark, few_tables, name) for name in fixtures.SOURCES}
    assert rows_of(messy.drop(fixtures.ROW_ID)) == rows_of(spark.sql(fixtures.MESSY_SQL, **sources))
    spans = []
    for path in {row[0] for row in messy.select("_metadata.file_path").collect()}:
        file = spark.read.parquet(path)
        keys = [tuple(row) for row in file.select(*fixtures.ORDER).collect()]
        assert keys == sorted(keys)
        ids = [row[0] for row in file.select(fixtures.ROW_ID).collect()]
        spans.append((min(ids), max(ids)))
    spans.sort()
    assert len(spans) > 3 and all(left[1] < right[0] for left, right in zip(spans, spans[1:]))
    ordered = [tuple(row) for row in messy.orderBy(fixtures.ROW_ID).select(*fixtures.ORDER).collect()]
    assert ordered == sorted(ordered)
    shared = messy.where("src_order != 5").groupBy(fixtures.ROW_ID, "src_part").count().select("src_part", "count").distinct()
    assert rows_of(shared) == [(part, 2 if part == 2 else 1) for part in range(4)]
    assert messy.where("src_order = 2 AND src_part = 2").count() >= 4


def test_ordered_files_move_no_row(spark, few_tables, tmp_path):  # noqa: F811
    """Paths in their order give the rows in the order of their ids, copies beside each other."""
    plans, path = [], f"{tmp_path}/ordered"

    def write(rows):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        rows.write.partitionBy(fixtures.RANGE).parquet(path)

    before = {name: spark.conf.get(name) for name in fixtures.WHOLE_FILES}
    assert fixtures.write_in_order(spark, few_tables, write) > 3
    assert "Exchange" not in plans[0] and {name: spark.conf.get(name) for name in fixtures.WHOLE_FILES} == before
    found = [row for file in sorted(glob.glob(f"{path}/**/*.parquet", recursive=True)) for row in spark.read.parquet(file).select("increment_id").collect()]
    raw = fixtures.raw_sales(spark, few_tables).orderBy(fixtures.ROW_ID).select("increment_id").collect()
    assert found == raw and len(raw) > 50
    lines = fixtures.messy_sales(spark, few_tables)
    assert len(raw) == lines.count() + lines.where("src_order % 101 = 0").count() + 10


def test_text_files_are_small_and_can_be_split(spark, few_tables, monkeypatch):  # noqa: F811
    seen = []
    stored = files.stored_bytes
    monkeypatch.setattr(files, "stored_bytes", lambda spark, path: seen.extend(glob.glob(f"{path}/**/*.csv*", recursive=True)) or stored(spark, path))
    found = queries.clean_sales_csv_order(spark, few_tables)
    assert len(seen) > 3 and all(name.endswith(".csv.bz2") for name in seen)
    assert rows_of(found) == rows_of(queries.clean_sales(spark, few_tables))


def test_scan_order_moves_no_full_row(spark, few_tables, monkeypatch):  # noqa: F811
    written = []
    plain = fixtures.write_in_order
    spy = lambda spark, sf_dir, write, others=None: plain(spark, sf_dir, lambda rows: written.append(rows) or write(rows), others)
    monkeypatch.setattr(queries, "write_in_order", spy)
    found = queries.clean_sales_scan_order(spark, few_tables)
    assert rows_of(found) == rows_of(queries.clean_sales(spark, few_tables))
    assert "Exchange" not in written[0]._jdf.queryExecution().executedPlan().toString()
