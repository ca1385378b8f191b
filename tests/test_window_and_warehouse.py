from dataclasses import replace
from datetime import date, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import SMALL, rows_of
from salesdw.checks.queries import YEARLY, cleaned_sales
from salesdw.operators.joins import DUPLICATE_KEYS, DuplicateSourceKeys
from salesdw.plans import dimension, views
from salesdw.plans.warehouse import SalesWarehouse
from salesdw.plans.window_state import LoadPolicy, current_window, next_window, rows_in_window
from salesdw.schema import CUSTOMER, DIMENSIONS, FACT_TABLE, PRODUCT, REJECTS_TABLE, STATUS, TABLES, WINDOW_TABLE
from salesdw.staging import Staging

STATE = "id long, start_date date, incremental_date date"


def windows(spark, policy, runs):
    state, found = spark.createDataFrame([], STATE), []
    for _ in range(runs):
        row = current_window(state, policy).first()
        found.append((row["start_date"], row["end_date"]))
        rows = [tuple(r) for r in state.collect()] + [tuple(next_window(state, policy).first())]
        state = spark.createDataFrame(rows, STATE)
    return found, [r["id"] for r in state.collect()]


def test_overlapping_windows(spark):
    found, ids = windows(spark, LoadPolicy(overlap=True), 5)
    assert found == [
        (date(2016, 1, 1), date(2016, 12, 31)),
        (date(2017, 1, 1), date(2017, 12, 31)),
        (date(2017, 12, 31), date(2018, 12, 31)),
        (date(2018, 12, 31), date(2019, 12, 31)),
        (date(2019, 12, 31), date(2020, 12, 30)),
    ]
    assert ids == [1, 2, 3, 4, 5]


def test_default_windows_touch_without_overlap(spark):
    found, _ = windows(spark, LoadPolicy(), 6)
    assert all(right[0] == left[1] + timedelta(days=1) for left, right in zip(found, found[1:]))


def test_window_bounds_reach_the_scan(spark, staging):
    cleaned = staging.put(cleaned_sales(spark, SMALL), "c")
    plan = rows_in_window(cleaned, date(1996, 1, 1), date(1996, 12, 31))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(created_at,1996-01-01)" in plan


def members(spark, keys):
    return spark.createDataFrame([(0, k, f"s{k}", "c") for k in keys], "dim int, item_id int, sku string, category string")


def upserted(spark, staging, current, keys):
    return dimension.upsert_stable([current], members(spark, keys), [PRODUCT], staging)[0]


def test_keys_are_stable(spark, staging):
    empty = spark.createDataFrame([], TABLES[PRODUCT.table])
    first = staging.put(upserted(spark, staging, empty, [10, 20]), "one")
    second = upserted(spark, staging, first, [20, 5])
    assert {row["item_id"]: row["DimProductKey"] for row in second.collect()} == {10: 1, 20: 2, 5: 3}
    again = upserted(spark, staging, staging.put(second, "two"), [20, 5])
    assert rows_of(again) == rows_of(second)


def test_only_new_members_are_numbered(spark, staging, monkeypatch):
    counts, plain = [], dimension.number_rows

    def counting(df, *rest):
        counts.append(df.count())
        return plain(df, *rest)

    monkeypatch.setattr(dimension, "number_rows", counting)
    empty = spark.createDataFrame([], TABLES[PRODUCT.table])
    first = staging.put(upserted(spark, staging, empty, [10, 20, None]), "one")
    second = upserted(spark, staging, first, [20, None])
    assert rows_of(second) == rows_of(first) and counts == [3, 0]


def test_all_dimensions_from_one_scan(spark, staging):
    """One pass over the staged rows, one shuffle of distinct members, one sort for all numbers."""
    staged = staging.put(cleaned_sales(spark, SMALL), "staged")
    members = dimension.distinct_members(staged, DIMENSIONS)
    plan = members._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1 and plan.count("Expand") == 1
    together = dimension.dimension_views(staged, DIMENSIONS, staging)
    for spec, view in zip(DIMENSIONS, together):
        alone = dimension.dimension_views(staged, [spec], staging)[0]
        assert view.columns == spec.columns and rows_of(view) == rows_of(alone)


def sales(spark, rows):
    return spark.createDataFrame(
        [(k, since, date(2016, 1, 1) + timedelta(days=day)) for k, since, day in rows],
        "customer_id long, customer_since string, created_at date",
    )


def test_the_latest_attribute_wins(spark):
    staged = sales(spark, [(1, "7/2016", 5), (1, "8/2016", 1), (2, None, 3), (2, "1/2016", 3), (None, "x", 1)])
    found = rows_of(dimension.latest_members(staged, [CUSTOMER]).drop("dim"))
    assert found == [(1, "7/2016"), (2, "1/2016"), (None, "x")]


def test_rekeyed_dimension(spark, staging):
    """A batch numbers from 1 again; a repeated key fails once the dimension has it."""
    empty = spark.createDataFrame([], TABLES[CUSTOMER.table])
    rekeyed = lambda current, rows: dimension.upsert_rekeyed([current], sales(spark, rows), [CUSTOMER], staging)[0]
    one = rekeyed(empty, [(1, "a", 1), (2, "b", 1)])
    two = rekeyed(staging.put(one, "one"), [(2, "c", 1), (3, "d", 1)])
    assert rows_of(two) == [(1, "a", 1), (2, "c", 1), (3, "d", 2)]
    with pytest.raises(PySparkException, match=DUPLICATE_KEYS):
        rekeyed(staging.put(two, "two"), [(2, "x", 1), (2, "y", 1)]).count()


@pytest.fixture
def house(spark, tmp_path):
    name = f"house_{tmp_path.name.replace('-', '_')}"
    result = SalesWarehouse(spark, name, str(tmp_path / "db"), YEARLY)
    result.bootstrap()
    yield result
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_three_runs(spark, house):
    cleaned = cleaned_sales(spark, SMALL)
    results = [house.run_batch(cleaned) for _ in range(3)]
    assert [r.batch_id for r in results] == [0, 1, 2]
    for result in results:
        expected = rows_in_window(cleaned, result.start, result.end).count()
        assert house.table(FACT_TABLE).filter(F.col("batch_id") == result.batch_id).count() == expected > 0
        assert result.rejected_values == dict.fromkeys(result.rejected_values, 0)
    facts = house.table(FACT_TABLE)
    for spec in DIMENSIONS:
        table = house.table(spec.table)
        assert table.select(spec.surrogate).distinct().count() == table.count()
        assert facts.join(table, spec.surrogate, "left_anti").count() == 0
    assert house.table(WINDOW_TABLE).count() == 3
    house.bootstrap()
    assert house.table(FACT_TABLE).count() == facts.count()


@pytest.mark.parametrize("rekey", [False, True])
def test_a_lost_batch_can_be_repeated(spark, house, monkeypatch, rekey):
    """The run dies before the window moves; dimensions and window are as before, and the next run succeeds."""
    house.policy = replace(house.policy, rekey=rekey)
    cleaned = cleaned_sales(spark, SMALL)
    house.run_batch(cleaned)
    others = [name for name in TABLES if name != FACT_TABLE]
    before = {name: rows_of(house.table(name)) for name in others}
    monkeypatch.setattr(house, "advance", lambda: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        house.run_batch(cleaned)
    assert {name: rows_of(house.table(name)) for name in others} == before
    lost = rows_of(house.table(FACT_TABLE))
    monkeypatch.undo()
    house.run_batch(cleaned)
    assert rows_of(house.table(FACT_TABLE)) == lost and house.table(WINDOW_TABLE).count() == 2


def test_values_that_do_not_fit_are_counted(spark, house):
    cleaned = cleaned_sales(spark, SMALL).withColumn(
        "price", F.when(F.col("customer_id") % 2 == 0, F.lit(1e9)).otherwise(F.col("price"))
    )
    before = house.window()
    with pytest.raises(PySparkException, match="price does not fit"):
        house.run_batch(cleaned)
    assert house.window() == before and house.table(FACT_TABLE).isEmpty()

    house.policy = replace(house.policy, null_unfit=True)
    result = house.run_batch(cleaned)
    expected = rows_in_window(cleaned, result.start, result.end).filter("price = 1e9").count()
    assert result.rejected_values["price"] == expected > 0
    assert house.table(FACT_TABLE).filter("price IS NULL").count() == expected


def test_tables(house):
    found = rows_of(house.describe())
    assert ("factsalestable", "price", "decimal(10,2)") in found and len({row[0] for row in found}) == 8
    assert len([row for row in found if row[0] == "factsalestable"]) == 11


def test_status_keys_survive_in_facts(spark, house):
    """Status totals by key lookup equal those of the staged rows."""
    cleaned = cleaned_sales(spark, SMALL)
    for _ in range(2):
        house.run_batch(cleaned)
    totals = house.table(FACT_TABLE).join(house.table(STATUS.table), "DimStatusKey").groupBy("status").count()
    expected = rows_in_window(cleaned, date(1995, 1, 1), date(1996, 12, 31)).groupBy("status").count()
    assert rows_of(totals) == rows_of(expected)


def test_views(spark, house):
    cleaned = cleaned_sales(spark, SMALL)
    house.run_batch(cleaned)
    house.create_views()
    for spec in DIMENSIONS:
        assert house.table(spec.view).columns == spec.columns
    assert rows_of(house.table("view_dimstatus")) == rows_of(house.table(STATUS.table))
    assert house.table("view_fact_table").count() == house.table(FACT_TABLE).count()
    second = house.run_batch(cleaned)
    for spec in DIMENSIONS:  # the views follow without being made again
        view = dimension.dimension_views(house.table("stagging_table"), [spec], Staging(spark))[0]
        assert rows_of(house.table(spec.view)) == rows_of(view)
    assert house.table("view_fact_table").count() == rows_in_window(cleaned, second.start, second.end).count()


def test_keys_as_literals(spark):
    keys = ["it's", 'a "b" \\ c', "é日", "", date(2016, 2, 29), 7]
    row = spark.sql("SELECT " + ", ".join(map(views.literal, keys))).first()
    assert list(row) == keys


def test_rejected_rows_are_kept_whole(spark, house):
    house.policy = replace(house.policy, keep_unfit=True)
    cleaned = cleaned_sales(spark, SMALL).withColumn(
        "price", F.when(F.col("customer_id") % 2 == 0, F.lit(1e9)).otherwise(F.col("price"))
    )
    for _ in range(2):
        result = house.run_batch(cleaned)
        staged = rows_in_window(cleaned, result.start, result.end)
        facts, rejects = (house.table(t).where(F.col("batch_id") == result.batch_id) for t in (FACT_TABLE, REJECTS_TABLE))
        assert result.rejected_values["price"] == rejects.count() == staged.where("price = 1e9").count() > 0
        assert facts.count() + rejects.count() == staged.count() and facts.where("price IS NULL").isEmpty()
        assert rejects.select("reason").distinct().collect()[0][0] == "price does not fit: 1.0E9"
        assert rejects.where("raw_qty_ordered IS NULL OR DimStatusKey IS NULL OR raw_price != 1e9").isEmpty()
    # A batch without such rows, run again over the last one's place.
    house.load_facts(1, None)
    assert house.table(REJECTS_TABLE).select("batch_id").distinct().count() == 2


def test_repeated_source_keys_fail_the_batch(spark, house):
    house.policy = replace(house.policy, rekey=True)
    cleaned = cleaned_sales(spark, SMALL)
    house.run_batch(cleaned)
    other = cleaned.withColumn("customer_since", F.concat("customer_since", F.col("month").cast("string")))
    before = {spec.table: rows_of(house.table(spec.table)) for spec in DIMENSIONS}
    with pytest.raises(DuplicateSourceKeys):
        house.run_batch(other)
    assert {spec.table: rows_of(house.table(spec.table)) for spec in DIMENSIONS} == before


def test_report_is_newest_first(spark, house):
    house.run_batch(cleaned_sales(spark, SMALL))
    dates = [row["created_at"] for row in house.facts_by_date().select("created_at").collect()]
    assert dates == sorted(dates, reverse=True) and len(dates) == house.table(FACT_TABLE).count()
