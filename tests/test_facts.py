"""Facts whose dates stand in several rows, on rows of their own."""

from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from conftest import rows_of
from salesdw.plans import fact
from salesdw.schema import DATE, DIMENSIONS, FACT_TABLE, TABLES

SALES = (
    "price double, qty_ordered int, grand_total double, discount_amount double, mv int, "
    "item_id_new int, created_at date, status string, payment_method string, bi_status string, customer_id long"
)
TIMES = 6


@pytest.fixture
def staged(spark):
    rows = [(n + 0.25, n, n * 2.5, 0.0, n, n % 3, date(1996, 1, 1 + n % 2), "s", None if n % 4 == 0 else "p", "b", n % 5) for n in range(40)]
    return spark.createDataFrame(rows, SALES)


def members(spark):
    """Each date in several rows, as in the re-keyed form; the other keys once."""
    keys = {"item_id": range(3), "status": ["s"], "payment_method": ["p"], "customer_id": range(4)}
    keys |= {"bi_status": ["b"], "created_at": [date(1996, 1, d) for d in (1, 2) for _ in range(TIMES)]}
    found = {}
    for spec in DIMENSIONS:
        rows = [(key, *[None] * len(spec.attributes), place + 1) for place, key in enumerate(keys[spec.key])]
        found[spec.table] = spark.createDataFrame(rows, TABLES[spec.table])
    return found.__getitem__


def expected(staged):
    number = {date(1996, 1, d): range((d - 1) * TIMES + 1, d * TIMES + 1) for d in (1, 2)}
    customer = lambda key: key + 1 if key < 4 else None
    return [
        (r.price, r.qty_ordered, r.grand_total, r.item_id_new + 1, day, 1, 1 if r.payment_method else None, 1, customer(r.customer_id))
        for r in staged.collect()
        for day in number[r.created_at]
    ]


def found(facts):
    assert facts.schema.simpleString() == TABLES[FACT_TABLE].simpleString()
    money = [F.col(name).cast("double") if name in ("price", "grand_total") else name for name in facts.columns if name not in ("discount_amount", "mv")]
    return rows_of(facts.select(*money))


def test_measures_are_fitted_before_rows_are_multiplied(spark, staged):
    """One cast a staged row, in a projection below the lookup of the dates."""
    facts = fact.fact_rows(staged, members(spark), null_safe=False)
    assert found(facts) == sorted(expected(staged), key=repr)
    plan = facts._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "decimal(10,2)" in plan and "decimal(10,2)" not in plan[: plan.index("join")]


def test_many_facts_are_spread_before_rows_are_multiplied(spark, staged, monkeypatch):
    monkeypatch.setattr(fact, "TASK_FACTS", 20)
    facts = fact.fact_rows(staged, members(spark), null_safe=False)
    assert facts.rdd.getNumPartitions() == 40 * TIMES // 20
    assert found(facts) == sorted(expected(staged), key=repr)
    plan = facts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("RepartitionByExpression")
    monkeypatch.setattr(fact, "TASK_FACTS", 40 * TIMES)
    whole = fact.fact_rows(staged, members(spark), null_safe=False)
    assert "RepartitionByExpression" not in whole._jdf.queryExecution().optimizedPlan().toString()


def test_lost_values_are_counted_by_fact(spark, staged):
    dear = staged.withColumn("price", F.when(F.col("qty_ordered") % 10 == 0, 1e9).otherwise(F.col("price")))
    rejects = Observation()
    facts = fact.fact_rows(dear, members(spark), null_safe=False, rejects=rejects)
    assert facts.where("price IS NULL").count() == 4 * TIMES
    facts.write.format("noop").mode("overwrite").save()
    assert rejects.get == dict.fromkeys(fact.MEASURES, 0) | {"price": 4 * TIMES}
    with pytest.raises(PySparkException, match="price does not fit"):
        fact.fact_rows(dear, members(spark), null_safe=False).collect()


def test_dates_without_repeats_add_no_step(spark, staged, monkeypatch):
    monkeypatch.setattr(fact, "TASK_FACTS", 1)
    once = lambda table: members(spark)(table).dropDuplicates([DATE.key]) if table == DATE.table else members(spark)(table)
    facts = fact.fact_rows(staged, once, null_safe=False)
    assert facts.count() == 40 and "RepartitionByExpression" not in facts._jdf.queryExecution().optimizedPlan().toString()
