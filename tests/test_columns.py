from datetime import date

from pyspark.sql import functions as F

from salesdw import functions as X


def values(spark, texts, make):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, v string")
    return [row[0] for row in df.orderBy("i").select(make(F.col("v"))).collect()]


def test_lenient_numbers(spark):
    texts = ["1.5", " 1,950 ", "-", "3000000000", "-2.9", " 7 ", "", None, "#REF!"]
    assert values(spark, texts, X.lenient_int) == [1, None, None, None, -2, 7, None, None, None]
    assert values(spark, texts[:2] + ["-"], X.lenient_double) == [1.5, None, None]
    stripped = lambda v: X.lenient_int(X.strip_commas(v))
    assert values(spark, [" 1,950 ", "1,234,567", " - "], stripped) == [1950, 1234567, None]


def test_dates(spark):
    texts = ["7/1/2016", "07/01/2016", "7/1/16", "#REF!", None, "13/1/2016"]
    first = date(2016, 7, 1)
    assert values(spark, texts, X.parse_date) == [first, first, None, None, None, None]
    assert values(spark, ["7/1/2016"], lambda v: X.date_text(X.parse_date(v))) == ["2016-7-1"]


def test_text(spark):
    assert values(spark, ["order_refunded", "complete", None], X.normalise_status) == ["refund", "complete", None]
    assert values(spark, ["\\N", "a\\N", "N"], X.replace_missing_category) == ["NA", "aNA", "N"]
    assert values(spark, ["\\N"], lambda v: X.replace_missing_category(v, "N/A")) == ["N/A"]
    assert values(spark, ['"x"-"y"', "x"], X.strip_quotes) == ["x-y", "x"]


def test_calendar_and_total(spark):
    df = spark.createDataFrame(
        [(None, date(2016, 7, 1), None), ("2015", None, "FY15"), ("x", date(2016, 1, 1), None)],
        "raw string, day date, fy string",
    )
    year = X.fill_from_date(F.col("raw"), F.year("day"))
    assert [row[0] for row in df.select(year).collect()] == [2016, 2015, None]
    labels = df.select(X.fiscal_label(year), X.fiscal_label(year, F.col("fy"))).collect()
    assert [tuple(row) for row in labels] == [("FY2016", "FY2016"), ("FY2015", "FY15"), (None, None)]
    amounts = spark.createDataFrame([(2, 3.5, 1.0), (2, 3.5, None)], "q int, p double, d double")
    total = X.total_amount(F.col("q"), F.col("p"), F.col("d"))
    assert [row[0] for row in amounts.select(total).collect()] == [6.0, None]
