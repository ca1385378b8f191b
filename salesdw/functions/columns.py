"""Column expressions for messy sales values.

Everything here is a built-in Spark expression, so it stays inside whole-stage code generation.
The ``try_`` forms keep ANSI mode on: bad text becomes null instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text forms found in the source data.
DATE_FORMAT = "M/d/yyyy"
MISSING_TEXT = "\\N"
MISSING_PATTERN = r"\\N"
REFUND_LONG = "order_refunded"
REFUND_SHORT = "refund"
# What a Java regular expression replacement makes of the text N\A.
MISSING_CATEGORY = "NA"


def parse_date(value: Column) -> Column:
    """DATE from month/day/year text; null for null or unreadable text."""
    return F.try_to_date(value, DATE_FORMAT)


def date_text(value: Column) -> Column:
    """Year-month-day text without leading zeros; casting it back to DATE gives the same date."""
    return F.date_format(value, "yyyy-M-d")


def lenient_int(value: Column) -> Column:
    """INT with the fraction cut off; null for text that is no plain number (no exponent) or is out of range."""
    whole = F.regexp_extract(value.cast("string"), r"^\s*([+-]?\d+)(?:\.\d*)?\s*$", 1).try_cast("int")
    # A text with digits before the point is never one without, so most texts need the first pattern only.
    text = F.coalesce(whole, F.when(value.cast("string").rlike(r"^\s*[+-]?\.\d+\s*$"), F.lit(0)))
    return F.when(F.typeof(value) == "string", text).otherwise(value.try_cast("int"))


def lenient_double(value: Column) -> Column:
    return value.try_cast("double")


def fill_from_date(raw: Column, from_date: Column) -> Column:
    """The calendar part taken from the date where the raw part is null, else the raw part as INT."""
    return F.when(raw.isNull(), from_date).otherwise(lenient_int(raw))


def fiscal_label(year: Column, current: Column | None = None) -> Column:
    """``FY`` and the year; with ``current`` given, only where that label is null."""
    label = F.concat(F.lit("FY"), year.cast("string"))
    return label if current is None else F.coalesce(current, label)


def normalise_status(status: Column) -> Column:
    return F.replace(status, F.lit(REFUND_LONG), F.lit(REFUND_SHORT))


def replace_missing_category(category: Column, token: str = MISSING_CATEGORY) -> Column:
    return F.replace(category, F.lit(MISSING_TEXT), F.lit(token))


def strip_quotes(value: Column) -> Column:
    return F.replace(value, F.lit('"'), F.lit(""))


def strip_commas(value: Column) -> Column:
    return F.replace(value, F.lit(","), F.lit(""))


def total_amount(quantity: Column, price: Column, discount: Column) -> Column:
    """quantity x price - discount; null when any part is null."""
    return quantity * price - discount
