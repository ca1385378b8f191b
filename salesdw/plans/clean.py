"""The cleaning plan: raw sales rows to the cleaned sales table.

The rows are numbered, deduplicated and date-parsed once, and that table is staged. Everything that
looks beyond one row (date fill, status mode, category per sku, item number) is then computed from a
few of its columns, and one pass over the full rows brings the results together:

* dates: only rows with a gap are joined to their fill;
* status: the mode is a one-row subquery;
* category and item number: one lookup in a table of the distinct (sku, category) pairs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from salesdw import functions as X
from salesdw.operators.aggregates import mode_value
from salesdw.operators.joins import fits_broadcast
from salesdw.operators.ordering import file_row_ids, forward_fill, number_rows
from salesdw.operators.rows import drop_empty_rows, first_of_copies, row_hash
from salesdw.schema import CLEANED_COLUMNS, NOT_AVAILABLE, RENAMES, TEST_SKUS, UNUSED_COLUMNS
from salesdw.sources.tables import overwrite_table, sort_for_write
from salesdw.staging import FULL_ROWS, Staging

ROW_ID = "_row_id"
# Whether the raw item id is a number; only then is the row of use.
USABLE = "_usable"


@dataclass(frozen=True)
class CleaningRules:
    """The steps in which the final and the exploration pass differ."""

    recompute_total: bool = True
    number_items: bool = True
    drop_test_skus: bool = True
    strip_quotes: bool = True
    replace_missing_category: bool = True
    relabel_fiscal_year: bool = True
    mode_after_rename: bool = True
    missing_category: str = X.columns.MISSING_CATEGORY


FINAL = CleaningRules()
EXPLORATION = CleaningRules(
    recompute_total=False,
    number_items=False,
    drop_test_skus=False,
    strip_quotes=False,
    replace_missing_category=False,
    relabel_fiscal_year=False,
    mode_after_rename=False,
)


def source_rows(raw: DataFrame, staging: Staging, row_id: str | None = None) -> DataFrame:
    """Distinct non-empty raw rows, wanted columns only, numbered in source order; the raw source is read once.

    ``row_id`` names a BIGINT column that gives the source order; without it files count in the order of their paths.
    Of equal rows the first is kept. Full rows are shuffled only where they may have a copy.
    """
    data = [name for name in raw.columns if name != row_id]
    rows = _prepared(drop_empty_rows(raw, data)).withColumn("_hash", row_hash(data))
    if row_id is None:
        rows = file_row_ids(rows, ROW_ID, staging)
    else:
        rows = staging.put(rows.withColumnRenamed(row_id, ROW_ID), "scanned", FULL_ROWS)
    return _tidy(first_of_copies(rows, data, ROW_ID, "_hash", staging))


def product_map(rows: DataFrame, staging: Staging, rules: CleaningRules = FINAL) -> DataFrame:
    """One row per distinct raw (sku, category): the filled category and, if wanted, the item number.

    A pair gets an item number when at least one of its rows is kept (see ``kept_rows``). The result is
    marked for broadcast when its measured size allows.
    """
    pairs = (
        rows.withColumn("_kept", F.col("customer_id").isNotNull() & _is_wanted_sku(rules))
        .groupBy("sku", "category")
        .agg(F.min(ROW_ID).alias("_first"), F.max("_kept").alias("_kept"))
    )
    known = pairs.filter(F.col("sku").isNotNull() & F.col("category").isNotNull())
    fills = known.groupBy("sku").agg(F.min_by("category", "_first").alias("_fill"))
    filled = F.coalesce("category", "_fill", F.lit(NOT_AVAILABLE))
    if rules.replace_missing_category:
        filled = X.replace_missing_category(filled, rules.missing_category)
    named = pairs.join(fills, "sku", "left").select(
        F.col("sku").alias("_raw_sku"),
        F.col("category").alias("_raw_category"),
        F.coalesce("sku", F.lit(NOT_AVAILABLE)).alias("_sku"),
        filled.alias("_category"),
        "_kept",
    )
    named = staging.put(named, "product-map")
    mark = F.broadcast if fits_broadcast(named) else (lambda df: df)
    if not rules.number_items:
        return mark(named.drop("_kept"))
    items = named.filter("_kept").select("_sku", "_category").distinct()
    numbered = number_rows(items, ["_sku", "_category"], "item_id_new", staging)
    numbered = numbered.withColumn("item_id_new", F.col("item_id_new").cast("int"))
    return mark(named.filter("_kept").drop("_kept").join(numbered, ["_sku", "_category"]))


def kept_rows(rows: DataFrame, rules: CleaningRules = FINAL) -> DataFrame:
    """Rows with a customer and without a test sku."""
    return rows.filter(F.col("customer_id").isNotNull() & _is_wanted_sku(rules))


def clean_sales(
    raw: DataFrame,
    staging: Staging,
    rules: CleaningRules = FINAL,
    row_id: str | None = None,
    keep_row_id: bool = False,
) -> DataFrame:
    """Clean the raw sales rows. With ``keep_row_id`` the unique source row id is kept as well."""
    rows, products = _narrow_rows(raw, staging, rules, row_id)
    pair = F.col("sku").eqNullSafe(F.col("_raw_sku")) & F.col("category").eqNullSafe(F.col("_raw_category"))
    cleaned = _finished(rows.join(products, pair, "left"), rules)
    return cleaned.select(*output_columns(rules), *([ROW_ID] if keep_row_id else []))


def sorted_sales(raw: DataFrame, staging: Staging, rules: CleaningRules = FINAL, row_id: str | None = None) -> DataFrame:
    """The cleaned rows in the order of the cleaned table (see ``sort_for_write``).

    A row is moved with its item number where that stands for sku and category and the table of the products is small
    enough for every task; the texts, the label of the year and the total are put in behind the shuffle.
    """
    rows, products = _narrow_rows(raw, staging, rules, row_id)
    pair = F.col("sku").eqNullSafe(F.col("_raw_sku")) & F.col("category").eqNullSafe(F.col("_raw_category"))
    rows = rows.join(products, pair, "left").drop("sku", "category", "_raw_sku", "_raw_category")
    names = None
    if rules.number_items:
        names = staging.put(products.select("item_id_new", "_sku", "_category").distinct(), "item-names")
        names = F.broadcast(names) if fits_broadcast(names) else None
    if names is not None:
        rows = rows.drop("_sku", "_category")

    def finish(ordered: DataFrame) -> DataFrame:
        named = ordered if names is None else ordered.join(names, "item_id_new", "left")
        return _finished(named, rules).select(*output_columns(rules), ROW_ID)

    return sort_for_write(rows, "created_at", ROW_ID, staging, finish=finish)


def _narrow_rows(raw: DataFrame, staging: Staging, rules: CleaningRules, row_id: str | None) -> tuple[DataFrame, DataFrame]:
    """The kept rows with what follows from other rows or from one of their columns alone, and the product map."""
    every_row = source_rows(raw, staging, row_id)
    usable = every_row.filter(USABLE)

    renamed = usable.withColumn("status", X.normalise_status(F.col("status")))
    mode = mode_value(renamed if rules.mode_after_rename else usable, "status").select("status").scalar()
    status = F.regexp_replace(X.normalise_status(F.col("status")), F.lit(X.columns.MISSING_PATTERN), mode)

    products = product_map(usable, staging, rules)
    rows = forward_fill(kept_rows(usable, rules), "created_at", ROW_ID, history=every_row, staging=staging)
    rows = rows.withColumns(
        {
            "status": F.coalesce(status, mode),
            "year": X.fill_from_date(F.col("year"), F.year("created_at")),
            "month": X.fill_from_date(F.col("month"), F.month("created_at")),
            "price": X.lenient_double(F.col("price")),
            "customer_id": F.col("customer_id").try_cast("bigint"),
            "qty_ordered": X.lenient_int(F.col("qty_ordered")),
            "grand_total": X.lenient_double(F.col("grand_total")),
            "discount_amount": X.lenient_double(F.col("discount_amount")),
            "mv": X.lenient_int(X.strip_commas(F.col("mv").cast("string"))),
        }
    )
    # What ``_finished`` makes anew is not carried.
    remade = [*(["fy"] if rules.relabel_fiscal_year else []), *(["grand_total"] if rules.recompute_total else [])]
    unused = [] if not rules.number_items else ["item_id"]
    return rows.drop(USABLE, *remade, *unused), products


def _finished(rows: DataFrame, rules: CleaningRules) -> DataFrame:
    """Sku and category of the product, the label of the year and the total."""
    rows = rows.withColumns(
        {
            "sku": X.strip_quotes(F.col("_sku")) if rules.strip_quotes else F.col("_sku"),
            "category": F.col("_category"),
            "fy": X.fiscal_label(F.col("year"), None if rules.relabel_fiscal_year else F.col("fy")),
        }
    )
    if rules.recompute_total:
        rows = rows.withColumn(
            "grand_total", X.total_amount(F.col("qty_ordered"), F.col("price"), F.col("discount_amount"))
        )
    return rows


def output_columns(rules: CleaningRules = FINAL) -> list[str]:
    """The exploration pass keeps the raw item id where the final pass adds a new one."""
    if rules.number_items:
        return list(CLEANED_COLUMNS)
    first, *others = CLEANED_COLUMNS[:-1]
    return [first, "item_id", *others]


def load_cleaned(
    raw: DataFrame,
    table: str,
    rules: CleaningRules = FINAL,
    row_id: str | None = None,
) -> None:
    """Clean and write the cleaned table, sorted by date for the incremental reads."""
    with Staging(raw.sparkSession) as staging:
        overwrite_table(sorted_sales(raw, staging, rules, row_id), table)


def _prepared(rows: DataFrame) -> DataFrame:
    # Sources with inferred types may have dates already; only text needs parsing.
    is_text = isinstance(rows.schema["created_at"].dataType, StringType)
    date = X.parse_date(F.col("created_at")) if is_text else F.col("created_at").cast("date")
    return rows.withColumns({"_date": date, USABLE: X.lenient_int(F.col("item_id")).isNotNull()})


def _tidy(rows: DataFrame) -> DataFrame:
    rows = rows.drop(*UNUSED_COLUMNS, "_hash").withColumnsRenamed(RENAMES)
    return rows.withColumn("created_at", F.col("_date")).drop("_date")


def _is_wanted_sku(rules: CleaningRules):
    if not rules.drop_test_skus:
        return F.lit(True)
    return ~F.coalesce("sku", F.lit(NOT_AVAILABLE)).isin(*TEST_SKUS)
