"""One query per operator, over the whole given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesdw import functions as X
from salesdw.checks.fixtures import ORDER, RANGE, RAW_COLUMNS, ROW_ID, messy_sales, raw_sales, read_table, write_in_order
from salesdw.operators import aggregates, joins, ordering, rows
from salesdw.plans import clean, dimension, fact, quality, window_state
from salesdw.plans.warehouse import SalesWarehouse
from salesdw.plans.window_state import LoadPolicy
from salesdw.schema import (
    DATE,
    DIMENSIONS,
    FACT_TABLE,
    FACT_VIEW,
    NOT_AVAILABLE,
    REJECTS_TABLE,
    RENAMES,
    STATUS,
    TEST_SKUS,
    UNUSED_COLUMNS,
    WINDOW_TABLE,
    Dimension,
)
from salesdw.sources import files, tables
from salesdw.staging import FULL_ROWS, TASK_ROWS, Staging  # noqa: F401 (tests set TASK_ROWS here)

Query = Callable[[SparkSession, str], DataFrame]

# The order dates run from 1995 to 2001: yearly windows, and three batches that cover them all.
YEARLY = LoadPolicy(
    first_start=date(1995, 1, 1),
    first_end=date(1995, 12, 31),
    second_start=date(1996, 1, 1),
    second_end=date(1996, 12, 31),
)
YEARLY_REKEYED = replace(YEARLY, rekey=True)
WHOLE = LoadPolicy(first_start=date(1995, 1, 1), first_end=date(2001, 12, 31))
BATCHES = (
    (date(1995, 1, 1), date(1996, 12, 31)),
    (date(1997, 1, 1), date(1998, 12, 31)),
    (date(1999, 1, 1), date(2001, 12, 31)),
)
PLACE = ["src_order", "src_line", "src_part"]

_cleaned: dict[tuple[str, str], DataFrame] = {}


def cleaned_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned table, written once per session and data folder as the load would write it."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _cleaned:
        staging = Staging(spark)
        result = clean.sorted_sales(raw_sales(spark, sf_dir), staging, row_id=ROW_ID)
        _cleaned[key] = staging.put(result, "cleaned", FULL_ROWS)
    return _cleaned[key]


def renamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messy_sales(spark, sf_dir).withColumnsRenamed(RENAMES)


def src_csv_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of text, some of them short, long or with a broken number: the records read, and the lines rejected."""
    staging = Staging(spark)
    path = f"{staging.path}/lines"
    fields = [F.col(name).cast("string") for name in ("l_orderkey", "l_linenumber", "l_returnflag")]
    whole = F.concat_ws(",", *fields)
    line = (
        F.when(F.col("l_orderkey") % 97 == 1, F.concat_ws(",", *fields[:2]))
        .when(F.col("l_orderkey") % 89 == 2, F.concat(whole, F.lit(",more")))
        .when(F.col("l_orderkey") % 83 == 3, F.concat(F.lit("x"), whole))
        .otherwise(whole)
    )
    read_table(spark, sf_dir, "lineitem").select(line.alias("value")).write.text(path)
    schema = T.StructType().add("l_orderkey", "long").add("l_linenumber", "long").add("l_returnflag", "string")
    good, bad = files.read_and_reject(spark, path, schema, "row_id", staging, header=False)
    placed = F.col("source_file").startswith("part-") & (F.col("row_id") > 0)
    return good.select(*schema.names, F.lit(None).cast("string").alias("record"), F.lit(True).alias("placed")).unionByName(
        bad.select(*[F.lit(None).cast(schema[name].dataType).alias(name) for name in schema.names], "record", placed.alias("placed"))
    )


def warehouse(spark: SparkSession, policy: LoadPolicy) -> SalesWarehouse:
    """An empty warehouse of its own in the shared folder."""
    staging = Staging(spark)
    result = SalesWarehouse(spark, f"salesdw_{uuid.uuid4().hex}", staging.path, policy)
    result.bootstrap()
    return result


def scratch_table(spark: SparkSession, name: str) -> str:
    staging = Staging(spark)
    database = f"salesdw_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{staging.path}'")
    return f"{database}.{name}"


def window_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load-window table with one row for each order year."""
    years = read_table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year")).distinct()
    return years.select(
        (F.col("year") - 1994).cast("bigint").alias("id"),
        F.make_date("year", F.lit(1), F.lit(1)).alias("start_date"),
        F.make_date("year", F.lit(12), F.lit(31)).alias("incremental_date"),
    )


# --- sources, sinks, catalog


def src_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{Staging(spark).path}/sales.csv"
    raw = messy_sales(spark, sf_dir).select(*RAW_COLUMNS)
    keep_spaces = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    raw.write.options(header=True, **keep_spaces).csv(path)
    back = files.read_sales(spark, path, "csv").withColumnsRenamed(RENAMES)
    kinds = {"price": "double", "qty_ordered": "int", "grand_total": "int", "year": "int", "month": "int"}
    kinds |= {"customer_id": "bigint", "discount_amount": "int", "increment_id": "int"}
    texts = ["item_id", "status", "created_at", "sku", "category", "payment_method", "bi_status", "mv", "fy"]
    return back.select(*texts, *[F.col(name).cast(kind) for name, kind in kinds.items()])


def scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = scratch_table(spark, "sales_cleaned")
    tables.overwrite_table(cleaned_sales(spark, sf_dir), name)
    return tables.scan_table(spark, name)


def sink_overwrite_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overwrite a table with rows of another schema, read it back."""
    name = scratch_table(spark, "overwritten")
    cleaned = cleaned_sales(spark, sf_dir)
    tables.overwrite_table(cleaned.select("sku", "category"), name)
    tables.overwrite_table(cleaned.select("customer_id", "created_at", "grand_total"), name)
    return tables.scan_table(spark, name)


def sorted_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole cleaning load: clean, sort by date, write, read back."""
    name = scratch_table(spark, "sales_cleaned")
    clean.load_cleaned(raw_sales(spark, sf_dir), name, row_id=ROW_ID)
    return tables.scan_table(spark, name)


def warehouse_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column of the eight tables, with the rows each table has after one batch."""
    house = warehouse(spark, WHOLE)
    house.run_batch(cleaned_sales(spark, sf_dir))
    columns = house.describe()
    counts = None
    for name in [WINDOW_TABLE, *[spec.table for spec in DIMENSIONS], FACT_TABLE]:
        one = quality.row_count(house.table(name)).select(F.lit(name).alias("table_name"), "row_count")
        counts = one if counts is None else counts.unionByName(one)
    return columns.join(counts, "table_name")


def stage_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    window = window_state.current_window(window_history(spark, sf_dir)).first()
    return window_state.rows_in_window(cleaned_sales(spark, sf_dir), window["start_date"], window["end_date"])


# --- projection, filter, row cleaning


def dropna_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = rows.drop_empty_rows(raw_sales(spark, sf_dir).select(*RAW_COLUMNS))
    return kept.select("item_id", "status", "created_at", "sku", "increment_id")


def dedupe_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The form that the cleaning plan runs, on the staged raw rows with their hashes."""
    staging = Staging(spark)
    hashed = raw_sales(spark, sf_dir).withColumn("row_hash", rows.row_hash(RAW_COLUMNS))
    kept = rows.first_of_copies(staging.put(hashed, "hashed"), RAW_COLUMNS, ROW_ID, "row_hash", staging)
    return kept.select("item_id", "status", "created_at", "sku", "increment_id", "qty_ordered", "grand_total")


def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messy_sales(spark, sf_dir).drop(ROW_ID, *UNUSED_COLUMNS).withColumnsRenamed(RENAMES)


def rename_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return renamed(spark, sf_dir).select(*PLACE, *RENAMES.values())


def fill_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = renamed(spark, sf_dir).fillna({"sku": NOT_AVAILABLE, "category": NOT_AVAILABLE})
    return filled.select(*PLACE, "sku", "category")


def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messy_sales(spark, sf_dir).select(*PLACE, X.parse_date(F.col("created_at")).alias("created_at"))


def date_format_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = X.date_text(X.parse_date(F.col("created_at")))
    return messy_sales(spark, sf_dir).select(
        *PLACE, text.alias("date_text"), text.cast("date").alias("date_again")
    )


def fill_year_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = X.parse_date(F.col("created_at"))
    return renamed(spark, sf_dir).select(
        *PLACE,
        X.fill_from_date(F.col("year"), F.year(day)).alias("year"),
        X.fill_from_date(F.col("month"), F.month(day)).alias("month"),
    )


def fy_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return renamed(spark, sf_dir).select(*PLACE, X.fiscal_label(F.col("year")).alias("fy"))


def fy_label_null_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    year = F.coalesce("year", F.lit(1994))
    return renamed(spark, sf_dir).select(*PLACE, X.fiscal_label(year, F.col("fy")).alias("fy"))


def lenient_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return renamed(spark, sf_dir).select(
        *PLACE,
        X.lenient_int(F.col("item_id")).alias("item_id"),
        X.lenient_int(F.col("qty_ordered")).alias("qty_ordered"),
        X.lenient_double(F.col("grand_total")).alias("grand_total"),
        X.lenient_double(F.col("mv")).alias("mv"),
    )


def lenient_casts_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Integers from text with fractions, exponents, blanks, a bare point and values out of range, by line number."""
    number = F.col("l_quantity").cast("int").cast("string")
    forms = {
        1: F.concat(number, F.lit(".99999")),
        2: F.concat(F.lit("-"), number, F.lit(".99999")),
        3: F.concat(number, F.lit("e3")),
        4: F.concat(F.lit(" "), number, F.lit(" ")),
        5: F.concat(number, F.lit("000000000")),
        6: F.concat(F.lit("."), number),
    }
    text = F.concat(number, F.lit("."))
    for line, form in forms.items():
        text = F.when(F.col("l_linenumber") == line, form).otherwise(text)
    rows = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", text.alias("value"))
    return rows.select("l_orderkey", "l_linenumber", X.lenient_int(F.col("value")).alias("whole"))


def recompute_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = X.total_amount(
        X.lenient_int(F.col("qty_ordered")), F.col("price"), X.lenient_double(F.col("discount_amount"))
    )
    return messy_sales(spark, sf_dir).select(*PLACE, total.alias("grand_total"))


def filter_castable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.keep_castable(messy_sales(spark, sf_dir), "item_id").select(*PLACE, "item_id")


def filter_uncastable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.keep_uncastable(messy_sales(spark, sf_dir), "item_id").select(*PLACE, "item_id")


def filter_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return renamed(spark, sf_dir).filter(F.col("customer_id").isNotNull()).select(*PLACE, "customer_id")


INSPECTED = [
    "customer_id",
    "customer_since",
    "mv",
    "bi_status",
    "payment_method",
    "price",
    "qty_ordered",
    "discount_amount",
    "grand_total",
]


def inspect_null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.inspect_null_rows(renamed(spark, sf_dir), "customer_id", INSPECTED)


def inspect_null_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = ["year", "month", "fy", "customer_since", "customer_id"]
    return quality.inspect_null_rows(renamed(spark, sf_dir), "year", shown)


def filter_not_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = messy_sales(spark, sf_dir).fillna({"sku": NOT_AVAILABLE})
    return rows.exclude_values(filled, "sku", TEST_SKUS).select(*PLACE, "sku")


def filter_in_with_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rows.in_values(renamed(spark, sf_dir), "category", [X.columns.MISSING_TEXT, None])
    return found.select(*PLACE, "sku", "category")


def columns_agree_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.columns_agree_count(messy_sales(spark, sf_dir), "created_at", "Working Date")


def normalise_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messy_sales(spark, sf_dir).select(*PLACE, X.normalise_status(F.col("status")).alias("status"))


def normalise_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    category = X.replace_missing_category(F.col("category"))
    return renamed(spark, sf_dir).select(*PLACE, category.alias("category"))


def strip_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messy_sales(spark, sf_dir).select(*PLACE, X.strip_quotes(F.col("sku")).alias("sku"))


def strip_commas(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = X.strip_commas(F.col("mv"))
    return renamed(spark, sf_dir).select(*PLACE, value.alias("mv_text"), X.lenient_int(value).alias("mv"))


# --- aggregation and distinct


def _usable(spark: SparkSession, sf_dir: str) -> DataFrame:
    usable = rows.keep_castable(messy_sales(spark, sf_dir), "item_id")
    return usable.withColumn("status", X.normalise_status(F.col("status")))


def mode_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.mode_value(_usable(spark, sf_dir), "status")


def mode_fill_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.mode_fill(_usable(spark, sf_dir), "status").select(*PLACE, "status")


def first_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.first_per_group(renamed(spark, sf_dir), "sku", "category", ROW_ID, "first_category")


def category_fill_by_sku(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = renamed(spark, sf_dir)
    firsts = aggregates.first_per_group(source, "sku", "category", ROW_ID, "first_category")
    filled = joins.fill_from_group(source, "category", "sku", firsts, "first_category")
    return filled.select(*PLACE, "sku", "category")


def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_profile(drop_columns(spark, sf_dir).drop(*ORDER))


def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.row_count(messy_sales(spark, sf_dir))


def schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.schema_report(cleaned_sales(spark, sf_dir))


def distinct_1col(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimension.distinct_members(cleaned_sales(spark, sf_dir), [STATUS]).select("status")


def distinct_ncol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimension.distinct_members(cleaned_sales(spark, sf_dir), [DATE]).select("created_at", "year", "month", "fy")


# --- order-dependent


def row_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row of files that were written in order, with its place by the ids given at the scan."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    staging = Staging(spark)
    path = f"{staging.path}/ordered-lines"
    lines = read_table(spark, sf_dir, "lineitem").select(*keys)
    lines.repartitionByRange(8, *keys).sortWithinPartitions(*keys).write.option("header", True).csv(path)
    read = files.read_sales(spark, path, schema=lines.schema)
    ids = ordering.file_row_ids(read, "id", staging)
    return ordering.number_rows(ids, ["id"], "place", staging).drop("id")


def forward_fill_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = renamed(spark, sf_dir).withColumn("created_at", X.parse_date(F.col("created_at")))
    return ordering.forward_fill(source, "created_at", ROW_ID).select(*ORDER, "created_at")


def dense_rank_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = fill_constant(spark, sf_dir)
    ranked = ordering.dense_rank_rows(source, ["sku", "category"], "item_id_new", Staging(spark))
    return ranked.withColumn("item_id_new", F.col("item_id_new").cast("int"))


def ordered_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messy_sales(spark, sf_dir).select("created_at", "src_order").orderBy("created_at", "src_order")


def topk_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.newest_rows(cleaned_sales(spark, sf_dir), "created_at", 5)


def preview_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which rows a preview shows is open; how many, and how many of them are no rows of the table, is not."""
    cleaned = cleaned_sales(spark, sf_dir)
    shown = Staging(spark).put(cleaned.limit(5), "preview")
    # Only rows equal to a shown one can take part in the difference, so only these are moved.
    alike = rows.equal_rows(cleaned, shown)
    number = shown.agg(F.lit("rows").alias("what"), F.count("*").alias("n"))
    foreign = shown.exceptAll(alike).agg(F.lit("foreign").alias("what"), F.count("*").alias("n"))
    return number.unionByName(foreign)


# --- load window


def watermark_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_state.current_window(window_history(spark, sf_dir))


def watermark_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_state.next_window(window_history(spark, sf_dir))


def watermark_next_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_state.next_window(window_history(spark, sf_dir), LoadPolicy(overlap=True))


# --- dimensions and fact


def view_dimension(spec: Dimension) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return dimension.dimension_views(cleaned_sales(spark, sf_dir), [spec], Staging(spark))[0]

    return query


def _empty(spark: SparkSession, spec: Dimension) -> DataFrame:
    from salesdw.schema import TABLES

    return spark.createDataFrame([], TABLES[spec.table])


def scd1(spec: Dimension, rekey: bool = False) -> Query:
    """The dimension after the three batches."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        staging = Staging(spark)
        current = _empty(spark, spec)
        for start, end in BATCHES:
            staged = window_state.rows_in_window(cleaned_sales(spark, sf_dir), start, end)
            if rekey:
                merged = dimension.upsert_rekeyed([current], staged, [spec], staging)
            else:
                merged = dimension.upsert_stable([current], dimension.latest_members(staged, [spec]), [spec], staging)
            current = staging.put(merged[0], spec.table)
        return current

    return query


def _one_batch(spark: SparkSession, sf_dir: str, specs, staging: Staging) -> dict[str, DataFrame]:
    """Some dimensions after one batch of everything, by table."""
    members = dimension.latest_members(cleaned_sales(spark, sf_dir), specs)
    built = dimension.upsert_stable([_empty(spark, spec) for spec in specs], members, specs, staging)
    return {spec.table: staging.put(one, spec.table) for spec, one in zip(specs, built)}


def lookup(spec: Dimension) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        built = _one_batch(spark, sf_dir, [spec], Staging(spark))[spec.table]
        sales = cleaned_sales(spark, sf_dir).select("price", "mv", spec.source_key)
        keys = joins.broadcast_if_small(joins.lookup_keys(built, spec.key, spec.surrogate))
        return joins.lookup(sales, keys, spec.source_key)

    return query


def view_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = Staging(spark)
    return fact.fact_view(cleaned_sales(spark, sf_dir), _one_batch(spark, sf_dir, DIMENSIONS, staging).__getitem__)


def fact_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    house = warehouse(spark, WHOLE)
    house.run_batch(cleaned_sales(spark, sf_dir))
    return house.table(FACT_TABLE)


def fact_append_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts and rejects of one batch in which some prices are beyond the fact table's decimals."""
    house = warehouse(spark, replace(WHOLE, keep_unfit=True))
    dear = F.when(F.col("item_id_new") % 7 == 0, F.col("price") * 1e6).otherwise(F.col("price"))
    house.run_batch(cleaned_sales(spark, sf_dir).withColumn("price", dear))
    names = [*fact.MEASURES, *[spec.surrogate for spec in DIMENSIONS]]
    facts = house.table(FACT_TABLE).select(*[F.col(n).cast("double").alias(n) for n in names], F.lit("").alias("reason"))
    own = [F.col(f"raw_{n}" if n in fact.MEASURES else n).cast("double").alias(n) for n in names]
    rejects = house.table(REJECTS_TABLE).select(*own, F.split("reason", ":")[0].alias("reason"))
    return facts.unionByName(rejects)


def report_fact_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    house = warehouse(spark, WHOLE)
    house.run_batch(cleaned_sales(spark, sf_dir))
    return house.facts_by_date()


def incremental_run(runs: int, policy: LoadPolicy = YEARLY) -> Query:
    """The fact table after some yearly batches."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        house = warehouse(spark, policy)
        for _ in range(runs):
            house.run_batch(cleaned_sales(spark, sf_dir))
        return house.table(FACT_TABLE)

    return query


def incremental_rerun(policy: LoadPolicy = YEARLY) -> Query:
    """Two yearly batches, the second of which is lost before its window moves and run again."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        house = warehouse(spark, policy)
        cleaned = cleaned_sales(spark, sf_dir)
        house.run_batch(cleaned)
        advance, house.advance = house.advance, _lose
        try:
            house.run_batch(cleaned)
        except BatchLost:
            house.advance = advance
        house.run_batch(cleaned)
        return house.table(FACT_TABLE)

    return query


def incremental_rerun_lost_driver(policy: LoadPolicy = YEARLY) -> Query:
    """Three yearly batches; the driver of the second dies when it has shown two of the six dimensions."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        house = warehouse(spark, policy)
        cleaned = cleaned_sales(spark, sf_dir)
        house.run_batch(cleaned)
        shown, point_to = [], house.point_to

        def dying(table: str, path: str) -> None:
            if len(shown) == 2:
                _lose()
            shown.append(table)
            point_to(table, path)

        house.point_to = dying
        try:
            house.run_batch(cleaned)
        except BatchLost:
            house = SalesWarehouse(spark, house.database, house.location, policy)
        house.run_batch(cleaned)
        return house.table(FACT_TABLE)

    return query


class BatchLost(RuntimeError):
    """Raised in place of the last step of a batch."""


def _lose() -> None:
    raise BatchLost


def named_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and sums of the seven views, made after the first batch and asked by name after the second."""
    house = warehouse(spark, YEARLY)
    house.run_batch(cleaned_sales(spark, sf_dir))
    house.create_views()
    house.run_batch(cleaned_sales(spark, sf_dir))
    sums = {spec.view: spec.surrogate for spec in DIMENSIONS} | {FACT_VIEW: "qty_ordered"}
    parts = [
        f"SELECT '{view}' AS view_name, count(*) AS row_count, CAST(sum({name}) AS BIGINT) AS total FROM {house.name(view)}"
        for view, name in sums.items()
    ]
    return spark.sql(" UNION ALL ".join(parts))


# --- whole cleaning


def clean_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_sales(raw_sales(spark, sf_dir), Staging(spark), row_id=ROW_ID)


def clean_sales_typed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a source whose dates are dates already."""
    raw = raw_sales(spark, sf_dir).withColumn("created_at", X.parse_date(F.col("created_at")))
    return clean.clean_sales(raw, Staging(spark), row_id=ROW_ID)


def clean_sales_all_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a source read with all columns as text."""
    raw = raw_sales(spark, sf_dir)
    text = raw.withColumns({name: F.col(f"`{name}`").cast("string") for name in RAW_COLUMNS})
    return clean.clean_sales(text, Staging(spark), row_id=ROW_ID)


def clean_sales_scan_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from files of very different sizes, each twice the one before, and without a row id."""
    staging = Staging(spark)
    path = f"{staging.path}/sales"
    piece = (F.lit(10) + F.floor(F.log2(F.coalesce(ROW_ID, F.lit(1))))).cast("int")  # of two digits
    write_in_order(spark, sf_dir, lambda rows: rows.write.partitionBy("piece", RANGE).parquet(path, compression=FULL_ROWS), {"piece": piece})
    return clean.clean_sales(files.read_sales(spark, path, "parquet").drop("piece", RANGE), staging)


def clean_sales_csv_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from text files of several splits each, without a row id. Of the codecs only bzip2 can be split."""
    staging = Staging(spark)
    path = f"{staging.path}/sales"
    options = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "compression": "bzip2"}
    parts = write_in_order(spark, sf_dir, lambda rows: rows.write.partitionBy(RANGE).options(**options).csv(path))
    text = T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", max(1 << 16, files.stored_bytes(spark, path) // (4 * parts)))
    try:
        source = files.read_sales(spark, path, schema=text).drop(RANGE)
        cleaned = staging.put(clean.clean_sales(source, staging), "cleaned", FULL_ROWS)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    return cleaned


def clean_sales_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_sales(raw_sales(spark, sf_dir), Staging(spark), clean.EXPLORATION, row_id=ROW_ID)


def monthly_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: clean, stage a year, load date and status dimensions, look up, total by month and status."""
    staging = Staging(spark)
    cleaned = staging.put(clean.clean_sales(raw_sales(spark, sf_dir), staging, row_id=ROW_ID), "cleaned")
    staged = window_state.rows_in_window(cleaned, YEARLY.first_start, YEARLY.first_end)
    facts = staged
    specs = (DATE, STATUS)
    members = dimension.latest_members(staged, specs)
    upserted = dimension.upsert_stable([_empty(spark, spec) for spec in specs], members, specs, staging)
    built = {spec: staging.put(one, spec.table) for spec, one in zip(specs, upserted)}
    for place, side in joins.broadcast_together([joins.lookup_keys(built[spec], spec.key, spec.surrogate) for spec in specs]):
        facts = joins.lookup(facts, side, specs[place].source_key)
    dates = built[DATE].select("DimDateKey", F.trunc("created_at", "month").alias("sales_month"))
    totals = facts.groupBy("DimDateKey", "DimStatusKey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("qty_ordered").alias("q"), F.sum("grand_total").alias("t")
    )
    return (
        totals.join(dates, "DimDateKey")
        .join(built[STATUS], "DimStatusKey")
        .groupBy("sales_month", "status")
        .agg(
            F.sum("n").alias("row_count"),
            F.sum("q").alias("qty_ordered"),
            F.round(F.sum("t"), 2).alias("grand_total"),
        )
    )


def all_queries() -> dict[str, Query]:
    plain = [
        src_csv_inferred,
        src_csv_malformed,
        scan_table,
        sink_overwrite_roundtrip,
        sorted_write,
        warehouse_bootstrap,
        stage_window,
        dropna_all,
        dedupe_rows,
        drop_columns,
        rename_columns,
        fill_constant,
        parse_dates,
        date_format_roundtrip,
        fill_year_month,
        fy_label,
        fy_label_null_only,
        lenient_casts,
        lenient_casts_edge,
        recompute_total,
        filter_castable,
        filter_uncastable,
        filter_not_null,
        inspect_null_rows,
        inspect_null_year,
        filter_not_in,
        filter_in_with_null,
        columns_agree_count,
        normalise_status,
        normalise_category,
        strip_quotes,
        strip_commas,
        mode_value,
        mode_fill_status,
        first_per_group,
        category_fill_by_sku,
        null_profile,
        row_count,
        schema_report,
        distinct_1col,
        distinct_ncol,
        row_id,
        forward_fill_dates,
        dense_rank_item,
        ordered_projection,
        topk_recent,
        preview_limit,
        watermark_current,
        watermark_next,
        watermark_next_overlap,
        view_fact,
        fact_append,
        fact_append_rejects,
        report_fact_by_date,
        named_views,
        clean_sales,
        clean_sales_typed_dates,
        clean_sales_all_text,
        clean_sales_scan_order,
        clean_sales_csv_order,
        clean_sales_basic,
        monthly_sales,
    ]
    named: dict[str, Query] = {query.__name__: query for query in plain}
    for spec in DIMENSIONS:
        named[f"view_dim_{spec.name}"] = view_dimension(spec)
        named[f"lookup_{spec.name}"] = lookup(spec)
        named[f"scd1_{spec.name}"] = scd1(spec)
        named[f"scd1_{spec.name}_rekey"] = scd1(spec, rekey=True)
    for runs in (1, 2, 3):
        named[f"incremental_run_{runs}"] = incremental_run(runs)
    named["incremental_run_2_rekey"] = incremental_run(2, YEARLY_REKEYED)
    named["incremental_rerun"] = incremental_rerun()
    named["incremental_rerun_rekey"] = incremental_rerun(YEARLY_REKEYED)
    named["incremental_rerun_lost_driver"] = incremental_rerun_lost_driver()
    named["incremental_rerun_lost_driver_rekey"] = incremental_rerun_lost_driver(YEARLY_REKEYED)
    named["incremental_overlap_3"] = incremental_run(3, replace(YEARLY, overlap=True))
    return named
