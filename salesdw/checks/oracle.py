"""The same queries as single DuckDB SELECTs over the given tables."""

from __future__ import annotations

from datetime import timedelta

from salesdw.checks.fixtures import ORDER, RAW_COLUMNS, duckdb_messy_sql, duckdb_raw_sql
from salesdw.checks.queries import BATCHES, INSPECTED, PLACE, YEARLY
from salesdw.schema import CLEANED_COLUMNS, DIMENSIONS, RENAMES, TABLES, UNUSED_COLUMNS, WINDOW_TABLE, Dimension

_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "date": "DATE"}


def _sql_type(spec: Dimension, column: str) -> str:
    return _TYPES[TABLES[spec.table][column].dataType.simpleString()]


def _quoted(names: list[str]) -> str:
    return ", ".join(f'"{name}"' for name in names)


_ORDER = ", ".join(ORDER)
_PLACE = ", ".join(PLACE)
_RENAMED = ", ".join(f'"{old}" AS {new}' for old, new in RENAMES.items())
_OTHERS = [name for name in RAW_COLUMNS if name not in RENAMES]
_REMAINING = [name for name in _OTHERS if name not in UNUSED_COLUMNS]
_LENIENT = (
    r"CASE WHEN regexp_matches(CAST({0} AS VARCHAR), '^\s*[+-]?\.\d+\s*$') THEN 0 ELSE "
    r"TRY_CAST(regexp_extract(CAST({0} AS VARCHAR), '^\s*([+-]?\d+)(?:\.\d*)?\s*$', 1) AS INTEGER) END"
)
_DAY = "CAST(try_strptime(created_at, '%m/%d/%Y') AS DATE)"

MESSY = f"messy AS ({duckdb_messy_sql()}),\nren AS (SELECT {_quoted(_OTHERS)}, {_RENAMED}, {_ORDER} FROM messy)"


def _messy(select: str) -> str:
    return f"WITH {MESSY}\n{select}"


def _cleaned_ctes(final: bool) -> str:
    """CTEs that end in ``cleaned``."""
    renamed_status = "replace(status, 'order_refunded', 'refund')"
    mode_source = "st" if final else "status"
    category = "coalesce(u.category_name_1, f.fill, 'N/A')"
    if final:
        category = f"replace({category}, chr(92) || 'N', 'NA')"
    label = "'FY' || CAST(y AS VARCHAR)"
    total = f"({_LENIENT.format('qty_ordered')}) * price - TRY_CAST(discount_amount AS DOUBLE)"
    sku_filter = " AND s1 NOT IN ('test-product', 'test-product-00', 'test_tcsconnect')" if final else ""
    item = "CAST(dense_rank() OVER (ORDER BY s1, c1) AS INTEGER) AS item_id_new" if final else "item_id"
    return f"""{duckdb_raw_sql()},
src AS (
  SELECT *, row_number() OVER (PARTITION BY {_quoted(RAW_COLUMNS)} ORDER BY {_ORDER}) AS copy_no
  FROM raw
  WHERE COALESCE({", ".join(f'CAST("{name}" AS VARCHAR)' for name in RAW_COLUMNS)}) IS NOT NULL
),
numbered AS (SELECT *, row_number() OVER (ORDER BY {_ORDER}) AS rid FROM src WHERE copy_no = 1),
dated AS (
  SELECT *, last_value({_DAY} IGNORE NULLS) OVER (ORDER BY rid ROWS UNBOUNDED PRECEDING) AS d FROM numbered
),
usable AS (
  SELECT *, {renamed_status} AS st,
    CASE WHEN "Year" IS NULL THEN CAST(year(d) AS INTEGER) ELSE CAST("Year" AS INTEGER) END AS y,
    CASE WHEN "Month" IS NULL THEN CAST(month(d) AS INTEGER) ELSE CAST("Month" AS INTEGER) END AS m
  FROM dated WHERE {_LENIENT.format("item_id")} IS NOT NULL
),
mode AS (
  SELECT {mode_source} AS v FROM usable WHERE {mode_source} IS NOT NULL
  GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1
),
fill AS (
  SELECT sku, arg_min(category_name_1, rid) AS fill FROM usable
  WHERE sku IS NOT NULL AND category_name_1 IS NOT NULL GROUP BY sku
),
filled AS (
  SELECT u.*, coalesce(u.sku, 'N/A') AS s1, {category} AS c1 FROM usable u LEFT JOIN fill f ON u.sku = f.sku
),
kept AS (SELECT * FROM filled WHERE "Customer ID" IS NOT NULL{sku_filter}),
cleaned AS (
  SELECT {"replace(s1, chr(34), '')" if final else "s1"} AS sku,
    coalesce(replace(st, chr(92) || 'N', (SELECT v FROM mode)), (SELECT v FROM mode)) AS status,
    d AS created_at, price, {_LENIENT.format("qty_ordered")} AS qty_ordered,
    {total if final else "TRY_CAST(grand_total AS DOUBLE)"} AS grand_total,
    c1 AS category, TRY_CAST(discount_amount AS DOUBLE) AS discount_amount, payment_method,
    "BI Status" AS bi_status, {_LENIENT.format('''replace(" MV ", ',', '')''')} AS mv, y AS year, m AS month,
    "Customer Since" AS customer_since,
    {label if final else f'coalesce("FY", {label})'} AS fy,
    "Customer ID" AS customer_id, {item}
  FROM kept
)"""


CLEANED = _cleaned_ctes(final=True)


def _cleaned(select: str, more: str = "") -> str:
    return f"WITH {CLEANED}{more}\n{select}"


def _source(spec: Dimension) -> str:
    """Key and attributes of the sales rows in the types of the dimension table."""
    named = [(spec.source_key, spec.key), *[(name, name) for name in spec.attributes]]
    return ", ".join(f"CAST({old} AS {_sql_type(spec, new)}) AS {new}" for old, new in named)


def _batch(batches: list[tuple]) -> str:
    cases = " ".join(
        f"WHEN created_at BETWEEN DATE '{start}' AND DATE '{end}' THEN {number}"
        for number, (start, end) in enumerate(batches)
    )
    return f"CASE {cases} END"


def _stable(spec: Dimension, batch: str = "0", name: str = "dim") -> str:
    """CTE ``name``: the dimension after all batches, with stable keys."""
    fields = ", ".join([spec.key, *spec.attributes])
    newest = ", ".join(["day DESC NULLS LAST", *[f"{a} DESC NULLS LAST" for a in spec.attributes]])
    return f""",
{name}_rows AS (SELECT {_source(spec)}, created_at AS day, {batch} AS batch FROM cleaned),
{name}_latest AS (
  SELECT *, row_number() OVER (PARTITION BY batch, {spec.key} ORDER BY {newest}) AS rn
  FROM {name}_rows WHERE batch IS NOT NULL
),
{name}_span AS (
  SELECT {fields}, batch, min(batch) OVER (PARTITION BY {spec.key}) AS first_batch,
    max(batch) OVER (PARTITION BY {spec.key}) AS last_batch
  FROM {name}_latest WHERE rn = 1
),
{name} AS (
  SELECT {fields},
    CAST(row_number() OVER (ORDER BY first_batch, {spec.key} NULLS FIRST) AS INTEGER) AS {spec.surrogate}
  FROM {name}_span WHERE batch = last_batch
)"""


def _rekeyed(spec: Dimension) -> str:
    fields = ", ".join([spec.key, *spec.attributes])
    order = ", ".join(f"{name} NULLS FIRST" for name in [spec.key, *spec.attributes])
    return f""",
members AS (SELECT DISTINCT {_source(spec)}, {_batch(list(BATCHES))} AS batch FROM cleaned),
keyed AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY batch ORDER BY {order}) AS INTEGER) AS k,
    max(batch) OVER (PARTITION BY {spec.key}) AS last_batch
  FROM members WHERE batch IS NOT NULL
),
dim AS (
  SELECT {fields}, k AS {spec.surrogate} FROM keyed WHERE {spec.key} IS NULL OR batch = last_batch
)"""


def _view(spec: Dimension) -> str:
    fields = [spec.key, *spec.attributes]
    order = ", ".join(f"{name} NULLS FIRST" for name in fields)
    return _cleaned(
        f"SELECT *, CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS {spec.surrogate} "
        f"FROM (SELECT DISTINCT {_source(spec)} FROM cleaned)"
    )


def _lookup_sql(spec: Dimension) -> str:
    return _cleaned(
        f"SELECT c.price, c.mv, c.{spec.source_key}, d.{spec.surrogate} FROM cleaned c "
        f"LEFT JOIN dim d ON c.{spec.source_key} IS NOT DISTINCT FROM d.{spec.key}",
        _stable(spec),
    )


def _batch_members(spec: Dimension, batch: str) -> str:
    """CTE: the distinct members of each batch, numbered from 1 in each."""
    order = ", ".join(f"{name} NULLS FIRST" for name in [spec.key, *spec.attributes])
    return f""",
{spec.table} AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY batch ORDER BY {order}) AS INTEGER) AS {spec.surrogate}
  FROM (SELECT DISTINCT {_source(spec)}, {batch} AS batch FROM cleaned)
)"""


def _fact_ctes(batch: str, typed: bool, rekey: bool = False) -> str:
    """CTEs that end in ``fact``; column ``batch`` numbers the windows from 0."""
    build = _batch_members if rekey else lambda spec, batch: _stable(spec, batch, spec.table)
    dims = "".join(build(spec, batch) for spec in DIMENSIONS)
    on = "c.batch = {0}.batch AND c.{1} = {0}.{2}" if rekey else "c.{1} IS NOT DISTINCT FROM {0}.{2}"
    joins = "\n".join(
        f"  LEFT JOIN {spec.table} ON " + on.format(spec.table, spec.source_key, spec.key) for spec in DIMENSIONS
    )
    money = "CAST(c.{0} AS DECIMAL(10,2)) AS {0}" if typed else "c.{0}"
    measures = [money.format(name) for name in ("price", "grand_total", "discount_amount", "mv")]
    keys = [spec.surrogate for spec in DIMENSIONS]
    return f"""{dims},
fact AS (
  SELECT {", ".join(measures)}, c.qty_ordered, {", ".join(keys)}, c.batch
  FROM (SELECT *, {batch} AS batch FROM cleaned) c
{joins}
  WHERE c.batch IS NOT NULL
)"""


_FACT_COLUMNS = ", ".join(
    ["price", "qty_ordered", "grand_total", "discount_amount", "mv", *[spec.surrogate for spec in DIMENSIONS]]
)
_WHOLE = _batch([(BATCHES[0][0], BATCHES[-1][1])])


def _run_windows(runs: int) -> list[tuple]:
    """The windows of the first yearly runs: the two fixed ones, then on from the day after."""
    windows = [(YEARLY.first_start, YEARLY.first_end), (YEARLY.second_start, YEARLY.second_end)]
    while len(windows) < runs:
        end = windows[-1][1]
        windows.append((end + timedelta(days=1), end + timedelta(days=YEARLY.step_days)))
    return windows[:runs]


def _incremental(runs: int, rekey: bool = False) -> str:
    return _cleaned(
        f"SELECT {_FACT_COLUMNS}, CAST(batch AS BIGINT) AS batch_id FROM fact",
        _fact_ctes(_batch(_run_windows(runs)), typed=True, rekey=rekey),
    )


def _overlapping(runs: int) -> str:
    """Windows that start on the last day of the one before, so that day's rows count in two batches."""
    windows = [(YEARLY.first_start, YEARLY.first_end), (YEARLY.second_start, YEARLY.second_end)]
    while len(windows) < runs:
        windows.append((windows[-1][1], windows[-1][1] + timedelta(days=YEARLY.step_days)))
    days = ", ".join(f"({n}, DATE '{start}', DATE '{end}')" for n, (start, end) in enumerate(windows))
    spread = f""",
spread AS (
  SELECT c.*, w.n AS window_no FROM cleaned c
  JOIN (VALUES {days}) w(n, low, high) ON c.created_at BETWEEN w.low AND w.high
)"""
    facts = _fact_ctes("window_no", typed=True).replace("FROM cleaned", "FROM spread")
    return _cleaned(f"SELECT {_FACT_COLUMNS}, CAST(batch AS BIGINT) AS batch_id FROM fact", spread + facts)


def _rejects() -> str:
    """Facts of one batch with dear prices; a price of 100 million or more is a reject."""
    dear = "CASE WHEN item_id_new % 7 = 0 THEN price * 1e6 ELSE price END"
    # The dimensions do not look at prices.
    ctes = _fact_ctes(_WHOLE, typed=False).replace(f"SELECT *, {_WHOLE} AS batch FROM cleaned) c", f"SELECT * REPLACE ({dear} AS price), {_WHOLE} AS batch FROM cleaned) c")
    unfit = "round(price, 2) >= 1e8"
    money = [f"CASE WHEN {unfit} THEN CAST({m} AS DOUBLE) ELSE CAST(CAST({m} AS DECIMAL(10,2)) AS DOUBLE) END AS {m}" for m in ("grand_total", "discount_amount", "mv")]
    keys = [f"CAST({spec.surrogate} AS DOUBLE) AS {spec.surrogate}" for spec in DIMENSIONS]
    price = f"CASE WHEN {unfit} THEN price ELSE CAST(TRY_CAST(price AS DECIMAL(10,2)) AS DOUBLE) END AS price"
    return _cleaned(
        f"SELECT {price}, CAST(qty_ordered AS DOUBLE) AS qty_ordered, {', '.join([*money, *keys])}, "
        f"CASE WHEN {unfit} THEN 'price does not fit' ELSE '' END AS reason FROM fact",
        ctes,
    )


_HISTORY = """history AS (
  SELECT DISTINCT CAST(year(o_orderdate) - 1994 AS BIGINT) AS id, make_date(year(o_orderdate), 1, 1) AS start_date,
    make_date(year(o_orderdate), 12, 31) AS incremental_date
  FROM orders
)"""


def _next(shift: int) -> str:
    return (
        f"WITH {_HISTORY} SELECT max(id) + 1 AS id, CAST(max(incremental_date) + {shift} AS DATE) AS start_date, "
        "CAST(max(incremental_date) + 365 AS DATE) AS incremental_date FROM history"
    )


# The tables' columns, written by hand from the definition of the warehouse.
_DECLARED = """
incremental_value_storage: id bigint, start_date date, incremental_date date
dimproducts: item_id int, sku string, category string, DimProductKey int
dimdate: created_at date, year int, month int, fy string, DimDateKey int
dimstatus: status string, DimStatusKey int
dimpaymentmethod: payment_method string, DimMethodKey int
dimbistatus: bi_status string, DimBiStatusKey int
dimcustomer: customer_id int, customer_since string, DimCustomerKey int
factsalestable: price decimal(10,2), qty_ordered int, grand_total decimal(10,2), discount_amount decimal(10,2),
 mv decimal(10,2), DimProductKey int, DimDateKey int, DimStatusKey int, DimMethodKey int, DimBiStatusKey int,
 DimCustomerKey int
"""


def _bootstrap() -> str:
    declared = [line.split(": ") for line in _DECLARED.strip().replace(",\n", ",").split("\n")]
    columns = ", ".join(
        f"('{table}', '{name}', '{kind}')"
        for table, fields in declared
        for name, kind in (field.split() for field in fields.split(", "))
    )
    counts = " UNION ALL ".join(
        f"SELECT '{table}', count(*) FROM {table}" for table in [*[spec.table for spec in DIMENSIONS]]
    )
    return _cleaned(
        f"""SELECT c.*, n.row_count FROM (VALUES {columns}) c(table_name, column_name, data_type)
JOIN (SELECT '{WINDOW_TABLE}' AS table_name, 1 AS row_count UNION ALL SELECT 'factsalestable', count(*) FROM fact
UNION ALL {counts}) n ON c.table_name = n.table_name""",
        _fact_ctes(_WHOLE, typed=True),
    )


def _named_views() -> str:
    batch = _batch(_run_windows(2))
    members = "".join(_batch_members(spec, batch) for spec in DIMENSIONS)
    parts = [
        f"SELECT '{spec.view}' AS view_name, count(*) AS row_count, CAST(sum({spec.surrogate}) AS BIGINT) AS total "
        f"FROM {spec.table} WHERE batch = 1"
        for spec in DIMENSIONS
    ]
    facts = (
        "SELECT 'view_fact_table', count(*), CAST(sum(qty_ordered) AS BIGINT) "
        f"FROM (SELECT *, {batch} AS batch FROM cleaned) WHERE batch = 1"
    )
    return _cleaned(" UNION ALL ".join([*parts, facts]), members)


def _schema_report() -> str:
    kinds = {"price": "double", "qty_ordered": "int", "grand_total": "double", "created_at": "date", "year": "int"}
    kinds |= {"discount_amount": "double", "mv": "int", "month": "int", "customer_id": "bigint", "item_id_new": "int"}
    return _cleaned(
        " UNION ALL ".join(
            f"SELECT '{name}' AS column_name, '{kinds.get(name, 'string')}' AS data_type, "
            f"count(*) FILTER ({name} IS NULL) AS null_count FROM cleaned"
            for name in CLEANED_COLUMNS
        )
    )


def _numbered(select: str) -> str:
    return _messy(select).replace(
        "FROM ren", f"FROM (SELECT *, row_number() OVER (ORDER BY {_ORDER}) AS rid FROM ren)"
    )


_FILL = (
    "SELECT sku, arg_min(category, rid) AS first_category FROM ren "
    "WHERE sku IS NOT NULL AND category IS NOT NULL GROUP BY sku"
)
_USABLE = f"FROM (SELECT *, replace(status, 'order_refunded', 'refund') AS st FROM ren WHERE {_LENIENT.format('item_id')} IS NOT NULL)"
_TOP_OTHERS = sorted(name for name in CLEANED_COLUMNS if name != "created_at")
_NULL_COLUMNS = [*_REMAINING, *RENAMES.values()]


def all_sql() -> dict[str, str]:
    sql = {
        "src_csv_inferred": _messy(
            "SELECT item_id, status, created_at, sku, category, payment_method, bi_status, mv, fy, price, "
            "CAST(qty_ordered AS INTEGER) AS qty_ordered, CAST(grand_total AS INTEGER) AS grand_total, year, month, "
            "customer_id, CAST(discount_amount AS INTEGER) AS discount_amount, "
            "CAST(increment_id AS INTEGER) AS increment_id FROM ren"
        ),
        "src_csv_malformed": (
            "SELECT CASE WHEN b IS NULL THEN l_orderkey END AS l_orderkey, CASE WHEN b IS NULL THEN l_linenumber END AS "
            "l_linenumber, CASE WHEN b IS NULL THEN l_returnflag END AS l_returnflag, b AS record, TRUE AS placed FROM ("
            "SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_returnflag, "
            "CASE WHEN l_orderkey % 97 = 1 THEN l_orderkey || ',' || l_linenumber "
            "WHEN l_orderkey % 89 = 2 THEN l_orderkey || ',' || l_linenumber || ',' || l_returnflag || ',more' "
            "WHEN l_orderkey % 83 = 3 THEN 'x' || l_orderkey || ',' || l_linenumber || ',' || l_returnflag END AS b FROM lineitem)"
        ),
        "scan_table": _cleaned("SELECT * FROM cleaned"),
        "sorted_write": _cleaned("SELECT * FROM cleaned"),
        "sink_overwrite_roundtrip": _cleaned("SELECT customer_id, created_at, grand_total FROM cleaned"),
        "warehouse_bootstrap": _bootstrap(),
        "stage_window": _cleaned(
            "SELECT * FROM cleaned WHERE created_at BETWEEN (SELECT arg_max(start_date, id) FROM history) "
            "AND (SELECT arg_max(incremental_date, id) FROM history)",
            f",\n{_HISTORY}",
        ),
        "dropna_all": f"WITH {duckdb_raw_sql()} SELECT item_id, status, created_at, sku, increment_id FROM raw "
        "WHERE increment_id IS NOT NULL",
        "dedupe_rows": f"WITH {duckdb_raw_sql()} SELECT item_id, status, created_at, sku, increment_id, qty_ordered, "
        f"grand_total FROM (SELECT DISTINCT {_quoted(RAW_COLUMNS)} FROM raw)",
        "drop_columns": _messy(f"SELECT {_quoted(_REMAINING)}, {', '.join(RENAMES.values())}, {_ORDER} FROM ren"),
        "rename_columns": _messy(f"SELECT {_PLACE}, {', '.join(RENAMES.values())} FROM ren"),
        "fill_constant": _messy(
            f"SELECT {_PLACE}, coalesce(sku, 'N/A') AS sku, coalesce(category, 'N/A') AS category FROM ren"
        ),
        "parse_dates": _messy(f"SELECT {_PLACE}, {_DAY} AS created_at FROM ren"),
        "date_format_roundtrip": _messy(
            f"SELECT {_PLACE}, strftime({_DAY}, '%Y-%-m-%-d') AS date_text, {_DAY} AS date_again FROM ren"
        ),
        "fill_year_month": _messy(
            f"SELECT {_PLACE}, CAST(CASE WHEN year IS NULL THEN year({_DAY}) ELSE year END AS INTEGER) AS year, "
            f"CAST(CASE WHEN month IS NULL THEN month({_DAY}) ELSE month END AS INTEGER) AS month FROM ren"
        ),
        "fy_label": _messy(f"SELECT {_PLACE}, 'FY' || CAST(year AS VARCHAR) AS fy FROM ren"),
        "fy_label_null_only": _messy(
            f"SELECT {_PLACE}, coalesce(fy, 'FY' || CAST(coalesce(year, 1994) AS VARCHAR)) AS fy FROM ren"
        ),
        "lenient_casts": _messy(
            f"SELECT {_PLACE}, {_LENIENT.format('item_id')} AS item_id, {_LENIENT.format('qty_ordered')} AS "
            "qty_ordered, TRY_CAST(grand_total AS DOUBLE) AS grand_total, TRY_CAST(mv AS DOUBLE) AS mv FROM ren"
        ),
        # What each planted form of a whole number q stands for: q, -q, nothing, q, q billions, 0, q.
        "lenient_casts_edge": (
            "SELECT l_orderkey, l_linenumber, CAST(CASE l_linenumber WHEN 2 THEN -q WHEN 3 THEN NULL "
            "WHEN 5 THEN CASE WHEN q <= 2 THEN q * 1000000000 END WHEN 6 THEN 0 ELSE q END AS INTEGER) AS whole "
            "FROM (SELECT l_orderkey, l_linenumber, CAST(floor(l_quantity) AS BIGINT) AS q FROM lineitem)"
        ),
        "recompute_total": _messy(
            f"SELECT {_PLACE}, ({_LENIENT.format('qty_ordered')}) * price - TRY_CAST(discount_amount AS DOUBLE) "
            "AS grand_total FROM ren"
        ),
        "filter_castable": _messy(
            f"SELECT {_PLACE}, item_id FROM ren WHERE {_LENIENT.format('item_id')} IS NOT NULL"
        ),
        "filter_uncastable": _messy(f"SELECT {_PLACE}, item_id FROM ren WHERE {_LENIENT.format('item_id')} IS NULL"),
        "filter_not_null": _messy(f"SELECT {_PLACE}, customer_id FROM ren WHERE customer_id IS NOT NULL"),
        "inspect_null_rows": _messy(f"SELECT {', '.join(INSPECTED)} FROM ren WHERE customer_id IS NULL"),
        "inspect_null_year": _messy("SELECT year, month, fy, customer_since, customer_id FROM ren WHERE year IS NULL"),
        "filter_not_in": _messy(
            f"SELECT {_PLACE}, coalesce(sku, 'N/A') AS sku FROM ren "
            "WHERE coalesce(sku, 'N/A') NOT IN ('test-product', 'test-product-00', 'test_tcsconnect')"
        ),
        "filter_in_with_null": _messy(
            f"SELECT {_PLACE}, sku, category FROM ren WHERE category IN (chr(92) || 'N', NULL)"
        ),
        "columns_agree_count": _messy(
            "SELECT count(*) AS total_rows, "
            'count(*) FILTER (created_at = "Working Date" OR "Working Date" IS NULL) AS matching_rows FROM messy'
        ),
        "normalise_status": _messy(f"SELECT {_PLACE}, replace(status, 'order_refunded', 'refund') AS status FROM ren"),
        "normalise_category": _messy(f"SELECT {_PLACE}, replace(category, chr(92) || 'N', 'NA') AS category FROM ren"),
        "strip_quotes": _messy(f"SELECT {_PLACE}, replace(sku, chr(34), '') AS sku FROM ren"),
        "strip_commas": _messy(
            f"SELECT {_PLACE}, replace(mv, ',', '') AS mv_text, {_LENIENT.format('''replace(mv, ',', '')''')} AS mv FROM ren"
        ),
        "mode_value": _messy(
            f"SELECT st AS status, count(*) AS count {_USABLE} WHERE st IS NOT NULL GROUP BY st "
            "ORDER BY 2 DESC, 1 LIMIT 1"
        ),
        "mode_fill_status": _messy(
            f"SELECT {_PLACE}, coalesce(replace(st, chr(92) || 'N', mode.v), mode.v) AS status {_USABLE}, "
            f"(SELECT st AS v {_USABLE} WHERE st IS NOT NULL GROUP BY st ORDER BY count(*) DESC, 1 LIMIT 1) mode"
        ),
        "first_per_group": _numbered(_FILL),
        "category_fill_by_sku": _numbered(
            f"SELECT {_PLACE}, u.sku, coalesce(u.category, f.first_category) AS category "
            f"FROM (SELECT * FROM ren) u LEFT JOIN ({_FILL}) f ON u.sku = f.sku"
        ),
        "null_profile": _messy(
            "SELECT "
            + ", ".join(f"count(*) FILTER ({name} IS NULL) AS {name}" for name in _NULL_COLUMNS)
            + " FROM ren"
        ),
        "row_count": _messy("SELECT count(*) AS row_count FROM messy"),
        "schema_report": _schema_report(),
        "distinct_1col": _cleaned("SELECT DISTINCT status FROM cleaned"),
        "distinct_ncol": _cleaned("SELECT DISTINCT created_at, year, month, fy FROM cleaned"),
        "row_id": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, row_number() OVER (ORDER BY "
        "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS place FROM lineitem",
        "forward_fill_dates": _messy(
            f"SELECT {_ORDER}, last_value({_DAY} IGNORE NULLS) OVER (ORDER BY {_ORDER} ROWS UNBOUNDED PRECEDING) "
            "AS created_at FROM ren"
        ),
        "dense_rank_item": _messy(
            f"SELECT *, CAST(dense_rank() OVER (ORDER BY sku, category) AS INTEGER) AS item_id_new FROM "
            f"(SELECT {_PLACE}, coalesce(sku, 'N/A') AS sku, coalesce(category, 'N/A') AS category FROM ren)"
        ),
        "ordered_projection": _messy("SELECT created_at, src_order FROM ren ORDER BY 1 NULLS FIRST, 2"),
        "topk_recent": _cleaned(
            "SELECT * FROM cleaned ORDER BY created_at DESC NULLS LAST, "
            + ", ".join(f"{name} NULLS FIRST" for name in _TOP_OTHERS)
            + " LIMIT 5"
        ),
        "watermark_current": f"WITH {_HISTORY} SELECT max(id) AS id, arg_max(start_date, id) AS start_date, "
        "arg_max(incremental_date, id) AS end_date FROM history",
        "watermark_next": _next(1),
        "watermark_next_overlap": _next(0),
        "view_fact": _cleaned(f"SELECT {_FACT_COLUMNS} FROM fact", _fact_ctes("0", typed=False)),
        "fact_append": _cleaned(
            f"SELECT {_FACT_COLUMNS}, CAST(batch AS BIGINT) AS batch_id FROM fact", _fact_ctes(_WHOLE, typed=True)
        ),
        "fact_append_rejects": _rejects(),
        "report_fact_by_date": _cleaned(
            f"SELECT {_FACT_COLUMNS}, d.* EXCLUDE (DimDateKey) FROM fact JOIN dimdate d USING (DimDateKey)",
            _fact_ctes(_WHOLE, typed=True),
        ),
        "clean_sales": _cleaned("SELECT * FROM cleaned"),
        "clean_sales_typed_dates": _cleaned("SELECT * FROM cleaned"),
        "clean_sales_all_text": _cleaned("SELECT * FROM cleaned"),
        "clean_sales_scan_order": _cleaned("SELECT * FROM cleaned"),
        "clean_sales_csv_order": _cleaned("SELECT * FROM cleaned"),
        "preview_limit": _cleaned(
            "SELECT 'rows' AS what, count(*) AS n FROM (SELECT * FROM cleaned LIMIT 5) UNION ALL SELECT 'foreign', "
            "count(*) FROM (SELECT * FROM (SELECT * FROM cleaned LIMIT 5) EXCEPT ALL SELECT * FROM cleaned)"
        ),
        "clean_sales_basic": f"WITH {_cleaned_ctes(final=False)}\nSELECT * FROM cleaned",
        "monthly_sales": _cleaned(
            "SELECT CAST(date_trunc('month', created_at) AS DATE) AS sales_month, status, count(*) AS row_count, "
            "CAST(sum(qty_ordered) AS BIGINT) AS qty_ordered, round(sum(grand_total), 2) AS grand_total FROM cleaned "
            f"WHERE created_at BETWEEN DATE '{YEARLY.first_start}' AND DATE '{YEARLY.first_end}' GROUP BY 1, 2"
        ),
    }
    for spec in DIMENSIONS:
        fields = ", ".join(spec.columns)
        sql[f"view_dim_{spec.name}"] = _view(spec)
        sql[f"lookup_{spec.name}"] = _lookup_sql(spec)
        sql[f"scd1_{spec.name}"] = _cleaned(f"SELECT {fields} FROM dim", _stable(spec, _batch(list(BATCHES))))
        sql[f"scd1_{spec.name}_rekey"] = _cleaned(f"SELECT {fields} FROM dim", _rekeyed(spec))
    for runs in (1, 2, 3):
        sql[f"incremental_run_{runs}"] = _incremental(runs)
    sql["incremental_run_2_rekey"] = sql["incremental_rerun_rekey"] = _incremental(2, rekey=True)
    sql["incremental_rerun"] = sql["incremental_run_2"]
    sql["incremental_rerun_lost_driver"] = sql["incremental_run_3"]
    sql["incremental_rerun_lost_driver_rekey"] = _incremental(3, rekey=True)
    sql["incremental_overlap_3"] = _overlapping(3)
    sql["named_views"] = _named_views()
    return sql
