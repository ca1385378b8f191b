"""Names and types of the raw file, the cleaned table and the warehouse tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Raw column names as they stand in the source file.
UNUSED_COLUMNS = (
    "_c21",
    "_c22",
    "_c23",
    "_c24",
    "_c25",
    "Working Date",
    "sales_commission_code",
    "increment_id",
    "M-Y",
)
RENAMES = {
    "category_name_1": "category",
    "BI Status": "bi_status",
    " MV ": "mv",
    "Year": "year",
    "Month": "month",
    "FY": "fy",
    "Customer Since": "customer_since",
    "Customer ID": "customer_id",
}
TEST_SKUS = ("test-product", "test-product-00", "test_tcsconnect")
NOT_AVAILABLE = "N/A"

CLEANED_COLUMNS = (
    "sku",
    "status",
    "created_at",
    "price",
    "qty_ordered",
    "grand_total",
    "category",
    "discount_amount",
    "payment_method",
    "bi_status",
    "mv",
    "year",
    "month",
    "customer_since",
    "fy",
    "customer_id",
    "item_id_new",
)


@dataclass(frozen=True)
class Dimension:
    """One dimension: its table, its key in the sales rows, its attributes and its surrogate key."""

    name: str
    table: str
    source_key: str
    key: str
    attributes: tuple[str, ...]
    surrogate: str
    view: str

    @property
    def columns(self) -> list[str]:
        return [self.key, *self.attributes, self.surrogate]


# Names of tables, views and keys.
PRODUCT = Dimension("product", "dimproducts", "item_id_new", "item_id", ("sku", "category"), "DimProductKey", "view_dimproducts")
DATE = Dimension("date", "dimdate", "created_at", "created_at", ("year", "month", "fy"), "DimDateKey", "view_dimdates")
STATUS = Dimension("status", "dimstatus", "status", "status", (), "DimStatusKey", "view_dimstatus")
PAYMENT = Dimension("payment", "dimpaymentmethod", "payment_method", "payment_method", (), "DimMethodKey", "view_dimpaymentmethod")
BI_STATUS = Dimension("bi_status", "dimbistatus", "bi_status", "bi_status", (), "DimBiStatusKey", "view_dimbistatus")
CUSTOMER = Dimension("customer", "dimcustomer", "customer_id", "customer_id", ("customer_since",), "DimCustomerKey", "view_dimcustomer")

# In load order.
DIMENSIONS = (PRODUCT, DATE, STATUS, PAYMENT, BI_STATUS, CUSTOMER)

WINDOW_TABLE = "incremental_value_storage"
STAGE_TABLE = "stagging_table"
FACT_TABLE = "factsalestable"
FACT_VIEW = "view_fact_table"
BATCH_COLUMN = "batch_id"
REJECTS_TABLE = "rejected_sales"
PLACES_TABLE = "published_places"

MONEY = T.DecimalType(10, 2)


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Columns and types of the tables.
TABLES: dict[str, T.StructType] = {
    WINDOW_TABLE: _table(id=T.LongType(), start_date=T.DateType(), incremental_date=T.DateType()),
    PRODUCT.table: _table(
        item_id=T.IntegerType(), sku=T.StringType(), category=T.StringType(), DimProductKey=T.IntegerType()
    ),
    DATE.table: _table(
        created_at=T.DateType(),
        year=T.IntegerType(),
        month=T.IntegerType(),
        fy=T.StringType(),
        DimDateKey=T.IntegerType(),
    ),
    STATUS.table: _table(status=T.StringType(), DimStatusKey=T.IntegerType()),
    PAYMENT.table: _table(payment_method=T.StringType(), DimMethodKey=T.IntegerType()),
    BI_STATUS.table: _table(bi_status=T.StringType(), DimBiStatusKey=T.IntegerType()),
    CUSTOMER.table: _table(
        customer_id=T.IntegerType(), customer_since=T.StringType(), DimCustomerKey=T.IntegerType()
    ),
    FACT_TABLE: _table(
        price=MONEY,
        qty_ordered=T.IntegerType(),
        grand_total=MONEY,
        discount_amount=MONEY,
        mv=MONEY,
        DimProductKey=T.IntegerType(),
        DimDateKey=T.IntegerType(),
        DimStatusKey=T.IntegerType(),
        DimMethodKey=T.IntegerType(),
        DimBiStatusKey=T.IntegerType(),
        DimCustomerKey=T.IntegerType(),
    ),
}

# A row that the fact table cannot hold: its measures as they came, its keys, and what does not fit.
REJECTS = T.StructType(
    [
        *[
            T.StructField(f"raw_{field.name}" if not field.name.startswith("Dim") else field.name, T.DoubleType() if not field.name.startswith("Dim") else field.dataType)
            for field in TABLES[FACT_TABLE]
        ],
        T.StructField("reason", T.StringType()),
    ]
)
