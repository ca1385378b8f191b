"""The warehouse: tables, one incremental batch, and reports."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date
from functools import cached_property

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from salesdw.operators.joins import DUPLICATE_KEYS, DuplicateSourceKeys
from salesdw.plans import views
from salesdw.plans.dimension import latest_members, upsert_rekeyed, upsert_stable
from salesdw.plans.fact import MEASURES, fact_or_reject, fact_rows, fact_view, facts_by_date
from salesdw.plans.window_state import LoadPolicy, current_window, next_window, rows_in_window
from salesdw.schema import (
    BATCH_COLUMN,
    DIMENSIONS,
    FACT_TABLE,
    FACT_VIEW,
    PLACES_TABLE,
    REJECTS,
    REJECTS_TABLE,
    STAGE_TABLE,
    TABLES,
    WINDOW_TABLE,
)
from salesdw.sources.tables import overwrite_table
from salesdw.staging import FULL_ROWS, Staging, make_folder, side_by_side


@dataclass(frozen=True)
class BatchResult:
    batch_id: int
    start: date
    end: date
    rejected_values: dict[str, int]


class SalesWarehouse:
    """A star schema in one database of the session catalog, stored as Parquet."""

    def __init__(
        self,
        spark: SparkSession,
        database: str = "sales_dw",
        location: str | None = None,
        policy: LoadPolicy = LoadPolicy(),
    ):
        self.spark = spark
        self.database = database
        self.location = location
        self.policy = policy

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def bootstrap(self) -> None:
        """Create the database and its eight tables where they are missing.

        The fact table is partitioned by batch, so that a repeated batch replaces its own rows only. Two more tables
        serve the load: the rows that the fact table cannot hold, and the folders that each window has published.
        """
        place = f" LOCATION '{self.location}'" if self.location else ""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}{place}")
        for table, schema in TABLES.items():
            columns = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in schema)
            parted = f", {BATCH_COLUMN} bigint) USING PARQUET OPTIONS (compression '{FULL_ROWS}') PARTITIONED BY ({BATCH_COLUMN})"
            end = parted if table == FACT_TABLE else ") USING PARQUET"
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({columns}{end}")
        rejects = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in REJECTS)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name(REJECTS_TABLE)} ({rejects}{parted}")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name(PLACES_TABLE)} (table_name string, place string, id bigint) "
            "USING PARQUET PARTITIONED BY (id)"
        )

    def describe(self) -> DataFrame:
        """Table, column and type of every warehouse table."""
        rows = [
            (table, field.name, field.dataType.simpleString())
            for table in TABLES
            for field in self.table(table).schema
            if field.name != BATCH_COLUMN
        ]
        return self.spark.createDataFrame(rows, "table_name string, column_name string, data_type string")

    def place(self, table: str) -> str:
        return self._property(f"DESCRIBE FORMATTED {self.name(table)}", "Location")

    def write_idle(self, table: str, df: DataFrame) -> str:
        """Write ``df``, which may read the table, to the one of its two folders that is not in use."""
        idle = "b" if self.place(table).endswith(f"/{table}_a") else "a"
        path = f"{self.root}/{table}_{idle}"
        df.write.mode("overwrite").parquet(path)
        return path

    def point_to(self, table: str, path: str) -> None:
        self.spark.sql(f"ALTER TABLE {self.name(table)} SET LOCATION '{path}'")
        self.spark.catalog.refreshTable(self.name(table))

    def window(self) -> tuple[int, date, date]:
        row = current_window(self.table(WINDOW_TABLE), self.policy).first()
        return row["id"], row["start_date"], row["end_date"]

    def stage(self, cleaned: DataFrame) -> tuple[int, date, date]:
        """Put the rows of the current window into the staging table."""
        batch, start, end = self.window()
        overwrite_table(rows_in_window(cleaned, start, end), self.name(STAGE_TABLE))
        return batch, start, end

    def write_dimensions(self, staging: Staging) -> dict[str, str]:
        """The folders of the dimensions after this batch, by table; the tables still show those before."""
        staged = self.table(STAGE_TABLE)
        currents = [self.table(spec.table) for spec in DIMENSIONS]
        if self.policy.rekey:
            updated = upsert_rekeyed(currents, staged, DIMENSIONS, staging)
        else:
            updated = upsert_stable(currents, latest_members(staged, DIMENSIONS), DIMENSIONS, staging)
        tables = [spec.table for spec in DIMENSIONS]
        try:
            paths = side_by_side(lambda pair: self.write_idle(*pair), zip(tables, updated), self.spark)
        except PySparkException as error:
            if DUPLICATE_KEYS in str(error):
                raise DuplicateSourceKeys(str(error)) from error
            raise
        return dict(zip(tables, paths))

    def fact_view(self, written: dict[str, str] | None = None) -> DataFrame:
        """Fact rows of the staged batch, looked up in the tables or in the folders ``written`` for them."""
        return fact_view(self.table(STAGE_TABLE), self._members(written), null_safe=not self.policy.rekey)

    def _members(self, written: dict[str, str] | None) -> Callable[[str], DataFrame]:
        return lambda table: self.spark.read.schema(TABLES[table]).parquet(written[table]) if written else self.table(table)

    def load_facts(self, batch: int, written: dict[str, str] | None = None) -> dict[str, int]:
        """Write the facts of one batch over its partition; returns the values lost per column."""
        counted = self.policy.keep_unfit or self.policy.null_unfit
        rejects = Observation() if counted else None
        if self.policy.keep_unfit:
            self._load_both(batch, fact_or_reject(self.fact_view(written), rejects))
        else:
            facts = fact_rows(self.table(STAGE_TABLE), self._members(written), not self.policy.rekey, rejects)
            self.spark.sql(
                f"INSERT OVERWRITE TABLE {self.name(FACT_TABLE)} PARTITION ({BATCH_COLUMN} = {int(batch)}) "
                "SELECT * FROM {rows}",
                rows=facts,
            )
        return rejects.get if counted else dict.fromkeys(MEASURES, 0)  # a lost value has failed the batch

    def _load_both(self, batch: int, rows: DataFrame) -> None:
        """One write with two outputs: its folder of fitting rows is the batch's partition of the fact table, the other
        one that of the rejects."""
        path = f"{self.root}/loads/{batch}-{uuid.uuid4().hex}"
        rows.write.partitionBy("rejected").parquet(path, compression=FULL_ROWS)
        for table, rejected in ((FACT_TABLE, "false"), (REJECTS_TABLE, "true")):
            folder = f"{path}/rejected={rejected}"
            make_folder(self.spark, folder)  # without such rows there is none
            partition = f"PARTITION ({BATCH_COLUMN} = {int(batch)})"
            self.spark.sql(f"ALTER TABLE {self.name(table)} DROP IF EXISTS {partition}")
            self.spark.sql(f"ALTER TABLE {self.name(table)} ADD {partition} LOCATION '{folder}'")

    def publish(self, batch: int, places: dict[str, str]) -> None:
        """Note the folders of the next window, move the window, then show the folders.

        The one row that moves the window decides: before it the batch has not happened, after it ``recover`` can
        finish what is left.
        """
        values = ", ".join(f"('{table}', '{place}')" for table, place in places.items())
        self.spark.sql(f"INSERT OVERWRITE TABLE {self.name(PLACES_TABLE)} PARTITION (id = {int(batch) + 1}) VALUES {values}")
        self.advance()
        self.show(places)

    def show(self, places: dict[str, str]) -> None:
        for table, place in places.items():
            if self.place(table) != place:
                self.point_to(table, place)

    def recover(self) -> None:
        """Show the folders of the last window that was reached, where a driver has died before it had shown them all."""
        batch, _, _ = self.window()
        noted = self.table(PLACES_TABLE).where(F.col("id") == batch).collect()  # a row a dimension
        self.show({row["table_name"]: row["place"] for row in noted})

    def advance(self) -> None:
        self.spark.sql(
            f"INSERT INTO {self.name(WINDOW_TABLE)} (id, start_date, incremental_date) "
            "SELECT id, start_date, incremental_date FROM {step}",
            step=next_window(self.table(WINDOW_TABLE), self.policy),
        )

    def run_batch(self, cleaned: DataFrame) -> BatchResult:
        """Stage, write the six dimensions and the facts, then move the window and show the dimensions.

        All rows are written before the window moves and any dimension changes. So a batch that fails, or whose driver
        dies, before the window has moved starts again from the last finished one, in both forms of keys, and replaces
        what it has written. Later than that, the next batch begins by showing the dimensions the window stands for.
        """
        self.recover()
        batch, start, end = self.stage(cleaned)
        with Staging(self.spark) as staging:
            written = self.write_dimensions(staging)
            rejected = self.load_facts(batch, written)
        self.publish(batch, written)
        return BatchResult(batch, start, end, rejected)

    def create_views(self) -> None:
        """Create the seven named views in the database. They stay in the catalog and read its tables whenever they are
        asked, so they follow later batches by themselves."""
        staged = self.table(STAGE_TABLE)
        bounds = side_by_side(lambda spec: views.bucket_bounds(staged, spec), DIMENSIONS, self.spark)
        for spec, own in zip(DIMENSIONS, bounds):
            self._create_view(spec.view, views.dimension_select(spec, self.database, own))
        self._create_view(FACT_VIEW, views.fact_select(self.database, null_safe=not self.policy.rekey))

    def _create_view(self, view: str, select: str) -> None:
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(view)} AS {select}")

    def facts_by_date(self) -> DataFrame:
        return facts_by_date(self.table(FACT_TABLE).drop(BATCH_COLUMN), self.table("dimdate"))

    @cached_property
    def root(self) -> str:
        return self._property(f"DESCRIBE DATABASE {self.database}", "Location").rstrip("/")

    def _property(self, describe: str, name: str) -> str:
        """One value from the (driver-side, few-row) answer of a DESCRIBE command."""
        return next(row[1] for row in self.spark.sql(describe).collect() if row[0] == name)
