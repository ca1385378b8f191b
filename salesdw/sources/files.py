"""Reading headed source files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesdw.operators.ordering import file_row_ids
from salesdw.staging import Staging

BROKEN = "_broken_record"


def read_sales(
    spark: SparkSession, path: str, file_format: str = "csv", schema: T.StructType | None = None
) -> DataFrame:
    """Read a headed file of any Spark format. Nameless header cells become ``_cN``.

    Without ``schema`` the types are inferred, which reads a text file one more time. Give a schema
    (all strings will do: cleaning casts leniently) for large text files.
    """
    reader = spark.read.format(file_format).option("header", True)
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    return reader.load(path)


def stored_bytes(spark: SparkSession, path: str) -> int:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()


def read_and_reject(
    spark: SparkSession, path: str, schema: T.StructType, row_id: str, staging: Staging, header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """The records of a text file that the schema can hold, and the broken ones; each with its row id in source order.

    Broken are records with too few or too many fields and those with a value of another type. Their rows are
    source_file, ``row_id`` and record (the line as it stands). The text is parsed once; both parts read the staged rows.
    """
    reader = spark.read.schema(T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())]))
    reader = reader.options(header=header, mode="PERMISSIVE", columnNameOfCorruptRecord=BROKEN)
    rows = reader.csv(path).withColumn("_source_file", F.col("_metadata.file_name"))
    rows = file_row_ids(rows, row_id, staging)
    broken = F.col(BROKEN).isNotNull()
    rejected = rows.where(broken).select(F.col("_source_file").alias("source_file"), row_id, F.col(BROKEN).alias("record"))
    return rows.where(~broken).drop("_source_file", BROKEN), rejected
