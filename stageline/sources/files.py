"""File scans: CSV, Parquet partitions, listings in pages, increments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str | None = None, **options
) -> DataFrame:
    """CSV with a header line, from a folder or glob.

    Without ``schema`` the types are inferred, which reads all of the text once
    more; give a schema wherever it is known.
    """
    reader = spark.read.option("header", True).options(**options)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_partitions(
    spark: SparkSession, path: str, predicate: Column | str | None = None
) -> DataFrame:
    """A partitioned Parquet table; the predicate prunes folders before the scan."""
    df = spark.read.parquet(path)
    return df if predicate is None else df.where(predicate)


def read_listing(spark: SparkSession, folder: str, schema: StructType | str) -> DataFrame:
    """All pages (files) of a listed state as one frame, nothing removed.

    The schema is given, so no file is opened just to plan the scan.
    """
    return spark.read.schema(schema).parquet(folder)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: str | None = None,
    upper: str | None = None,
    partitions: int = 1,
    **options,
) -> DataFrame:
    """A table of a database, in parallel when a partition column is given."""
    if partition_column:
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": lower,
            "upperBound": upper,
            "numPartitions": str(partitions),
        }
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def increment(df: DataFrame, column: str, since: str = "", until: str = "") -> DataFrame:
    """Rows of ``[since, until)``; an empty bound is open.

    The bounds are cast to the column's own type, so the comparison is made on
    the stored column and reaches the Parquet reader. It skips row groups of a
    ``timestamp`` stored as TIMESTAMP_MICROS; of a ``timestamp_ntz`` Spark skips
    none, so partition such a table by day and bound the partition as well.
    """
    for bound in _bounds(df, column, since, until):
        df = df.where(bound)
    return df


def outside(df: DataFrame, column: str, since: str = "", until: str = "") -> DataFrame:
    """The rows that ``increment`` leaves, those without a time among them."""
    inside = F.lit(True)
    for bound in _bounds(df, column, since, until):
        inside = inside & bound
    return df.where(~F.coalesce(inside, F.lit(False)))


def _bounds(df: DataFrame, column: str, since: str, until: str) -> list[Column]:
    dtype = df.schema[column].dataType
    lower = [F.col(column) >= F.lit(since).cast(dtype)] if since else []
    upper = [F.col(column) < F.lit(until).cast(dtype)] if until else []
    return lower + upper
