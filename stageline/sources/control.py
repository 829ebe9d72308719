"""The three control tables: make if absent, append, scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stageline import schemas


def _column_ddl(table: str, field) -> str:
    length = schemas.MAX_LENGTHS[table].get(field.name)
    dtype = f"varchar({length})" if length else field.dataType.simpleString()
    default = schemas.COLUMN_DEFAULTS[table].get(field.name)
    return (
        f"{field.name} {dtype}"
        + ("" if field.nullable else " not null")
        + (f" default {default}" if default else "")
    )


def create_control_tables(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Schema and tables, each only if absent; rows that exist are kept.

    Parquet tables take lengths and defaults but no keys: see operators.checks.
    """
    at = f" location '{location}'" if location else ""
    spark.sql(f"create schema if not exists {database}{at}")
    for table, schema in schemas.TABLES.items():
        columns = ", ".join(_column_ddl(table, f) for f in schema)
        spark.sql(f"create table if not exists {database}.{table} ({columns}) using parquet")


def append_rows(rows: DataFrame, table: str) -> None:
    """Append by column name; columns not in ``rows`` take the table's defaults."""
    names = ", ".join(rows.columns)
    insert = f"insert into {table} ({names}) select {names} from {{rows}}"
    rows.sparkSession.sql(insert, rows=rows)


def scan_control(spark: SparkSession, database: str, table: str) -> DataFrame:
    """A whole control table; Catalyst prunes the columns that are not used."""
    return spark.table(f"{database}.{table}")
