"""Constraint checks: reports of rows that break a key, not-null or length rule.

Key reports are per key with a count, so a key that holds much of the table is
reduced before the shuffle and is one row of the report.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stageline import schemas


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once, and how often."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def orphans(child: DataFrame, parent: DataFrame, on: list[str]) -> DataFrame:
    """Child keys without a parent, and how many rows have them.

    A key with a null part is not checked, as in SQL. Both sides are reduced to
    their keys first, which leaves no skew for the join and one shuffle per side.
    """
    checked = child.dropna(subset=on).groupBy(*on).agg(F.count(F.lit(1)).alias("n"))
    return checked.join(parent.select(*on).distinct(), on, "left_anti")


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _has_null(columns: list[str]) -> Column:
    return _any([F.col(c).isNull() for c in columns])


def _too_long(limits: Mapping[str, int]) -> Column:
    return _any([F.length(c) > n for c, n in limits.items()])


def null_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a null in any of the columns."""
    return df.where(_has_null(columns))


def long_rows(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Rows with a text longer than its limit in any of the columns."""
    return df.where(_too_long(limits))


def control_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All rules of the control tables: ``table_name``, ``rule``, ``n`` broken keys or rows.

    The row rules of a table are counted in one scan.
    """
    reports = []
    for name, df in tables.items():
        row_rules = {
            "not null": F.count_if(_has_null(schemas.NOT_NULL[name])),
            "length": F.count_if(_too_long(schemas.MAX_LENGTHS[name])),
        }
        counts = df.agg(*[n.alias(rule) for rule, n in row_rules.items()])
        reports.append((name, counts.unpivot([], list(row_rules), "rule", "n")))
        reports.append((name, _counted("primary key", duplicate_keys(df, schemas.PRIMARY_KEYS[name]))))
    for child, parent, on in schemas.FOREIGN_KEYS:
        if child in tables and parent in tables:
            broken = orphans(tables[child], tables[parent], on)
            reports.append((child, _counted("foreign key", broken)))
    named = [df.select(F.lit(table).alias("table_name"), "rule", "n") for table, df in reports]
    return reduce(DataFrame.union, named)


def _counted(rule: str, rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(rule).alias("rule"), "n")
