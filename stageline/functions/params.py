"""Typed job parameters, defaults and run arguments."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stageline import schemas


def _parsed(document: Column, types: Mapping[str, str]) -> Column:
    """The JSON text as a struct of its fields, and the text itself where it is no object."""
    fields = ", ".join(f"{n} {'string' if t == 'string' else 'variant'}" for n, t in types.items())
    return F.from_json(document, f"{fields}, _no_json string", {"columnNameOfCorruptRecord": "_no_json"})


def _typed(name: str, dtype: str) -> Column:
    field = F.col("_parsed")[name]
    return field if dtype == "string" else F.try_variant_get(field, "$", dtype)


def _given(name: str, dtype: str) -> Column:
    return _typed(name, "string") if dtype == "string" else F.try_variant_get(F.col("_parsed")[name], "$", "string")


def with_fields(
    df: DataFrame, document: Column, types: Mapping[str, str], defaults: Mapping[str, object] | None = None
) -> DataFrame:
    """Add fields of a JSON text by name, each cast to its type; a bad value is null.

    Numbers pass through a variant, so that ``3.7`` and ``"3"`` become 3 while the
    text ``"3.7"`` is not an integer. ``defaults`` stand for fields that are absent or
    null, not for bad values (``bad_fields`` tells those) and not in a text that is no
    JSON. The parsed text is a column of its own projection: written into each field,
    it would be parsed once per field.
    """
    defaults = defaults or {}
    fields = {}
    for name, dtype in types.items():
        fields[name] = _typed(name, dtype)
        if name in defaults:
            absent = _given(name, dtype).isNull() & F.col("_parsed")["_no_json"].isNull()
            fields[name] = F.when(absent, F.lit(defaults[name])).otherwise(fields[name])
    return df.withColumn("_parsed", _parsed(document, types)).withColumns(fields).drop("_parsed")


def bad_fields(
    df: DataFrame, key: list[str], document: str, types: Mapping[str, str] = schemas.PARAM_TYPES
) -> DataFrame:
    """Fields that are given but cannot be cast: the key, ``field`` and its ``text``.

    An absent or null field is not bad. A text that is no JSON object is one row with
    a null field. The texts are parsed once.
    """
    parsed = df.select(*key, _parsed(F.col(document), types).alias("_parsed"))
    no_json = F.col("_parsed")["_no_json"]

    def report(field: Column, text: Column) -> Column:
        return F.struct(field.cast("string").alias("field"), text.alias("text"))

    bad = [
        F.when(_given(name, dtype).isNotNull() & _typed(name, dtype).isNull(), report(F.lit(name), _given(name, dtype)))
        for name, dtype in types.items()
    ]
    bad.append(F.when(no_json.isNotNull(), report(F.lit(None), no_json)))
    found = F.filter(F.array(*bad), lambda x: x.isNotNull())
    return parsed.select(*key, F.explode(found).alias("_bad")).select(*key, "_bad.field", "_bad.text")


def with_params(
    jobs: DataFrame, column: str = "job_param", defaults: Mapping[str, object] | None = None
) -> DataFrame:
    """Replace the JSON column by its seven typed fields."""
    return with_fields(jobs, F.col(column), schemas.PARAM_TYPES, defaults).drop(column)


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Fill nulls of the named columns; a default is a value or a column."""
    return df.withColumns(
        {
            name: F.coalesce(F.col(name), value if isinstance(value, Column) else F.lit(value))
            for name, value in defaults.items()
        }
    )


def run_arguments(
    job_instance: Column,
    tables: Column,
    incr_from: Column | None = None,
    incr_to: Column | None = None,
    context: Column | None = None,
) -> Column:
    """The string map handed to a run; absent bounds and context are empty.

    Without a table list its key is left out: the run loads all active tables of its
    instance, which ``plans.runs.tables_to_load`` gives as rows. An empty text would
    name one empty table.
    """
    given = {
        "job_instance": job_instance,
        "tables": tables,
        "incr_from": incr_from,
        "incr_to": incr_to,
        "context": context,
    }
    entries = []
    for key, name in schemas.RUN_ARGUMENT_KEYS.items():
        value = given[name]
        value = F.lit("") if value is None else value.cast("string")
        entries += [F.lit(key), value if name == "tables" else F.coalesce(value, F.lit(""))]
    return F.map_filter(F.create_map(*entries), lambda _, value: value.isNotNull())


def max_capacity(max_dpu: Column) -> Column:
    """The capacity of a run as a double, null when none was asked for."""
    return max_dpu.cast("double")


def status_class(status: Column) -> Column:
    """Sort run states into running, unknown, terminal and other."""
    return (
        F.when(status.isin(schemas.STATES_RUNNING), "running")
        .when(status == schemas.STATE_UNKNOWN, "unknown")
        .when(status.isin(schemas.STATES_TERMINAL), "terminal")
        .otherwise("other")
    )


def now_utc() -> Column:
    """The current time to the second."""
    return F.date_trunc("second", F.current_timestamp())
