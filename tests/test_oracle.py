"""Every query on table loads against its SQL twin in DuckDB, values and types.

The operators for training data have tests of their own in ``tests/llm``.
"""

import decimal
import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registered
from stageline.registry.oracle import ORACLE
from stageline.registry.queries import QUERIES

KINDS = {
    "bigint": "int64", "int": "int32", "smallint": "int32", "double": "double", "string": "string",
    "boolean": "bool", "timestamp_ntz": "timestamp", "timestamp": "timestamp", "date": "date",
    "BIGINT": "int64", "INTEGER": "int32", "DOUBLE": "double", "VARCHAR": "string",
    "BOOLEAN": "bool", "TIMESTAMP": "timestamp", "DATE": "date",
}

# cross joins, Python in the plan, collecting a window of a whole group
UNWANTED = ["CartesianProduct", "NestedLoopJoin", "EvalPython", "MapInPandas", "Window ["]


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    yield con
    con.close()


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return float(v) if isinstance(v, decimal.Decimal) else v


def _sorted(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_value(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(registered.queries()) and set(ORACLE) <= set(registered.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, sf_dir, name):
    df = registered.queries()[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [op for op in UNWANTED if op in plan]
    result = duck.execute(registered.oracle_sql()[name])
    columns = {d[0]: KINDS[str(d[1])] for d in result.description}
    assert {c: KINDS[t] for c, t in df.dtypes} == columns
    expected = _sorted([d[0] for d in result.description], result.fetchall())
    actual = _sorted(df.columns, df.collect())
    assert actual == expected
    if name != "stage_truncate":
        assert actual


def test_entry(spark):
    assert {r["action"] for r in registered.entry(spark).collect()} == {
        "create", "update", "delete", "none",
    }
