"""Queries with a SQL twin against DuckDB."""

from pathlib import Path

import duckdb
import pytest

from stageline.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", list(ORACLE))
def test_query(spark, sf_dir, name):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    result = con.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    expected = sorted(result.fetchall(), key=repr)
    got = QUERIES[name](spark, sf_dir)
    assert sorted(got.columns) == sorted(names)
    assert expected and sorted(map(tuple, got.select(*names).collect()), key=repr) == expected
    con.close()
