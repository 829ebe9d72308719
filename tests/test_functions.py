import datetime

from pyspark.sql import functions as F

from stageline import schemas
from stageline.functions import params, text


def column(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v")).alias("r")).collect()]


def test_strip_is_python_strip(spark):
    values = ["a", " a ", "\t a b\n", "\xa0x　", "\x1fy\x85", "", "  ", "​z", "﻿q "]
    assert column(spark, values, text.strip) == [v.strip() for v in values]
    assert all(c.isspace() for c in text.WHITESPACE)
    assert {chr(c) for c in range(0x3001) if chr(c).isspace()} == set(text.WHITESPACE)


def test_table_list(spark):
    values = ["a|b", " a | b|", "", "|", "a", None]
    expected = [None if v is None else [n.strip() for n in v.split("|")] for v in values]
    assert column(spark, values, text.table_list) == expected


def test_quoted_list(spark):
    quoted = column(spark, ["a| b ", "", "x"], lambda v: text.quoted_list(text.table_list(v)))
    assert quoted == ["'a','b'", "''", "'x'"]


def test_template(spark):
    name = column(
        spark,
        ["j"],
        lambda v: text.from_template(schemas.QUEUE_NAME_TEMPLATE, job_name=v, job_instance=F.lit(3)),
    )
    assert name == ["j_3.fifo"]


def test_params(spark):
    docs = [
        '{"max_retries": 3.7, "max_capacity": "2.5", "glue_version": "1.0", "timeout_minutes": " 4 "}',
        '{"max_retries": "3.7", "max_capacity": 2, "glue_version": 2.0, "timeout_minutes": null}',
        '{"max_retries": -3.7, "max_capacity": "x", "max_concurrent_runs": true}',
        "not json",
        None,
    ]
    df = spark.createDataFrame(list(enumerate(docs)), "i int, job_param string")
    rows = params.with_params(df).orderBy("i").collect()
    assert [r["max_retries"] for r in rows] == [3, None, -3, None, None]
    assert [r["max_capacity"] for r in rows] == [2.5, 2.0, None, None, None]
    assert [r["glue_version"] for r in rows] == ["1.0", "2.0", None, None, None]
    assert [r["timeout_minutes"] for r in rows] == [4, None, None, None, None]
    assert [r["max_concurrent_runs"] for r in rows] == [None, None, 1, None, None]
    assert [n for n in rows[0].asDict() if n != "i"] == list(schemas.PARAM_TYPES)


def test_defaults_are_for_absent_fields(spark):
    docs = ['{"max_retries": "2.5"}', '{"max_retries": null}', "{}", "not json", '{"max_retries": 99999999999}', None]
    df = spark.createDataFrame(list(enumerate(docs)), "i int, job_param string")
    got = params.with_params(df, defaults=schemas.UPDATE_DEFAULTS).orderBy("i").collect()
    assert [r["max_retries"] for r in got] == [None, 1, 1, None, None, 1]
    assert [r["command_name"] for r in got] == ["glueetl"] * 3 + [None] + ["glueetl"] * 2
    bad = params.bad_fields(df, ["i"], "job_param").orderBy("i").collect()
    assert [tuple(r) for r in bad] == [
        (0, "max_retries", "2.5"), (3, None, "not json"), (4, "max_retries", "99999999999"),
    ]


def test_params_are_parsed_once(spark):
    df = spark.createDataFrame([("{}",)], "job_param string")
    plan = params.with_params(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_run_arguments(spark):
    df = spark.createDataFrame([(7, "a|b", "2024-01-01")], "i int, t string, f string")
    args = df.select(params.run_arguments(F.col("i"), F.col("t"), F.col("f")).alias("a")).first()["a"]
    assert args == {
        "--job-instance": "7",
        "--tables": "a|b",
        "--incr-from": "2024-01-01",
        "--incr-to": "",
        "--job-context": "",
    }


def test_no_table_list_has_no_argument(spark):
    df = spark.createDataFrame([(7, None)], "i int, t string")
    args = df.select(params.run_arguments(F.col("i"), F.col("t")).alias("a")).first()["a"]
    assert "--tables" not in args and args["--incr-from"] == ""


def test_status_class(spark):
    states = ["RUNNING", "UNKNOWN", "TIMEOUT", "STOPPED", None]
    assert column(spark, states, params.status_class) == [
        "running", "unknown", "terminal", "other", "other",
    ]


def test_now_is_to_the_second(spark):
    now = spark.range(1).select(params.now_utc()).first()[0]
    assert isinstance(now, datetime.datetime) and now.microsecond == 0
