"""Control tables imitated at data scale from the given tables.

Every frame is made of whole tables. The SQL twins are in ``oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stageline import schemas

# Stored state of an instance by order status and the digit of its priority.
STATES = {
    "F1": "STARTING", "F2": "RUNNING", "F3": "STOPPING", "F4": "UNKNOWN", "F5": "SUCCEEDED",
    "O1": "FAILED", "O2": "TIMEOUT", "O3": "STOPPED", "O4": "RUNNING", "O5": "UNKNOWN",
    "P1": "SUCCEEDED", "P2": "RUNNING", "P3": "FAILED", "P4": "STOPPED", "P5": "TIMEOUT",
}
NO_RUN_ID = ["O4", "P1"]

EVENT_TYPES = ["click", "view", "purchase", "signup", "error"]

# Table that a message of an event type names.
TABLE_OF_EVENT = {
    "click": "customer",
    "view": "supplier",
    "purchase": "orders",
    "signup": "part",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _name(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


def _case(key: Column, values: dict[str, str]) -> Column:
    result = None
    for k, v in values.items():
        result = F.when(key == k, v) if result is None else result.when(key == k, v)
    return result


def _state_key() -> Column:
    return F.concat("o_orderstatus", F.substring("o_orderpriority", 1, 1))


def job_param() -> Column:
    """JSON with numbers, texts that are numbers, bad texts, nulls and gaps."""
    key = F.col("o_custkey").cast("string")
    urgency = F.substring("o_orderpriority", 1, 1)
    return F.concat(
        F.lit('{"script_location": "s3://scripts/'),
        key,
        F.lit('.py", "max_capacity": '),
        key,
        F.lit(".5"),
        F.when(urgency == "5", "").otherwise(', "glue_version": "2.0", "command_name": "pythonshell"'),
        F.when(urgency == "1", ', "max_concurrent_runs": 7.9')
        .when(urgency == "2", ', "max_concurrent_runs": "4"')
        .otherwise(""),
        F.when(F.col("o_orderstatus") == "O", ', "max_retries": " 2 "')
        .when(F.col("o_orderstatus") == "F", ', "max_retries": null')
        .otherwise(', "max_retries": "2.5"'),
        F.lit(', "timeout_minutes": '),
        key,
        F.lit("}"),
    )


def _definition() -> list[Column]:
    return [
        _name("job_", "o_orderkey").alias("job_name"),
        F.col("o_orderpriority").alias("job_description"),
        job_param().alias("job_param"),
        _case(F.col("o_orderstatus"), {"F": "N", "O": "Y"}).alias("is_active"),
        F.col("o_orderdate").alias("modified_timestamp"),
    ]


def job_definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wanted jobs, one per order, without their sync stamp."""
    return table(spark, sf_dir, "orders").select(*_definition())


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wanted jobs: one per order, synced when its last line was shipped."""
    shipped = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.max("l_shipdate").alias("shipped"))
    )
    never = F.lit(schemas.NEVER_SYNCED).cast("timestamp_ntz")
    return (
        table(spark, sf_dir, "orders")
        .join(shipped, "o_orderkey", "left")
        .select(*_definition(), F.coalesce("shipped", never).alias("last_sync_timestamp"))
    )


def listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed jobs: the orders that have lines, and jobs of others (the events)."""
    ours = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.max("l_linenumber").alias("lines"),
            F.max("l_quantity").alias("quantity"),
        )
        .select(
            _name("job_", "l_orderkey").alias("job_name"),
            _name("shipped ", "lines").alias("job_description"),
            _name("s3://old/", "lines").alias("script_location"),
            F.col("quantity").cast("double").alias("max_capacity"),
            F.lit("pythonshell").alias("command_name"),
            F.col("lines").alias("max_concurrent_runs"),
            F.lit("1.0").alias("glue_version"),
            F.col("lines").alias("max_retries"),
            F.col("quantity").cast("int").alias("timeout_minutes"),
        )
    )
    others = table(spark, sf_dir, "events").select(
        _name("event_", "event_id").alias("job_name"),
        F.col("event_type").alias("job_description"),
        F.lit("s3://others").alias("script_location"),
        F.lit(1.0).alias("max_capacity"),
        F.lit("glueetl").alias("command_name"),
        F.lit(1).alias("max_concurrent_runs"),
        F.lit("0.9").alias("glue_version"),
        F.lit(0).alias("max_retries"),
        F.lit(60).alias("timeout_minutes"),
    )
    return ours.unionByName(others)


def owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs that have instances: one per customer."""
    active = F.col("c_mktsegment").isin("BUILDING", "MACHINERY")
    return table(spark, sf_dir, "customer").select(
        _name("cust_", "c_custkey").alias("job_name"),
        F.when(active, "Y").otherwise("N").alias("is_active"),
        F.when(F.col("c_nationkey") == 3, "Y").otherwise("N").alias("is_run_sync"),
    )


def instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job instances: one per order of a customer."""
    key = _state_key()
    return table(spark, sf_dir, "orders").select(
        _name("cust_", "o_custkey").alias("job_name"),
        F.col("o_orderkey").alias("job_instance"),
        F.when(~key.isin(NO_RUN_ID), _name("jr_", "o_orderkey")).alias("job_run_id"),
        _case(key, STATES).alias("status"),
    )


def details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of an instance: the parts of an order, each once."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("job_instance"), _name("t_", "l_partkey").alias("table_name"))
        .agg(
            F.max(F.col("l_linestatus") == "O").alias("is_active"),
            F.max("l_shipdate").alias("last_run_timestamp"),
        )
        .withColumn("is_active", F.when(F.col("is_active"), "Y").otherwise("N"))
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """True run states: dear orders still run, cheap ones failed."""
    price = F.col("o_totalprice")
    status = F.when(price >= 300000, "RUNNING").when(price >= 100000, "SUCCEEDED").otherwise("FAILED")
    error = F.concat(F.lit("error "), "o_orderpriority")
    return table(spark, sf_dir, "orders").select(
        _name("jr_", "o_orderkey").alias("job_run_id"),
        status.alias("actual_status"),
        F.when(price < 100000, error).alias("error_message"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run requests, one per order: its first and last table, or a guess, or none; and
    one per customer for an instance that does not exist."""
    parts = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.min("l_partkey").alias("lo"), F.max("l_partkey").alias("hi"))
    )
    first, last, guess = _name("t_", "lo"), _name(" | t_", "hi"), _name("|t_", "o_custkey")
    tables = F.when(F.col("o_orderstatus") == "F", F.concat(first, last)).when(
        F.col("o_orderstatus") == "P", F.concat(first, guess)
    )
    strangers = table(spark, sf_dir, "customer").select(
        (-1 - F.col("c_custkey")).alias("job_instance"), F.col("c_mktsegment").alias("context")
    )
    orders = (
        table(spark, sf_dir, "orders")
        .join(parts, "o_orderkey", "left")
        .select(
            F.col("o_orderkey").alias("job_instance"),
            tables.alias("tables"),
            F.when(F.col("o_orderpriority") == "1-URGENT", 10).alias("max_dpu"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("incr_from"),
            F.lit(None).cast("string").alias("incr_to"),
            F.col("o_orderpriority").alias("context"),
        )
    )
    return orders.unionByName(strangers, allowMissingColumns=True)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ready-messages: one per event; a batch is a user's day, the body the type."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        _name("user_", "user_id").alias("job_name"),
        F.dayofmonth("ts").alias("job_instance"),
        F.col("event_type").alias("body"),
        F.col("ts").alias("sent"),
    )


def table_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages naming given tables, with white space around the names;
    errors are end marks."""
    body = F.coalesce(_case(F.col("body"), TABLE_OF_EVENT), F.lit(schemas.END_MARK))
    return messages(spark, sf_dir).withColumn("body", F.concat(F.lit("\t"), body, F.lit(" ")))


def message_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables of a user's day, from all events, last run on the first of them."""
    return (
        messages(spark, sf_dir)
        .groupBy(
            *schemas.INSTANCE_KEY,
            F.coalesce(_case(F.col("body"), TABLE_OF_EVENT), F.lit("region")).alias("table_name"),
        )
        .agg(F.min("sent").alias("last_run_timestamp"))
    )
