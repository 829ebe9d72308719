"""One function per registered query: (spark, folder of the given tables) -> frame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stageline import schemas
from stageline.functions import params, text
from stageline.operators import checks, end_mark, lookups, membership, updates
from stageline.plans import runs as run_plans
from stageline.plans import sync
from stageline.registry import fixtures as fx
from stageline.session import shared_folder
from stageline.sinks import stage, tables
from stageline.sources import control, files
from stageline.streaming import loads, run_states, run_timeouts
from stageline.streaming.messages import read_messages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

INSTANCE = ["job_instance"]
STAMP = "2002-01-01 00:00:00"


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _stamp():
    return F.lit(STAMP).cast("timestamp_ntz")


def _view(folder: str, name: str) -> str:
    return f"stageline_{name}_{folder.rsplit('-', 1)[-1]}"


def _write_csv(df: DataFrame, folder: str) -> str:
    (
        df.write.option("header", True)
        .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        .csv(folder)
    )
    return f"{folder}/*.csv"


# ------------------------------------------------------------- sources, sinks


@query
def etl_csv_to_parquet(spark, sf_dir):
    """CSV with inferred types to Parquet; inference narrows, so types are declared again."""
    folder = shared_folder(spark, "csv_to_parquet")
    customer = fx.table(spark, sf_dir, "customer")
    source = _write_csv(customer, f"{folder}/csv")
    tables.convert_table(spark, source, f"{folder}/out")
    return spark.read.parquet(f"{folder}/out").to(customer.schema)


@query
def etl_csv_declared(spark, sf_dir):
    """The same with a given schema: the text is read once."""
    folder = shared_folder(spark, "csv_declared")
    orders = fx.table(spark, sf_dir, "orders")
    source = _write_csv(orders, f"{folder}/csv")
    tables.convert_table(
        spark,
        source,
        f"{folder}/out",
        schema=orders.schema,
        timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    )
    return spark.read.parquet(f"{folder}/out")


@query
def etl_csv_to_orc(spark, sf_dir):
    """The output format is a parameter."""
    folder = shared_folder(spark, "csv_to_orc")
    part = fx.table(spark, sf_dir, "part")
    source = _write_csv(part, f"{folder}/csv")
    tables.convert_table(spark, source, f"{folder}/out", "orc", part.schema)
    return spark.read.orc(f"{folder}/out")


@query
def etl_convert_many(spark, sf_dir):
    folder = shared_folder(spark, "convert_many")
    names = ["customer", "supplier", "part", "nation", "region"]
    tables.in_flight(
        [
            lambda n=n: _write_csv(fx.table(spark, sf_dir, n), f"{folder}/csv/{n}") and None
            for n in names
        ],
        spark,
    )
    return tables.convert_tables(spark, names, folder + "/csv/{}/*.csv", folder + "/out/{}")


@query
def control_scan(spark, sf_dir):
    """Make the control tables, append the jobs, scan them back with their defaults."""
    folder = shared_folder(spark, "control_scan")
    database = _view(folder, "control")
    control.create_control_tables(spark, database, folder)
    control.append_rows(fx.job_definitions(spark, sf_dir), f"{database}.jobs")
    return control.scan_control(spark, database, "jobs").select(
        "job_name",
        "job_description",
        "is_active",
        "is_run_sync",
        F.col("modified_timestamp").cast("timestamp_ntz").alias("modified_timestamp"),
        F.col("last_sync_timestamp").cast("timestamp_ntz").alias("last_sync_timestamp"),
    )


@query
def snapshot_listing(spark, sf_dir):
    folder = shared_folder(spark, "snapshot_listing")
    fx.listed(spark, sf_dir).select("job_name").write.parquet(folder)
    return files.read_listing(spark, folder, "job_name string")


@query
def read_partition_pruned(spark, sf_dir):
    folder = shared_folder(spark, "read_partition_pruned")
    events = fx.table(spark, sf_dir, "events").withColumn("event_date", F.to_date("ts"))
    tables.write_table(events, folder, partition_by=["event_date"])
    return files.read_partitions(spark, folder, "event_date >= date '2024-01-16'").select(
        "event_id", "user_id"
    )


@query
def stage_full_refresh(spark, sf_dir):
    folder = shared_folder(spark, "stage_full_refresh")
    view = _view(folder, "orders")
    orders = fx.table(spark, sf_dir, "orders")
    stage.refresh_stage(orders.where("false"), view, folder)
    return stage.refresh_stage(orders, view, folder)


@query
def stage_truncate(spark, sf_dir):
    folder = shared_folder(spark, "stage_truncate")
    view = _view(folder, "supplier")
    stage.refresh_stage(fx.table(spark, sf_dir, "supplier"), view, folder)
    return stage.truncate_stage(spark, view, folder)


@query
def incremental_window(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return files.increment(orders, "o_orderdate", "1996-07-01", "1999-01-01")


@query
def incremental_load(spark, sf_dir):
    """Increments whose bounds cut years, out of order, one of them twice."""
    folder = shared_folder(spark, "incremental_load")
    orders = fx.table(spark, sf_dir, "orders").withColumn("order_year", F.year("o_orderdate"))
    cuts = ["", "1994-03-01", "1996-07-01", "1997-05-09", ""]
    for i in (2, 0, 3, 1, 2):
        tables.load_increment(orders, folder, ["order_year"], "o_orderdate", cuts[i], cuts[i + 1])
    return spark.read.parquet(folder).select("o_orderkey", "o_custkey", "o_totalprice", "order_year")


# ---------------------------------------------------------- column functions


@query
def status_class(spark, sf_dir):
    return fx.instances(spark, sf_dir).select(
        "job_name", "job_instance", "status", params.status_class(F.col("status")).alias("status_class")
    )


@query
def param_extract(spark, sf_dir):
    jobs = fx.job_definitions(spark, sf_dir).select("job_name", "job_param")
    return params.with_params(jobs, defaults=schemas.UPDATE_DEFAULTS)


@query
def param_violations(spark, sf_dir):
    """Job parameters that are given but cannot be cast."""
    return params.bad_fields(fx.job_definitions(spark, sf_dir), ["job_name"], "job_param")


@query
def param_extract_events(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events").select("event_id", "props")
    defaults = {"timeout_minutes": schemas.CREATE_DEFAULTS["timeout_minutes"]}
    types = {"k": "int", "timeout_minutes": "int"}
    return params.with_fields(events, F.col("props"), types, defaults).select("event_id", "k", "timeout_minutes")


@query
def column_defaults(spark, sf_dir):
    jobs = fx.job_definitions(spark, sf_dir).select("job_name", "is_active")
    return params.with_defaults(jobs, {"is_active": schemas.NO})


def _part_request():
    repeated = F.when(F.col("p_size") > 40, F.col("p_brand")).otherwise(F.col("p_name"))
    return F.concat("p_brand", F.lit(" | "), "p_type", F.lit("|"), repeated)


@query
def table_list_explode(spark, sf_dir):
    part = fx.table(spark, sf_dir, "part").select("p_partkey", _part_request().alias("tables"))
    return text.explode_tables(part, "tables")


@query
def quoted_list(spark, sf_dir):
    names = text.table_list(_part_request())
    return fx.table(spark, sf_dir, "part").select("p_partkey", text.quoted_list(names).alias("quoted"))


@query
def run_arguments(spark, sf_dir):
    tables_text = F.concat("o_orderstatus", F.lit("|"), "o_orderpriority")
    arguments = params.run_arguments(F.col("o_orderkey"), tables_text)
    dpu = F.when(F.col("o_orderstatus") == "O", 10)
    return (
        fx.table(spark, sf_dir, "orders")
        .select("o_orderkey", arguments.alias("a"), params.max_capacity(dpu).alias("max_capacity"))
        .select(
            "o_orderkey",
            F.col("a")["--job-instance"].alias("job_instance"),
            F.col("a")["--tables"].alias("tables"),
            F.col("a")["--incr-from"].alias("incr_from"),
            "max_capacity",
        )
    )


@query
def name_templates(spark, sf_dir):
    queue = text.from_template(
        schemas.QUEUE_NAME_TEMPLATE,
        job_name=F.concat(F.lit("cust"), F.col("o_custkey").cast("string")),
        job_instance=F.col("o_orderkey"),
    )
    path = text.from_template(
        schemas.LOAD_PATH_TEMPLATE, bucket=F.lit("loads"), table_name=F.col("o_orderpriority")
    )
    return fx.table(spark, sf_dir, "orders").select(
        "o_orderkey", queue.alias("queue_name"), path.alias("load_path")
    )


# -------------------------------------------------------------------- lookups


@query
def active_tables(spark, sf_dir):
    """Active tables of the instances that may run."""
    idle = fx.instances(spark, sf_dir).where(~F.col("status").isin(schemas.STATES_RUNNING))
    return lookups.active_tables(fx.details(spark, sf_dir), idle, INSTANCE)


@query
def active_table_counts(spark, sf_dir):
    return lookups.active_table_counts(fx.details(spark, sf_dir), INSTANCE)


@query
def run_lookup(spark, sf_dir):
    """Run id and state of the instances that have a returned line."""
    returned = (
        fx.table(spark, sf_dir, "lineitem")
        .where(F.col("l_returnflag") == "R")
        .select(F.col("l_orderkey").alias("job_instance"))
        .distinct()
    )
    return lookups.run_lookup(fx.instances(spark, sf_dir), returned, INSTANCE)


@query
def overlap_gate(spark, sf_dir):
    return lookups.overlap_gate(fx.instances(spark, sf_dir), fx.runs(spark, sf_dir))


@query
def failed_runs(spark, sf_dir):
    return lookups.failed_runs(fx.runs(spark, sf_dir))


@query
def active_instances(spark, sf_dir):
    return lookups.active_instances(fx.owners(spark, sf_dir), fx.instances(spark, sf_dir))


@query
def jobs_with_instances(spark, sf_dir):
    return lookups.jobs_with_instances(fx.owners(spark, sf_dir), fx.instances(spark, sf_dir))


def _decided(spark, sf_dir):
    return run_plans.decide_runs(
        fx.requests(spark, sf_dir),
        fx.instances(spark, sf_dir),
        fx.runs(spark, sf_dir),
        fx.details(spark, sf_dir),
        INSTANCE,
    )


@query
def run_requests(spark, sf_dir):
    """Decision and arguments of every run request."""
    return _decided(spark, sf_dir).select(
        "job_instance",
        "decision",
        F.col("arguments")["--tables"].alias("tables"),
        F.col("arguments")["--incr-from"].alias("incr_from"),
        F.col("arguments")["--job-context"].alias("context"),
        "max_capacity",
    )


@query
def run_request_tables(spark, sf_dir):
    """The tables to load of every run that starts. The decisions are used twice, so
    they are written first."""
    folder = shared_folder(spark, "run_request_tables")
    tables.write_table(_decided(spark, sf_dir).select("job_instance", "tables", "decision"), folder)
    decided = spark.read.parquet(folder)
    return run_plans.tables_to_load(decided, fx.details(spark, sf_dir), INSTANCE)


@query
def run_starts_stored(spark, sf_dir):
    """Instances after the accepted requests were started."""
    run_id = F.concat(F.lit("new_"), F.col("job_instance").cast("string"))
    decided = _decided(spark, sf_dir).where(F.col("decision") == "start")
    started = decided.select("job_instance", run_id.alias("job_run_id"))
    return updates.mark_started(fx.instances(spark, sf_dir), started, INSTANCE)


@query
def run_ends_stored(spark, sf_dir):
    """Instances after their runs reported their states; only a final one is stored."""
    reports = fx.instances(spark, sf_dir).join(fx.runs(spark, sf_dir), "job_run_id")
    reports = reports.select("job_instance", "job_run_id", F.col("actual_status").alias("status"))
    return updates.mark_ended(fx.instances(spark, sf_dir), reports, INSTANCE)


# ---------------------------------------------------------------- change plan


@query
def merge_indicator(spark, sf_dir):
    merged = sync.merge_sides(fx.jobs(spark, sf_dir), fx.listed(spark, sf_dir))
    return merged.select("job_name", "is_active", "merge_side")


@query
def sync_plan(spark, sf_dir):
    plan = sync.plan_changes(fx.jobs(spark, sf_dir), fx.listed(spark, sf_dir).select("job_name"))
    return plan.select("job_name", "action")


@query
def sync_plan_counts(spark, sf_dir):
    return sync_plan(spark, sf_dir).groupBy("action").agg(F.count(F.lit(1)).alias("n"))


@query
def sync_plan_bucketed(spark, sf_dir):
    """The plan over tables stored by job name: the merge does not shuffle."""
    folder = shared_folder(spark, "sync_plan_bucketed")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sides = {"jobs": fx.jobs(spark, sf_dir), "listed": fx.listed(spark, sf_dir)}
    jobs, listed = (
        stage.refresh_stage(df, _view(folder, name), f"{folder}/{name}", buckets, schemas.JOB_KEY)
        for name, df in sides.items()
    )
    return sync.plan_changes(jobs, listed.select("job_name")).select("job_name", "action")


APPLIED = [
    "job_description", "script_location", "max_capacity", "command_name", "glue_version",
    "python_version", "max_concurrent_runs", "max_retries", "timeout_minutes",
]


@query
def apply_changes(spark, sf_dir):
    return sync.apply_changes(fx.jobs(spark, sf_dir), fx.listed(spark, sf_dir), APPLIED)


@query
def sync_cycle(spark, sf_dir):
    """The whole cycle on stage tables; returns the listed state after it."""
    folder = shared_folder(spark, "sync_cycle")
    jobs_view, listed_view = _view(folder, "jobs"), _view(folder, "listed")
    jobs = fx.jobs(spark, sf_dir).withColumn("is_run_sync", F.lit(schemas.NO))
    stage.refresh_stage(jobs, jobs_view, f"{folder}/jobs")
    listed = fx.listed(spark, sf_dir).withColumn("python_version", F.lit(None).cast("string"))
    stage.refresh_stage(listed, listed_view, f"{folder}/listed")
    sync.sync_cycle(spark, jobs_view, listed_view, folder, APPLIED, _stamp())
    return spark.table(listed_view)


# -------------------------------------------------------------------- updates


@query
def set_sync_flag(spark, sf_dir):
    return updates.set_sync_flag(fx.owners(spark, sf_dir), schemas.YES).select("job_name", "is_run_sync")


@query
def mark_synced(spark, sf_dir):
    jobs = updates.mark_synced(fx.job_definitions(spark, sf_dir), _stamp())
    return jobs.select("job_name", "last_sync_timestamp", "is_run_sync")


@query
def update_instances(spark, sf_dir):
    """Runs that ended store their last state over the old one."""
    orders = fx.table(spark, sf_dir, "orders")
    ended = orders.where(F.col("o_totalprice") < 300000).select(
        F.col("o_orderkey").alias("job_instance"),
        F.concat(F.lit("jr2_"), F.col("o_orderkey").cast("string")).alias("job_run_id"),
        F.when(F.col("o_totalprice") < 100000, "FAILED").otherwise("SUCCEEDED").alias("status"),
    )
    return updates.update_instances(fx.instances(spark, sf_dir), ended, INSTANCE)


@query
def update_instances_latest(spark, sf_dir):
    """Many updates per key: the latest line of an order wins."""
    lines = fx.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("job_instance"),
        F.concat(F.lit("ship_"), F.date_format("l_shipdate", "yyyy-MM-dd")).alias("job_run_id"),
        F.lit("SUCCEEDED").alias("status"),
        "l_shipdate",
    )
    return updates.update_instances(fx.instances(spark, sf_dir), lines, INSTANCE, "l_shipdate")


@query
def update_details(spark, sf_dir):
    key = [*INSTANCE, "table_name"]
    returned = (
        fx.table(spark, sf_dir, "lineitem")
        .where(F.col("l_returnflag") == "R")
        .select(
            F.col("l_orderkey").alias("job_instance"),
            F.concat(F.lit("t_"), F.col("l_partkey").cast("string")).alias("table_name"),
        )
        .distinct()
    )
    return updates.stamp_details(fx.details(spark, sf_dir), returned, _stamp(), key)


# ------------------------------------------------------- counts and questions


@query
def sync_flag_count(spark, sf_dir):
    return membership.sync_flag_count(fx.owners(spark, sf_dir))


@query
def empty_guard(spark, sf_dir):
    return membership.is_empty(fx.owners(spark, sf_dir))


@query
def membership_count(spark, sf_dir):
    """How many tables of an instance are parts of one type."""
    names = (
        fx.table(spark, sf_dir, "part")
        .where(F.col("p_type") == "ECONOMY")
        .select(F.concat(F.lit("t_"), F.col("p_partkey").cast("string")).alias("table_name"))
    )
    return membership.named_table_counts(fx.details(spark, sf_dir), names, INSTANCE)


@query
def membership_validate(spark, sf_dir):
    """Every line asks for its part; an order that asks for a part twice is not valid."""
    line = fx.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("job_instance"),
        F.concat(F.lit("t_"), F.col("l_partkey").cast("string")).alias("table_name"),
    )
    return membership.validate_requested(line, fx.details(spark, sf_dir), INSTANCE)


@query
def membership_validate_lists(spark, sf_dir):
    """Piped requests of parts; the details know brand and type of every part."""
    part = fx.table(spark, sf_dir, "part")
    asked = text.explode_tables(part.select("p_partkey", _part_request().alias("tables")), "tables")
    known = part.select("p_partkey", F.explode(F.array("p_brand", "p_type", "p_name")).alias("table_name"))
    return membership.validate_requested(asked, known, ["p_partkey"])


@query
def batch_completeness(spark, sf_dir):
    messages = fx.messages(spark, sf_dir)
    expected = messages.groupBy(*schemas.INSTANCE_KEY).agg(F.count(F.lit(1)).alias("expected"))
    arrived = messages.where(F.col("body") != "error")
    return membership.batch_completeness(arrived, expected)


# --------------------------------------------------------------------- checks


@query
def pk_violations(spark, sf_dir):
    return checks.duplicate_keys(fx.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def fk_orphans(spark, sf_dir):
    child = fx.table(spark, sf_dir, "orders").select("o_orderkey")
    parent = fx.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return checks.orphans(child, parent, ["o_orderkey"])


@query
def null_violations(spark, sf_dir):
    bad = checks.null_rows(fx.instances(spark, sf_dir), ["job_run_id", "job_name"])
    return bad.select("job_name", "job_instance")


@query
def length_violations(spark, sf_dir):
    part = fx.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    return checks.long_rows(part, {"p_name": 10, "p_type": 7})


@query
def control_violations(spark, sf_dir):
    """All rules at once: jobs are orders, instances are their lines, details the parts
    of the lines, those of open lines under the name of the supplier."""
    jobs = fx.jobs(spark, sf_dir).select(
        "job_name",
        "job_description",
        "job_param",
        F.col("modified_timestamp").alias("created_timestamp"),
        "modified_timestamp",
        "last_sync_timestamp",
        F.lit("N").alias("is_run_sync"),
        "is_active",
    )
    flag = F.col("l_returnflag")
    instances = fx.table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("job_"), F.col("l_orderkey").cast("string")).alias("job_name"),
        F.when(flag != "N", F.col("l_linenumber")).alias("job_instance"),
        F.when(flag == "R", "RETURNED LATE").otherwise("SUCCEEDED").alias("status"),
    )
    open_line = F.col("l_linestatus") == "O"
    owner = F.when(open_line, F.concat(F.lit("supp_"), F.col("l_suppkey").cast("string"))).otherwise(
        F.concat(F.lit("job_"), F.col("l_orderkey").cast("string"))
    )
    details = fx.table(spark, sf_dir, "lineitem").select(
        owner.alias("job_name"),
        F.when(flag != "A", F.col("l_linenumber")).alias("job_instance"),
        F.concat(F.lit("t_"), F.col("l_partkey").cast("string")).alias("table_name"),
        F.col("l_shipdate").alias("created_timestamp"),
        F.when(flag == "R", "yes").otherwise("Y").alias("is_active"),
    )
    return checks.control_violations({"jobs": jobs, "job_instances": instances, "job_details": details})


# ------------------------------------------------------------------ streaming


def _message_folder(df: DataFrame, folder: str) -> str:
    df.write.parquet(f"{folder}/messages")
    return f"{folder}/messages"


#: parts in which messages are sent one after another, and files of each
PARTS, PART_FILES = 3, 4


def _message_parts(df: DataFrame, folder: str, backwards: bool = False) -> str:
    """All messages in parts by their number, sent in this order: a part is a micro-batch
    of several files where ``files_per_trigger`` is ``PART_FILES``."""
    first, last = df.agg(F.min("seq"), F.max("seq")).first()
    cuts = [first + (last + 1 - first) * i // PARTS for i in range(PARTS + 1)]
    for low, high in sorted(zip(cuts[:-1], cuts[1:], strict=True), reverse=backwards):
        part = df.where((F.col("seq") >= low) & (F.col("seq") < high))
        part.repartition(PART_FILES).write.mode("append").parquet(f"{folder}/messages")
    return f"{folder}/messages"


def _partition_loads(spark, sf_dir, purpose, send, **options):
    folder = shared_folder(spark, purpose)
    source = fx.table(spark, sf_dir, "events").withColumnRenamed("event_type", "table_name")
    tables.write_table(source, f"{folder}/source", partition_by=["table_name"])
    inbox = send(fx.messages(spark, sf_dir), folder)
    loads.run_partition_loads(
        read_messages(spark, inbox, **options), fx.EVENT_TYPES, f"{folder}/source", f"{folder}/stage", folder
    ).awaitTermination()
    staged = spark.read.parquet(f"{folder}/stage").groupBy("table_name")
    rows = staged.agg(F.count(F.lit(1)).alias("n_rows"))
    return loads.load_report(spark, folder).join(rows, "table_name")


@query
def stream_loads(spark, sf_dir):
    """Messages refresh the partitions they name; report and rows of the stage."""
    return _partition_loads(spark, sf_dir, "stream_loads", _message_folder)


@query
def stream_loads_many_files(spark, sf_dir):
    """The same messages over several micro-batches of several files."""
    return _partition_loads(
        spark, sf_dir, "stream_loads_many_files", _message_parts, files_per_trigger=PART_FILES
    )


def _run_table_loads(spark, sf_dir, purpose, send=_message_folder, **options):
    folder = shared_folder(spark, purpose)
    sources = {t: f"{sf_dir}/{t}.parquet" for t in fx.TABLE_OF_EVENT.values()}
    inbox = send(fx.table_messages(spark, sf_dir), folder)
    views, details_view = _view(folder, "{}"), _view(folder, "job_details")
    stage.refresh_stage(fx.message_details(spark, sf_dir), details_view, f"{folder}/details")
    loads.run_table_loads(
        read_messages(spark, inbox, **options), sources, views, folder, details_view, _stamp()
    ).awaitTermination()
    return folder, {t: spark.table(views.format(t)) for t in sources}, spark.table(details_view)


@query
def stream_table_loads(spark, sf_dir):
    """Messages name given tables of different columns; each is refreshed once per
    micro-batch. What follows the end mark of a batch is not loaded."""
    folder, staged, _ = _run_table_loads(spark, sf_dir, "stream_table_loads")
    rows = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows")
        for t, df in staged.items()
    ]
    return loads.load_report(spark, folder).join(reduce(DataFrame.union, rows), "table_name")


@query
def stream_details_stamped(spark, sf_dir):
    """The details after the same loads: loaded tables are stamped, the others keep theirs."""
    return _run_table_loads(spark, sf_dir, "stream_details_stamped")[2]


@query
def stream_details_many_files(spark, sf_dir):
    """The same over several micro-batches: their stamps are merged on read."""
    return _run_table_loads(
        spark, sf_dir, "stream_details_many_files", _message_parts, files_per_trigger=PART_FILES
    )[2]


@query
def stream_retention(spark, sf_dir):
    folder = shared_folder(spark, "stream_retention")
    inbox = _message_folder(fx.messages(spark, sf_dir), folder)
    loads.run_retention(read_messages(spark, inbox), folder).awaitTermination()
    return spark.read.parquet(f"{folder}/kept").select("seq", "job_name", "body")


@query
def message_retention(spark, sf_dir):
    """The same on a frame."""
    return end_mark.not_expired(fx.messages(spark, sf_dir)).select("seq", "job_name", "body")


def _until_sentinel(spark, sf_dir, purpose, send, first=None, **options):
    folder = shared_folder(spark, purpose)
    messages = fx.messages(spark, sf_dir)
    inbox = send(messages, folder)
    stream = read_messages(spark, inbox, **options)
    loads.run_until_end_mark(stream, folder, "signup", first=first).awaitTermination()
    sent = messages.where(F.col("body") != "signup").groupBy(*schemas.INSTANCE_KEY)
    return loads.batch_report(spark, folder, sent.agg(F.count(F.lit(1)).alias("expected")))


@query
def stream_until_sentinel(spark, sf_dir):
    """Batches that got their end mark: messages taken, messages sent, complete or not."""
    return _until_sentinel(spark, sf_dir, "stream_until_sentinel", _message_folder)


@query
def stream_until_sentinel_many_files(spark, sf_dir):
    """The same over several micro-batches: marks are known from those before."""
    return _until_sentinel(
        spark, sf_dir, "stream_until_sentinel_many_files", _message_parts, files_per_trigger=PART_FILES
    )


@query
def messages_until_sentinel(spark, sf_dir):
    """The messages themselves, on a frame, per user. The marks are stored first, so
    that AQE can split a hot user in the join."""
    messages, user = fx.messages(spark, sf_dir), ["job_name"]
    folder = shared_folder(spark, "messages_until_sentinel")
    tables.write_table(end_mark.end_marks(messages, F.col("body") == "signup", user), folder)
    marks = spark.read.parquet(folder)
    return end_mark.before_end_mark(messages, marks, batch=user).select("seq", "job_name", "body")


@query
def stream_until_sentinel_any_order(spark, sf_dir):
    """The same from files in the wrong order, one a micro-batch: order is restored by number."""
    first = fx.messages(spark, sf_dir).agg(F.min("seq")).first()[0]
    return _until_sentinel(
        spark, sf_dir, "stream_until_sentinel_any_order",
        lambda df, folder: _message_parts(df, folder, backwards=True), first, files_per_trigger=1,
    )


def _latest_status(spark, sf_dir, purpose, send, **options):
    folder = shared_folder(spark, purpose)
    inbox = send(fx.messages(spark, sf_dir), folder)
    run_states.run_state_log(
        read_messages(spark, inbox, **options), folder, ["job_name"], state="body"
    ).awaitTermination()
    return run_states.read_state_log(spark, folder, "job_name string")


@query
def stream_latest_status(spark, sf_dir):
    return _latest_status(spark, sf_dir, "stream_latest_status", _message_folder)


@query
def stream_latest_status_many_files(spark, sf_dir):
    """The same over many micro-batches, one a file; the log of changes is folded."""
    return _latest_status(
        spark, sf_dir, "stream_latest_status_many_files", _message_parts, files_per_trigger=1
    )


@query
def stream_run_timeouts(spark, sf_dir):
    """How runs ended: by their first final state, or after 180 minutes without one."""
    folder = shared_folder(spark, "stream_run_timeouts")
    states = {"purchase": "SUCCEEDED", "error": "FAILED"}
    status = F.coalesce(*[F.when(F.col("body") == b, s) for b, s in states.items()], F.lit("RUNNING"))
    reports = fx.messages(spark, sf_dir).withColumn("status", status).drop("body")
    inbox = _message_folder(reports, folder)
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in reports.schema)
    run_timeouts.run_timeouts(read_messages(spark, inbox, types), folder).awaitTermination()
    return run_timeouts.read_outcomes(spark, folder)
