"""Sources and sinks: CSV, formats, partitions, stage tables, control tables."""

import datetime

import pytest
from pyspark.sql import functions as F

from stageline import schemas
from stageline.operators.end_mark import not_expired
from stageline.registry import fixtures as fx
from stageline.session import shared_folder
from stageline.sinks.stage import live_slot, refresh_stage, truncate_stage
from stageline.sinks.tables import (
    _in_partitions,
    convert_table,
    convert_tables,
    load_increment,
    overwrite_partitions,
    write_table,
)
from stageline.sources import control
from stageline.sources.files import increment, read_csv, read_jdbc, read_listing, read_partitions


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def files_in(spark, path, pattern):
    return [r[0] for r in spark.read.format("binaryFile").option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", True).load(path).select("path").collect()]


def test_csv_infers_types_and_keeps_nulls(spark, shared):
    text = spark.createDataFrame(
        [("k,n,x,t,s",), ("1,2,2.5,2024-01-02 03:04:05,a",), (',"3",,2024-01-03 00:00:00,"q,""r"" é"',)],
        "value string",
    )
    text.coalesce(1).write.text(f"{shared}/in")
    df = read_csv(spark, f"{shared}/in/*.txt", escape='"')
    assert [t for _, t in df.dtypes] == ["int", "int", "double", "timestamp", "string"]
    assert rows(df) == rows(
        spark.createDataFrame(
            [
                (1, 2, 2.5, datetime.datetime(2024, 1, 2, 3, 4, 5), "a"),
                (None, 3, None, datetime.datetime(2024, 1, 3), 'q,"r" é'),
            ],
            df.schema,
        )
    )


def test_convert_is_snappy_and_replaces(spark, shared):
    for n in (3, 2):
        csv = f"{shared}/csv{n}"
        spark.range(n).write.option("header", True).csv(csv)
        convert_table(spark, f"{csv}/*.csv", f"{shared}/out", schema="id bigint")
    assert rows(spark.read.parquet(f"{shared}/out")) == [(0,), (1,)]
    assert files_in(spark, f"{shared}/out", "*.snappy.parquet")


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_convert_many_formats(spark, shared, fmt):
    for name, n in [("one", 1), ("many", 25)]:
        spark.range(n).write.option("header", True).csv(f"{shared}/csv/{name}")
    counts = convert_tables(
        spark, ["one", "many"], shared + "/csv/{}/*.csv", shared + "/out/{}", fmt, {"one": "id bigint"}
    )
    assert rows(counts) == [("many", 25), ("one", 1)]


def test_convert_many_raises(spark, shared):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        convert_tables(spark, ["gone"], shared + "/csv/{}/*.csv", shared + "/out/{}")


def test_conversion_does_not_shuffle(spark, shared):
    spark.range(5).write.option("header", True).csv(f"{shared}/csv")
    assert "Exchange" not in plan_text(read_csv(spark, f"{shared}/csv", "id bigint"))


def test_listing_keeps_all_pages(spark, shared):
    names = spark.range(2500).select(F.concat(F.lit("job_"), "id").alias("job_name"))
    names.coalesce(1).write.option("maxRecordsPerFile", 1000).parquet(shared)
    names.limit(1).write.mode("append").parquet(shared)
    listed = read_listing(spark, shared, "job_name string")
    assert len(files_in(spark, shared, "*.parquet")) == 4
    assert listed.count() == 2501 and listed.distinct().count() == 2500


def test_partition_predicate_prunes(spark, sf_dir, shared):
    events = fx.table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    write_table(events, shared, partition_by=["day"])
    day = read_partitions(spark, shared, "day = date '2024-01-02'").select("event_id")
    assert "PartitionFilters: [isnotnull(day" in plan_text(day)
    assert "ReadSchema: struct<event_id:bigint>" in plan_text(day)
    assert rows(day) == rows(events.where("day = date '2024-01-02'").select("event_id"))
    assert read_partitions(spark, shared).count() == events.count()


def test_partitioned_write_splits_a_hot_partition(spark, shared):
    """A value with most of the rows is written by many tasks, the others by one each."""
    df = spark.range(300_000).select(
        "id", F.sha2(F.col("id").cast("string"), 256).alias("text"),
        F.when(F.col("id") % 10 < 7, 0).otherwise(F.col("id") % 10).alias("part"),
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "1m")
    try:
        write_table(df, shared, partition_by=["part"])
    finally:
        spark.conf.unset(key)
    assert len(files_in(spark, f"{shared}/part=0", "*.parquet")) > 4
    assert len(files_in(spark, f"{shared}/part=8", "*.parquet")) <= 4
    assert spark.read.parquet(shared).agg(F.count("id"), F.sum("id")).first() == (
        300_000,
        300_000 * 299_999 // 2,
    )


def test_overwrite_touches_only_its_partitions(spark, shared):
    df = spark.range(10).select("id", (F.col("id") % 3).alias("part"))
    overwrite_partitions(df, shared, ["part"])
    overwrite_partitions(spark.createDataFrame([(99, 1)], "id bigint, part bigint"), shared, ["part"])
    assert sorted(r["id"] for r in spark.read.parquet(shared).collect()) == [0, 2, 3, 5, 6, 8, 9, 99]


def test_increments_keep_the_rest_of_a_partition(spark, shared):
    months = spark.range(12).select(
        "id", F.make_date(F.lit(1996), F.col("id").cast("int") + 1, F.lit(1)).alias("day"), F.lit(1996).alias("year")
    )
    months = months.unionByName(spark.createDataFrame([(99, None, None)], "id bigint, day date, year int"))
    load_increment(months.where("id = 99"), shared, ["year"], "day")
    for since, until in [("1996-07-01", "1997-01-01"), ("", "1996-04-01"), ("1996-04-01", "1996-07-01"),
                         ("1996-07-01", "1997-01-01")]:
        load_increment(months, shared, ["year"], "day", since, until)
    assert sorted(r["id"] for r in spark.read.parquet(shared).collect()) == [*range(12), 99]
    # rows that the increment no longer has go, where it has others in their partition
    load_increment(months.where("id <> 8"), shared, ["year"], "day", "1996-07-01")
    assert sorted(r["id"] for r in spark.read.parquet(shared).collect()) == [*(i for i in range(12) if i != 8), 99]


def test_each_table_has_its_csv_options(spark, shared):
    """A quoted table with line breaks in its fields, one with another separator, a plain one."""
    files = {
        "notes": 'k,text\n1,"two\nlines, ""quoted"""\n2,plain\n',
        "pipes": "k|x\n1|2.5\n",
        "plain": "k,x\n7,a\n",
    }
    for name, text in files.items():
        spark.createDataFrame([(text[:-1],)], "value string").coalesce(1).write.option("lineSep", "\n").text(f"{shared}/in/{name}")
    options = {"notes": {"multiLine": True, "escape": '"'}, "pipes": {"sep": "|"}}
    counts = convert_tables(
        spark, files, shared + "/in/{}/*.txt", shared + "/out/{}", schemas={"pipes": "k long, x double"}, options=options
    )
    assert {r["table_name"]: r["n_rows"] for r in counts.collect()} == {"notes": 2, "pipes": 1, "plain": 1}
    assert rows(spark.read.parquet(f"{shared}/out/notes")) == [(1, 'two\nlines, "quoted"'), (2, "plain")]
    assert rows(spark.read.parquet(f"{shared}/out/pipes")) == [(1, 2.5)]
    assert dict(spark.read.parquet(f"{shared}/out/pipes").dtypes) == {"k": "bigint", "x": "double"}
    with pytest.raises(ValueError, match="typo"):
        convert_tables(spark, files, shared + "/in/{}", shared + "/again/{}", options={"typo": {}})


def by_id(spark, path):
    return sorted(r["id"] for r in spark.read.parquet(path).collect())


def test_rows_the_source_has_lost_go(spark, shared):
    """Also where the source has none left in their partition; what is out of bounds stays."""
    rows = [(i, f"a b/{i % 4}" if i % 4 else None, f"2020-01-{i % 28 + 1:02d}") for i in range(60)]
    df = spark.createDataFrame(rows, "id int, p string, day string").withColumn("day", F.to_date("day"))
    load_increment(df, shared, ["p"], "day")
    some = df.where("p in ('a b/1', 'a b/2')")
    load_increment(some, shared, ["p"], "day", "2020-01-02", "2020-01-04")
    inside = "day >= '2020-01-02' and day < '2020-01-04'"
    want = df.where(f"not ({inside}) or p in ('a b/1', 'a b/2')")
    assert by_id(spark, shared) == sorted(r["id"] for r in want.collect())
    # the whole time: partitions without rows are removed, null and escaped names too
    load_increment(some, shared, ["p"], "day")
    assert by_id(spark, shared) == sorted(r["id"] for r in some.collect())
    assert {r[0] for r in spark.read.parquet(shared).select("p").distinct().collect()} == {"a b/1", "a b/2"}
    # partitions that the source lists no more are dropped whole
    load_increment(some, shared, ["p"], "day", "2020-01-01", "2020-01-02", listed=some.where("p = 'a b/2'"))
    assert by_id(spark, shared) == sorted(r["id"] for r in some.where("p = 'a b/2'").collect())


def test_increment_reads_back_touched_partitions_only(spark, shared):
    df = spark.range(40).select("id", (F.col("id") % 4).alias("p"), (F.col("id") % 2 == 0).alias("even"))
    load_increment(df.withColumn("day", F.current_date()), shared, ["p"], "day")
    held = spark.read.schema("id long, even boolean, day date, p long").parquet(shared)
    touched = spark.createDataFrame([(1, 5)], "p long, _n long")
    touched.write.parquet(f"{shared}-touched")
    back = _in_partitions(held, spark.read.parquet(f"{shared}-touched"), ["p"])
    assert "dynamicpruningexpression(p#" in plan_text(back)
    assert sorted(r["id"] for r in back.collect()) == list(range(1, 40, 4))
    assert max(rows_from_scans(back._jdf.queryExecution().executedPlan())) == 10  # of 40


def test_increment_bounds(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders")
    day = orders.select(F.percentile(F.unix_timestamp("o_orderdate"), 0.5)).first()[0]
    day = str(datetime.datetime.fromtimestamp(day, datetime.UTC).date())
    before, after = increment(orders, "o_orderdate", until=day), increment(orders, "o_orderdate", since=day)
    assert before.count() and after.count()
    assert before.count() + after.count() == orders.count() == increment(orders, "o_orderdate").count()
    assert after.where(F.col("o_orderdate") == F.lit(day)).count() == orders.where(
        F.col("o_orderdate") == F.lit(day)
    ).count()
    text = plan_text(after.select("o_orderkey"))
    assert "GreaterThanOrEqual(o_orderdate," in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


def rows_from_scans(plan):
    """Rows that leave the Parquet scans of an executed plan."""
    kind = plan.getClass().getSimpleName()
    if kind.startswith("AdaptiveSparkPlan"):
        return rows_from_scans(plan.executedPlan())
    if "QueryStage" in kind:
        return rows_from_scans(plan.plan())
    if "FileSourceScan" in kind:
        return [plan.metrics().apply("numOutputRows").value()]
    children = plan.children()
    return sum((rows_from_scans(children.apply(i)) for i in range(children.size())), [])


def test_time_bounds_skip_row_groups(spark, sf_dir, shared):
    events = fx.messages(spark, sf_dir).withColumn("sent", F.col("sent").cast("timestamp"))
    small = {"parquet.block.size": 2048, "parquet.page.size.row.check.min": 10}
    events.orderBy("sent").coalesce(1).write.options(**small).parquet(shared)
    stored = spark.read.parquet(shared)
    for kept in (increment(stored, "sent", "2024-01-29"), not_expired(stored)):
        n = len(kept.collect())
        (scanned,) = rows_from_scans(kept._jdf.queryExecution().executedPlan())
        assert 0 < n <= scanned < stored.count() / 2


def test_stage_refresh(spark, shared):
    view = f"stage_{shared.rsplit('-', 1)[-1]}"
    assert live_slot(spark, view) is None
    slots = []
    for n in (3, 5, 4):
        assert refresh_stage(spark.range(n), view, shared).count() == n
        slots.append(live_slot(spark, view))
    assert slots == ["a", "b", "a"]
    # a refresh may read the table itself
    assert refresh_stage(spark.table(view).where("id > 0"), view, shared).count() == 3


def test_failed_refresh_leaves_the_table(spark, shared):
    view = f"stage_{shared.rsplit('-', 1)[-1]}"
    refresh_stage(spark.range(3), view, shared)
    bad = spark.range(5).select(F.raise_error(F.lit("lost")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="lost"):
        refresh_stage(bad, view, shared)
    assert spark.table(view).count() == 3
    assert refresh_stage(spark.range(4), view, shared).count() == 4


def test_bucketed_stage_joins_without_shuffle(spark, sf_dir, shared):
    from stageline.plans.sync import plan_changes

    tag = shared.rsplit("-", 1)[-1]
    views = {"jobs": fx.jobs(spark, sf_dir), "listed": fx.listed(spark, sf_dir).select("job_name")}
    plain = plan_changes(*views.values()).select("job_name", "action")
    for _ in range(3):
        stored = [
            refresh_stage(df, f"{name}_{tag}", f"{shared}/{name}", 4, ["job_name"])
            for name, df in views.items()
        ]
    bucketed = plan_changes(*stored).select("job_name", "action")
    assert "Exchange" not in plan_text(bucketed)
    assert "Exchange" in plan_text(plain)
    assert rows(bucketed) == rows(plain)
    assert len(files_in(spark, f"{shared}/jobs/a", "*.parquet")) == 4


def test_truncate_keeps_columns(spark, sf_dir, shared):
    view = f"stage_{shared.rsplit('-', 1)[-1]}"
    supplier = fx.table(spark, sf_dir, "supplier")
    refresh_stage(supplier, view, shared)
    empty = truncate_stage(spark, view, shared)
    assert empty.count() == 0
    assert empty.dtypes == supplier.dtypes


def test_truncate_keeps_buckets(spark, shared):
    views = [f"stage_{n}_{shared.rsplit('-', 1)[-1]}" for n in "ab"]
    for view in views:
        refresh_stage(spark.range(9), view, f"{shared}/{view}", 4, ["id"])
    empty = truncate_stage(spark, views[0], f"{shared}/{views[0]}")
    assert "Exchange" not in plan_text(empty.join(spark.table(views[1]).hint("merge"), "id"))


def test_control_tables(spark, shared):
    database = f"control_{shared.rsplit('-', 1)[-1]}"
    control.create_control_tables(spark, database, shared)
    for name, schema in schemas.TABLES.items():
        stored = spark.table(f"{database}.{name}").dtypes
        assert stored == [(f.name, f.dataType.simpleString()) for f in schema]
    jobs = spark.createDataFrame([("j", "{}")], "job_name string, job_param string")
    control.append_rows(jobs, f"{database}.jobs")
    row = control.scan_control(spark, database, "jobs").first()
    assert (row["is_active"], row["is_run_sync"]) == ("N", "N")
    assert str(row["last_sync_timestamp"]) == schemas.NEVER_SYNCED
    assert row["created_timestamp"] is not None and row["job_description"] is None
    # made only if absent
    control.create_control_tables(spark, database, shared)
    assert control.scan_control(spark, database, "jobs").count() == 1
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        control.append_rows(jobs.withColumn("job_name", F.repeat(F.lit("x"), F.lit(51))), f"{database}.jobs")


def test_jdbc_options(spark):
    """No database here: only that the reader is asked for and reports the missing driver."""
    with pytest.raises(Exception, match="[Dd]river"):
        read_jdbc(spark, "jdbc:none:x", "jobs", "id", "0", "10", 4)


def test_shared_folder_is_the_named_one(spark):
    a, b = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert a != b and a.startswith(spark.conf.get("spark.checkpoint.dir"))
