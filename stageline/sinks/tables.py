"""Writers for converted tables and for touched partitions."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stageline.session import drop_path, path_exists, shared_folder
from stageline.sources.files import increment, outside, read_csv


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Iterable[str] = ()
) -> None:
    """Replace what is at ``path``; snappy.

    A partitioned write is rebalanced by its partition columns first: each folder
    gets few files, and AQE splits a value that holds much of the data over many
    tasks instead of one.
    """
    by = list(partition_by)
    if by:
        df = df.hint("rebalance", *by)
    writer = df.write.format(fmt).option("compression", "snappy").mode("overwrite")
    (writer.partitionBy(*by) if by else writer).save(path)


def overwrite_partitions(df: DataFrame, path: str, by: Iterable[str]) -> None:
    """Replace only the partitions that occur in ``df``; the others stay.

    ``df`` holds all rows of its partitions; ``load_increment`` is for bounds that
    cut one.
    """
    by = list(by)
    (
        df.hint("rebalance", *by)
        .write.format("parquet")
        .option("compression", "snappy")
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .partitionBy(*by)
        .save(path)
    )


def load_increment(
    df: DataFrame,
    path: str,
    by: Iterable[str],
    column: str,
    since: str = "",
    until: str = "",
    listed: DataFrame | None = None,
) -> None:
    """Bring the rows of ``[since, until)`` into the partitioned table at ``path``.

    After it the table holds, of that time, what ``df`` holds: rows that the source has
    lost go, also where it has none left in their partition. The bounds may cut
    partitions: what a touched partition holds outside of them stays, so increments may
    come in any order and be repeated. ``listed`` names the partitions that the source
    still has, by their columns; others are dropped whole, whatever their time.

    Only touched partitions are read back (the join prunes the folders by a small stored
    table of their values) and written anew; they are swapped in when all tasks are done,
    so that a failed load leaves the table as it was. Partitions without rows are removed
    after that, and found again if that fails.
    """
    by = list(by)
    new = increment(df, column, since, until)
    spark = df.sparkSession
    if not path_exists(spark, path):
        overwrite_partitions(new, path, by)
        return
    held = spark.read.schema(new.schema).parquet(path).select(*new.columns)
    touched = _touched(new, increment(held, column, since, until), by)
    kept = outside(_in_partitions(held, touched, by), column, since, until)
    overwrite_partitions(new.unionByName(kept), path, by)
    lost = touched.where("not _sent")
    if not lost.isEmpty():
        rows = _in_partitions(_with_file(spark.read.schema(new.schema).parquet(path)), lost, by)
        rest = outside(rows, column, since, until).select("_file").distinct()
        _drop_folders(rows.select("_file").distinct().join(rest, "_file", "left_anti"))
    if listed is not None:
        rows = _with_file(spark.read.schema(new.schema).parquet(path))
        _drop_folders(rows.join(listed.select(*by), _same(rows, listed, by), "left_anti").select("_file").distinct())


def _touched(new: DataFrame, replaced: DataFrame, by: list[str]) -> DataFrame:
    """The partitions that have rows of the increment, at the source (``_sent``) or held,
    and how many (``_n``); stored, so that Spark knows how few they are. One row per partition."""
    sides = [rows.select(*by, F.lit(sent).alias("_sent")) for rows, sent in ((new, True), (replaced, False))]
    path = shared_folder(new.sparkSession, "touched")
    totals = F.max("_sent").alias("_sent"), F.count(F.lit(1)).alias("_n")
    sides[0].unionByName(sides[1]).groupBy(*by).agg(*totals).write.parquet(path)
    return new.sparkSession.read.parquet(path)


def _same(left: DataFrame, right: DataFrame, by: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in by])


def _in_partitions(held: DataFrame, partitions: DataFrame, by: list[str]) -> DataFrame:
    """The held rows in the given partitions. Equality lets the join prune folders; null
    partitions, which are equal to nothing, come by a branch of their own."""
    names = [f"_{c}" for c in by]
    # Spark prunes folders by a side that it holds to be selective: one with a comparison
    partitions = partitions.where("_n > 0").select(*[F.col(c).alias(n) for c, n in zip(by, names, strict=True)])
    has_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in by])
    plain = reduce(lambda a, b: a & b, [F.col(c) == F.col(n) for c, n in zip(by, names, strict=True)])
    nulls = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(by, names, strict=True)])
    some = partitions.where(reduce(lambda a, b: a | b, [F.col(n).isNull() for n in names]))
    return held.join(partitions, plain, "left_semi").unionByName(held.where(has_null).join(some, nulls, "left_semi"))


def _with_file(rows: DataFrame) -> DataFrame:
    """With the folder of each row's file."""
    return rows.withColumn("_file", F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", ""))


def _drop_folders(folders: DataFrame) -> None:
    """Remove partition folders: their names, not their rows, reach the driver."""
    for (folder,) in folders.collect():
        drop_path(folders.sparkSession, unquote(folder, errors="strict"))


def write_buckets(
    df: DataFrame, table: str, path: str, buckets: int, key: Sequence[str]
) -> None:
    """Replace the table, stored by the hash of ``key``, one sorted file per bucket.

    Joins of tables with the same buckets on this key read them in place, without
    a shuffle. For keys that hold each value once, such as job names: all rows of
    one value go to one file.
    """
    (
        df.repartition(buckets, *key)
        .write.format("parquet")
        .option("compression", "snappy")
        .option("path", path)
        .bucketBy(buckets, *key)
        .sortBy(*key)
        .mode("overwrite")
        .saveAsTable(table)
    )


def convert_table(
    spark: SparkSession, source: str, target: str, fmt: str = "parquet", schema=None, **options
) -> None:
    """CSV folder or glob to a table at ``target``: one map-only job."""
    write_table(read_csv(spark, source, schema, **options), target, fmt)


def in_flight(jobs: Iterable[Callable[[], None]], spark: SparkSession, limit: int = 4) -> None:
    """Run independent Spark jobs a few at a time, so that the tail of one table
    does not leave the cluster idle. The first error is raised."""
    with ThreadPoolExecutor(limit) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        for job in running:
            job.result()


def convert_tables(
    spark: SparkSession,
    tables: Iterable[str],
    source_template: str,
    target_template: str,
    fmt: str = "parquet",
    schemas: Mapping[str, StructType | str] | None = None,
    options: Mapping[str, Mapping[str, object]] | None = None,
) -> DataFrame:
    """Convert each table; paths come from templates with ``{}`` for the name.

    ``schemas`` and ``options`` (those of the CSV reader: separator, quote, multiLine and
    so on) are per table; a table without keeps the defaults. Options of a table that is
    not converted are an error. Returns the row count per written table, read back from
    the file footers.
    """
    tables = list(tables)
    schemas, options = schemas or {}, options or {}
    if unknown := (set(schemas) | set(options)) - set(tables):
        raise ValueError(f"not among the tables: {sorted(unknown)}")

    def job(table):
        source, target = source_template.format(table), target_template.format(table)
        return lambda: convert_table(spark, source, target, fmt, schemas.get(table), **options.get(table, {}))

    in_flight([job(t) for t in tables], spark)
    return table_counts(spark, {t: target_template.format(t) for t in tables}, fmt)


def table_counts(spark: SparkSession, paths: Mapping[str, str], fmt: str = "parquet") -> DataFrame:
    """``table_name``, ``n_rows`` of each path."""
    counts = [
        spark.read.format(fmt)
        .load(path)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(table).alias("table_name"), "n_rows")
        for table, path in paths.items()
    ]
    return reduce(DataFrame.union, counts)
