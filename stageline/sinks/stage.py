"""Stage tables: full refresh, truncate and keyed changes, seen by readers in one step.

Every version of a stage table is a folder of its own, and a manifest in the commit log
beside the data says which it is, with its schema, buckets and changes. A refresh writes
a new folder, commits the manifest and repoints the view: readers see the old rows or the
new ones and never a half-written table, and a failed or repeated refresh does no harm.
A session that does not know the view opens it from the log (``open_stage``). The last
``KEEP`` versions stay, so that a frame that was read survives the refreshes after it.

A keyed change (``change_stage``) writes the changed columns of the given keys only; the
view merges them on read. When the changes hold more than a given part of the bytes of
the table, they are folded into a new version.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from string import ascii_lowercase

from pyspark.sql import DataFrame, SparkSession

from stageline.session import drop_path
from stageline.sinks import commits
from stageline.sinks.tables import write_buckets, write_table

#: versions that stay readable; the newest one among them
KEEP = 4
#: changes are folded when they hold more than this part of the bytes of the table
FOLD_RATIO = 0.25
_VERSION = "stageline.version"


def _quoted(names: Sequence[str]) -> str:
    return ", ".join(f"`{n}`" for n in names)


def _folder(version: int) -> str:
    """Versions share as many folders as stay, so that one folder has one that stays."""
    return ascii_lowercase[(version - 1) % KEEP]


def live_version(spark: SparkSession, view: str) -> int:
    """Which version the view of this session shows; 0 when there is no such view."""
    if not spark.catalog.tableExists(view):
        return 0
    return int(spark.sql(f"show tblproperties {view} ('{_VERSION}')").first()["value"])


def live_slot(spark: SparkSession, view: str) -> str | None:
    """Which side the view shows, ``a`` and ``b`` by turns; None when there is no view."""
    version = live_version(spark, view)
    return "ba"[version % 2] if version else None


def _table_name(view: str, version: int) -> str:
    return f"{view}_v{version}"


def _base(spark: SparkSession, view: str, root: str, content: dict) -> str:
    """The stored rows as a name for SQL; a bucketed table is made known if it is not."""
    path = f"{root}/{content['data']}"
    if not content["buckets"]:
        return f"parquet.`{path}`"
    name, key = _table_name(view, content["base"]), _quoted(content["key"])
    spark.sql(
        f"create table if not exists {name} ({content['schema']}) using parquet "
        f"clustered by ({key}) sorted by ({key}) into {content['buckets']} buckets location '{path}'"
    )
    return name


def _merged(spark: SparkSession, base: str, root: str, content: dict) -> str:
    """SQL of the rows with the latest change of each key."""
    if not content["changes"]:
        return f"select * from {base}"
    key, columns = content["on"], content["columns"]
    numbers = ", ".join(f"'{c}'" for c in content["changes"])
    same = " and ".join(f"b.`{k}` <=> c.`{k}`" for k in key)
    names = spark.sql(f"select * from {base} limit 0").columns
    values = [f"if(c._new is null, b.`{n}`, c._new.`{n}`) as `{n}`" if n in columns else f"b.`{n}`" for n in names]
    return (
        f"select {', '.join(values)} from {base} b left join ("
        f"select {_quoted(key)}, max_by(struct({_quoted(columns)}), _change) as _new "
        f"from parquet.`{root}/{content['data']}.changes` where _change in ({numbers}) group by {_quoted(key)}) c on {same}"
    )


def _show(spark: SparkSession, view: str, root: str, version: int, content: dict) -> DataFrame:
    rows = _merged(spark, _base(spark, view, root, content), root, content)
    spark.sql(f"create or replace view {view} tblproperties ('{_VERSION}' = '{version}') as {rows}")
    return spark.table(view)


def open_stage(spark: SparkSession, view: str, root: str) -> DataFrame | None:
    """The stage table at ``root`` as it was last committed, by whichever session; None if
    it has no version. The view is made, or repointed if it shows an older version."""
    version, content = commits.latest(spark, root)
    if not version:
        return None
    if live_version(spark, view) == version:
        return spark.table(view)
    return _show(spark, view, root, version, content)


def _commit(spark: SparkSession, view: str, root: str, version: int, content: dict) -> DataFrame:
    """Commit a version, show it, and drop what only forgotten versions name."""
    commits.commit(spark, root, version, content)
    out = _show(spark, view, root, version, content)
    old = {c["data"]: c["base"] for c in commits.forget(spark, root, KEEP)}
    if old:
        named = {commits.manifest(spark, root, v)["data"] for v in commits.versions(spark, root)}
        for data, base in old.items():
            if data not in named:
                spark.sql(f"drop table if exists {_table_name(view, base)}")
                drop_path(spark, f"{root}/{data}")
                drop_path(spark, f"{root}/{data}.changes")
    return out


def refresh_stage(
    df: DataFrame, view: str, root: str, buckets: int = 0, key: Sequence[str] = ()
) -> DataFrame:
    """Replace all rows of the stage table by ``df``; returns the table.

    With ``buckets`` the rows are stored by their ``key``, see ``write_buckets``. Of two
    writers that refresh at a time one fails, and leaves the table of the other.
    """
    spark = df.sparkSession
    version = commits.latest(spark, root)[0] + 1
    data = f"{_folder(version)}/v{version}-{uuid.uuid4().hex}"
    try:
        if buckets:
            write_buckets(df, _table_name(view, version), f"{root}/{data}", buckets, key)
        else:
            write_table(df, f"{root}/{data}")
        content = {
            "data": data, "base": version, "schema": df._jdf.schema().toDDL(), "buckets": buckets, "key": list(key),
            "on": [], "columns": [], "changes": [],
        }
        return _commit(spark, view, root, version, content)
    except commits.CommitConflict:
        drop_path(spark, f"{root}/{data}")
        raise


def change_stage(
    changes: DataFrame, view: str, root: str, on: Sequence[str], ratio: float = FOLD_RATIO
) -> DataFrame:
    """Set the other columns of ``changes`` where its key is in the table; no row is added.

    ``changes`` holds each key once. Only the changes are written, not the table: what a
    change costs follows its rows. The view takes the latest change of a key, a null in it
    too. Changes of other columns or another key than those that wait, and changes beyond
    ``ratio`` of the bytes of the table, make a new version of the whole table. A change
    that is repeated gives the same table.
    """
    spark = changes.sparkSession
    version, content = commits.latest(spark, root)
    columns = [c for c in changes.columns if c not in on]
    if content["changes"] and (content["on"], content["columns"]) != (list(on), columns):
        _fold(spark, view, root)
        version, content = commits.latest(spark, root)
    number = f"{version + 1:020d}-{uuid.uuid4().hex}"
    folder = f"{root}/{content['data']}.changes"
    write_table(changes.select(*on, *columns), f"{folder}/_change={number}")
    content |= {"on": list(on), "columns": columns, "changes": [*content["changes"], number]}
    try:
        out = _commit(spark, view, root, version + 1, content)
    except commits.CommitConflict:
        drop_path(spark, f"{folder}/_change={number}")
        raise
    if commits.stored_bytes(spark, folder) > ratio * commits.stored_bytes(spark, f"{root}/{content['data']}"):
        return _fold(spark, view, root)
    return out


def _fold(spark: SparkSession, view: str, root: str) -> DataFrame:
    content = commits.latest(spark, root)[1]
    return refresh_stage(open_stage(spark, view, root), view, root, content["buckets"], content["key"])


def truncate_stage(spark: SparkSession, view: str, root: str) -> DataFrame:
    """Remove all rows of the stage table; the columns and buckets stay."""
    rows, content = open_stage(spark, view, root), commits.latest(spark, root)[1]
    return refresh_stage(rows.where("false"), view, root, content["buckets"], content["key"])


def drop_leftovers(spark: SparkSession, root: str) -> list[str]:
    """Remove the folders that no manifest names, as failed writes leave them; returns them.

    Not for a time at which another session writes to the table."""
    held = [commits.manifest(spark, root, v) for v in commits.versions(spark, root)]
    named = {c["data"] for c in held}
    changes = {f"{c['data']}.changes/_change={n}" for c in held for n in c["changes"]}
    gone = []
    for folder in ascii_lowercase[:KEEP]:
        for name in commits.children(spark, f"{root}/{folder}"):
            data = f"{folder}/{name}"
            if data.removesuffix(".changes") not in named:
                gone.append(data)
            elif data.endswith(".changes"):
                gone += [f for c in commits.children(spark, f"{root}/{data}") if (f := f"{data}/{c}") not in changes]
    for name in gone:
        drop_path(spark, f"{root}/{name}")
    return gone
