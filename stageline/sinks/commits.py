"""A commit log: numbered manifests beside the data, each put in place by one rename.

A manifest names all that belongs to a version of a table: its folders, schema, buckets.
What no manifest names is not there, so that a failed write leaves nothing that a reader
sees, and any session finds the newest version from the folder alone.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from stageline.session import drop_path, path_exists

LOG = "_log"


class CommitConflict(Exception):
    """Another writer has put the same version in place."""


def _at(spark: SparkSession, path: str):
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.makeQualified(at), files


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    if not path_exists(spark, folder):
        return []
    at, files = _at(spark, folder)
    return sorted(s.getPath().getName() for s in files.listStatus(at))


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes below a path; 0 if it is not there."""
    if not path_exists(spark, path):
        return 0
    at, files = _at(spark, path)
    return files.getContentSummary(at).getLength()


def versions(spark: SparkSession, root: str) -> list[int]:
    """The versions that have a manifest, ascending."""
    names = children(spark, f"{root}/{LOG}")
    return [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]


def _name(root: str, version: int) -> str:
    return f"{root}/{LOG}/{version:020d}.json"


def manifest(spark: SparkSession, root: str, version: int) -> dict:
    at, files = _at(spark, _name(root, version))
    stream = files.open(at)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def latest(spark: SparkSession, root: str) -> tuple[int, dict]:
    """The newest version and its manifest; 0 and an empty one where there is none."""
    known = versions(spark, root)
    return (known[-1], manifest(spark, root, known[-1])) if known else (0, {})


def commit(spark: SparkSession, root: str, version: int, content: dict) -> None:
    """Put a manifest in place, or fail if the version has one."""
    # a leading dot, so that no reader takes a half-written file for a manifest
    half, files = _at(spark, f"{root}/{LOG}/.{version}-{uuid.uuid4().hex}")
    stream = files.create(half)
    try:
        stream.write(bytearray(json.dumps(content).encode()))
    finally:
        stream.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(half.toUri(), spark._jsc.hadoopConfiguration())
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    try:
        context.rename(half, _at(spark, _name(root, version))[0], options)
    except Exception as error:
        files.delete(half, False)
        if "FileAlreadyExists" in str(error):
            raise CommitConflict(f"{root} has a version {version}") from error
        raise


def forget(spark: SparkSession, root: str, keep: int) -> list[dict]:
    """Drop the manifests before the last ``keep``; returns them. Their data is the caller's."""
    gone = []
    for version in versions(spark, root)[:-keep]:
        gone.append(manifest(spark, root, version))
        drop_path(spark, _name(root, version))
    return gone
