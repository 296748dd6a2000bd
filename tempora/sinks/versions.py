"""Versioned tables: readers follow a pointer, writers swap it after the commit.

A root holds one folder for each version (``data-<n>-<unique>``) and, under
``_versions``, one small manifest for each. A version is written in full before
its manifest appears, by a rename that fails if somebody else was first; so a
reader sees the old version or the new one, never a part, and a read that has
begun goes on with the files of its own version. ``expire`` removes the data of
old versions when no reader can need them any more.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

_LOG = "_versions"


class Conflict(RuntimeError):
    """Another writer has published this version first."""


@dataclass(frozen=True)
class Version:
    number: int
    path: str
    notes: dict = field(default_factory=dict)  # what the writer recorded


def _file_system(spark: SparkSession, where: str):
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path
    return path(where).getFileSystem(sc._jsc.hadoopConfiguration()), path, sc._jvm.org.apache.commons.io.IOUtils


def _manifests(spark: SparkSession, root: str) -> list[int]:
    fs, path, _ = _file_system(spark, root)
    log = path(f"{root}/{_LOG}")
    names = [s.getPath().getName() for s in fs.listStatus(log)] if fs.exists(log) else []
    return sorted(int(n[:-5]) for n in names if n.endswith(".json"))


def current(spark: SparkSession, root: str) -> Version | None:
    """The latest published version."""
    fs, path, io = _file_system(spark, root)
    numbers = _manifests(spark, root)
    if not numbers:
        return None
    stream = fs.open(path(f"{root}/{_LOG}/{numbers[-1]}.json"))
    try:
        return Version(numbers[-1], **json.loads(io.toString(stream, "UTF-8")))
    finally:
        stream.close()


def read_current(spark: SparkSession, root: str) -> DataFrame | None:
    found = current(spark, root)
    return None if found is None else spark.read.parquet(found.path)


def publish(df: DataFrame, root: str, notes: dict | None = None, partition_by: str | None = None, after: Version | None = None) -> Version:
    """Write ``df`` as the version after ``after`` (the current one when it was
    read; None for the first) and move the pointer to it. Raises ``Conflict``,
    and leaves the pointer alone, if there is another version by then."""
    spark = df.sparkSession
    number = after.number + 1 if after else 0
    version = Version(number, f"{root}/data-{number}-{uuid.uuid4().hex[:8]}", notes or {})
    writer = df.hint("rebalance", *[partition_by] if partition_by else []).write
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(version.path)
    fs, path, _ = _file_system(spark, root)
    draft, final = path(f"{version.path}.json"), path(f"{root}/{_LOG}/{number}.json")
    fs.mkdirs(final.getParent())
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(json.dumps({"path": version.path, "notes": version.notes}).encode()))
    finally:
        stream.close()
    sc = spark.sparkContext
    context = sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), sc._jsc.hadoopConfiguration())
    try:  # a rename that doesn't overwrite
        context.rename(draft, final, sc._gateway.new_array(sc._jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Exception as exc:
        raise Conflict(f"version {number} of {root} exists") from exc
    return version


def expire(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Remove the data of all but the latest ``keep`` versions; manifests stay, so
    that numbers are not used again. Returns how many folders were removed."""
    fs, path, _ = _file_system(spark, root)
    kept, removed = set(_manifests(spark, root)[-keep:]), 0
    for status in fs.listStatus(path(root)):
        name = status.getPath().getName()
        if name.startswith("data-") and int(name.split("-")[1]) < min(kept, default=0):
            removed += fs.delete(status.getPath(), True)
    return removed


# ------------------------------------------------------- streaming roots

def compact_stream(spark: SparkSession, root: str, target: str, partition_by: str | None = None) -> Version:
    """The rows committed to a streaming root so far, written as a new version of
    ``target`` in few files, with the names of the files they came from. The
    stream may run on: what it commits later is read from its root, until the
    next compaction, which reads the version and the files since."""
    before = current(spark, target)
    files = sorted(spark.read.parquet(root).inputFiles())
    rows = _rows(spark, root, before, files)
    return publish(rows, target, {"root": root, "files": files}, partition_by, before)


def read_compacted(spark: SparkSession, root: str, target: str) -> DataFrame:
    """Every committed row of a streaming root, through its compacted version: the
    version, and those files of the root that it does not hold. The pointer is
    read before the root is listed and files never change, so a read agrees with
    the root whenever it falls."""
    version = current(spark, target)
    return _rows(spark, root, version, spark.read.parquet(root).inputFiles())


def _rows(spark: SparkSession, root: str, version: Version | None, files: list[str]) -> DataFrame:
    plain = spark.read.parquet(root)
    if version is None:
        return spark.read.schema(plain.schema).option("basePath", root).parquet(*files) if files else plain
    rows = spark.read.schema(plain.schema).parquet(version.path)
    rest = sorted(set(files) - set(version.notes["files"]))
    if rest:
        rows = rows.unionByName(spark.read.schema(plain.schema).option("basePath", root).parquet(*rest))
    return rows
