"""Passage tables in versions: a whole new version is written, then one pointer is switched.

``root/v-NNNNNN-…`` holds one version, ``root/CURRENT`` the name of the one that is
valid. A job that fails leaves the pointer, and with it every reader, at the version
before. Paths go through Hadoop's file systems, so any that Spark can write to will do;
the switch is one rename, atomic where the file system's rename is.
"""

from __future__ import annotations

import uuid

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession

from weirwalk.sources.tables import read_passage, write_passage

POINTER = "CURRENT"


class PublicationConflict(RuntimeError):
    """Another version became valid meanwhile."""


def _path(spark: SparkSession, path: str) -> JavaObject:
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, root: str) -> JavaObject:
    return _path(spark, root).getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, root: str) -> list[str]:
    """The complete versions, oldest first: folders whose job has finished."""
    fs = _file_system(spark, root)
    if not fs.exists(_path(spark, root)):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(_path(spark, root)) if s.isDirectory()]
    return sorted(
        n for n in names if n.startswith("v-") and fs.exists(_path(spark, f"{root}/{n}/_SUCCESS"))
    )


def current_version(spark: SparkSession, root: str) -> str | None:
    """The valid version, None before the first one."""
    fs, pointer = _file_system(spark, root), _path(spark, f"{root}/{POINTER}")
    if not fs.exists(pointer):
        return None
    stream = fs.open(pointer)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def switch_to(spark: SparkSession, root: str, version: str) -> None:
    """Make a complete version the valid one: forward after a write, or back to an earlier one."""
    if version not in versions(spark, root):
        raise ValueError(f"no complete version {version} in {root}")
    fs = _file_system(spark, root)
    made = _path(spark, f"{root}/.{POINTER}.{uuid.uuid4().hex}")
    out = fs.create(made, False)
    out.write(bytearray(version.encode()))
    out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    over = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    over[0] = getattr(hadoop, "Options$Rename").OVERWRITE
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(made, _path(spark, f"{root}/{POINTER}"), over)


def publish_passage(rows: DataFrame, root: str, based_on: str | None = None) -> str:
    """Write the passage tables as a new version and make it the valid one; returns its name.

    Rows may come from the version that is valid now: it is never touched. With
    ``based_on``, the version that the rows were made from, a version that became valid
    since is not switched away from; the new one is then complete but not valid.
    """
    spark = rows.sparkSession
    before = versions(spark, root)
    number = int(before[-1].split("-")[1]) + 1 if before else 1
    version = f"v-{number:06d}-{uuid.uuid4().hex[:8]}"
    write_passage(rows, f"{root}/{version}")
    valid = current_version(spark, root)
    if based_on is not None and valid != based_on:
        raise PublicationConflict(f"{valid} became valid, {version} was made from {based_on}")
    switch_to(spark, root, version)
    return version


def read_published(spark: SparkSession, root: str, version: str | None = None) -> DataFrame:
    """The valid version, or the one asked for."""
    version = version or current_version(spark, root)
    if version is None:
        raise ValueError(f"nothing is published in {root}")
    return read_passage(spark, f"{root}/{version}")


def expire_versions(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete all but the newest complete versions and the valid one; returns what went.

    Jobs that still read an older version fail, so keep as many as run at a time.
    """
    old = versions(spark, root)
    old = [v for v in old[: max(0, len(old) - keep)] if v != current_version(spark, root)]
    fs = _file_system(spark, root)
    for version in old:
        fs.delete(_path(spark, f"{root}/{version}"), True)
    return old
