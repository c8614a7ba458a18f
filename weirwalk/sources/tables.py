"""Readers and ingest checks for the three logical tables, and the passage sink.

Detections are best kept in ``sources.detection_store``; exported tables are read by
``sources.exports``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirwalk import schema
from weirwalk.functions.features import required

#: Files that a task of the sink may have open at a time.
OPEN_FILES = 16


def checked_detections(rows: DataFrame) -> DataFrame:
    """Detections with tags checked and site names trimmed."""
    return rows.withColumns({"tag_code": required("tag_code"), "site_name": F.trim("site_name")})


def checked_tagging(rows: DataFrame) -> DataFrame:
    """Tagging rows with tags checked."""
    return rows.withColumn("tag_code", required("tag_code"))


def checked_passage(rows: DataFrame) -> DataFrame:
    """Passage rows with tags checked.

    That a key occurs once per checkpoint is checked where the rows are grouped
    by tag anyway, see ``plans.wide``.
    """
    return rows.withColumn("tag_code", required("tag_code"))


def read_detections(spark: SparkSession, path: str) -> DataFrame:
    """Detections from any Parquet files; sites are trimmed here, so filters on them are not pushed."""
    return checked_detections(spark.read.schema(schema.DETECTIONS).parquet(path))


def read_tagging(spark: SparkSession, path: str) -> DataFrame:
    return checked_tagging(spark.read.schema(schema.TAGGING).parquet(path))


def read_passage(spark: SparkSession, path: str) -> DataFrame:
    return checked_passage(spark.read.schema(schema.PASSAGE).parquet(path))


def write_passage(rows: DataFrame, path: str) -> None:
    """Write passage tables to a fresh path, all or nothing.

    An existing path is an error, so the tables being read are never replaced,
    and a failed job leaves no success marker. The rebalance hint gives every
    (basin, run) a file count that follows its size: a large population is split
    over many tasks and small ones do not become thousands of small files.
    """
    # Few populations meet in a task, so their files are open side by side; else Spark first
    # sorts, and holds, all rows of the task. Beyond that number it sorts the rest.
    conf, key = rows.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(key)
    conf.set(key, OPEN_FILES)
    try:
        (
            rows.hint("rebalance", "basin", "run")
            .write.mode("errorifexists")
            .partitionBy("basin", "run")
            .parquet(path)
        )
    finally:
        conf.set(key, before)
