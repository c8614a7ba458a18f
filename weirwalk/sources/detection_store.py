"""Detections as Parquet that a filter on sites reads little of.

Files lie by species group and source. Within them rows are ranged by site, then tag and
time, and row groups are small: a site is in few row groups, and the site ranges in
their footers let a scan leave out the rest. A site that holds a third of all rows
is spread over several ranges, because the tag and the time are part of the range.

Tags are checked and sites trimmed when rows are written. So the reader compares the
column as it is stored, which is what lets a filter reach the footers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirwalk import schema
from weirwalk.functions.features import known_source, required
from weirwalk.sources.tables import checked_detections

PARTITIONED_BY = ("species_group", "source")
RANGED_BY = ("site_name", "tag_code", "obs_time")
#: Bytes of a row group in memory: some hundred thousand rows.
ROW_GROUP_BYTES = 16 << 20


def write_detections(rows: DataFrame, path: str, row_group_bytes: int = ROW_GROUP_BYTES) -> None:
    """Store detections in a fresh folder. A NULL tag and an unknown source fail the job."""
    order = [*PARTITIONED_BY, *RANGED_BY]
    checked = checked_detections(rows).withColumn("source", known_source())
    (
        checked.select(*schema.DETECTIONS.fieldNames())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode("errorifexists")
        .option("parquet.block.size", row_group_bytes)
        .partitionBy(*PARTITIONED_BY)
        .parquet(path)
    )


def read_detections(spark: SparkSession, path: str) -> DataFrame:
    """Detections that ``write_detections`` stored; filters on site, species group and source are pushed."""
    rows = spark.read.schema(schema.DETECTIONS).parquet(path)
    return rows.withColumn("tag_code", required("tag_code")).select(
        *[F.col(name) for name in schema.DETECTIONS.fieldNames()]
    )
