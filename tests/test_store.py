"""The detection store: what a filter on sites reads, and what is refused."""

import glob
import re

import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.rows import GOJ, JDJ, day, detection, frames
from weirwalk import fixed_values as fv
from weirwalk import schema
from weirwalk.operators.aggregates import last_obs, last_obs_by_source, last_obs_in_season
from weirwalk.sources import driver_tables
from weirwalk.sources.detection_store import read_detections, write_detections


@pytest.fixture(scope="module")
def path(spark, small_dir, tmp_path_factory):
    found = str(tmp_path_factory.mktemp("store") / "detections")
    write_detections(driver_tables.detections(spark, small_dir), found, row_group_bytes=2048)
    return found


@pytest.fixture()
def whole_names(spark):
    for key, value in (("spark.sql.maxMetadataStringLength", "100000"), ("spark.sql.adaptive.enabled", "false")):
        spark.conf.set(key, value)
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    spark.conf.unset("spark.sql.adaptive.enabled")


def executed(frame):
    return frame._jdf.queryExecution().executedPlan()


def rows_read(frame):
    """Rows that the scan decoded."""
    plan = executed(frame)
    frame._jdf.queryExecution().toRdd().count()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_rows_come_back(spark, small_dir, path):
    wanted = driver_tables.detections(spark, small_dir).select(*schema.DETECTIONS.fieldNames())
    got = read_detections(spark, path)
    assert got.columns == wanted.columns
    assert got.exceptAll(wanted).isEmpty() and wanted.exceptAll(got).isEmpty()


@pytest.mark.parametrize(
    "query",
    [
        lambda det: det.filter(F.col("site_name") == GOJ),
        lambda det: last_obs(det, fv.dam_site_names("MCN")),
        lambda det: last_obs_in_season(det, fv.dam_site_names("LGS"), "spring"),
        lambda det: last_obs_by_source(det, fv.dam_site_names("LMN")),
    ],
)
def test_site_filters_reach_the_footers(spark, path, whole_names, query):
    det = read_detections(spark, path)
    plan = executed(query(det)).toString()
    assert re.search(r"PushedFilters: \[[^\]]*(In|EqualTo)\(site_name", plan), plan
    assert rows_read(query(det)) < det.count() / 2


def test_sites_lie_in_few_row_groups(path):
    groups = [
        pq.ParquetFile(file).metadata.row_group(i).column(1)
        for file in glob.glob(f"{path}/**/*.parquet", recursive=True)
        for i in range(pq.ParquetFile(file).metadata.num_row_groups)
    ]
    assert {g.path_in_schema for g in groups} == {"site_name"} and len(groups) > 20
    held = [g for g in groups if g.statistics.min <= GOJ <= g.statistics.max]
    assert 0 < len(held) < len(groups) / 2


def test_species_group_and_source_prune_files(spark, path, whole_names):
    det = read_detections(spark, path)
    part = det.filter((F.col("species_group") == "STH") & (F.col("source") == "lgr_release"))
    assert rows_read(part) == part.count() < det.count() / 4


def test_a_hot_site_is_spread_over_files(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    rows = spark.range(20000).select(
        F.concat(F.lit("T"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))).alias("tag_code"),
        F.lit(GOJ).alias("site_name"),
        F.lit(None).cast("string").alias("antenna_group"),
        F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("obs_time"),
        F.lit(2014).alias("migration_year"),
        F.lit("main").alias("source"),
        F.lit("CHK").alias("species_group"),
    )
    try:
        write_detections(rows, str(tmp_path / "hot"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{tmp_path}/hot/**/*.parquet", recursive=True)]
    assert len(sizes) >= 6 and max(sizes) < 2 * 20000 / len(sizes)


def test_sites_are_trimmed_and_tags_checked(spark, tmp_path):
    rows = [detection("T1", f" {GOJ} ", day(5, 1)), detection("T2", None, None, None, None)]
    write_detections(frames(spark, rows, [], [])[0], str(tmp_path / "a"))
    back = read_detections(spark, str(tmp_path / "a"))
    assert [r["tag_code"] for r in back.filter(F.col("site_name") == GOJ).collect()] == ["T1"]
    assert back.count() == 2
    for bad, said in ((detection(None, JDJ, day(5, 1)), "must not be NULL"), (detection("T", JDJ, day(5, 1), source="x"), "unknown source")):
        with pytest.raises(PySparkException, match=said):
            write_detections(frames(spark, [bad], [], [])[0], str(tmp_path / "b"))
    with pytest.raises(PySparkException, match="already exists"):
        write_detections(frames(spark, rows, [], [])[0], str(tmp_path / "a"))


def test_an_empty_table(spark, tmp_path):
    write_detections(frames(spark, [], [], [])[0], str(tmp_path / "none"))
    assert read_detections(spark, str(tmp_path / "none")).count() == 0
