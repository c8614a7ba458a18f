"""Versions of the passage tables, and readers that never see a part of one."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.rows import frames, state
from weirwalk.sources.publish import (
    PublicationConflict,
    current_version,
    expire_versions,
    publish_passage,
    read_published,
    switch_to,
    versions,
)


@pytest.fixture()
def root(tmp_path):
    return str(tmp_path / "passage")


def passage(spark, *tags):
    return frames(spark, [], [], [state(tag, "LGS") for tag in tags])[2]


def tags(spark, root, version=None):
    return {r["tag_code"] for r in read_published(spark, root, version).collect()}


def test_nothing_published(spark, root):
    assert current_version(spark, root) is None and versions(spark, root) == []
    with pytest.raises(ValueError, match="nothing is published"):
        read_published(spark, root)


def test_a_killed_write_leaves_the_old_version(spark, root):
    first = publish_passage(passage(spark, "T1", "T2"), root)
    many = spark.range(1000).select(F.concat(F.lit("N"), "id").alias("tag_code"), "id")
    many = passage(spark).unionByName(many.drop("id"), allowMissingColumns=True)
    fails = F.when(F.col("tag_code") == "N777", F.raise_error(F.lit("killed"))).otherwise("LGS")
    with pytest.raises(PySparkException, match="killed"):
        publish_passage(many.withColumn("dam", fails.cast("string")), root)
    assert current_version(spark, root) == first and tags(spark, root) == {"T1", "T2"}
    assert versions(spark, root) == [first]
    second = publish_passage(passage(spark, "T3"), root)
    assert versions(spark, root) == [first, second] and tags(spark, root) == {"T3"}


def test_a_version_made_from_the_one_before(spark, root):
    first = publish_passage(passage(spark, "T1"), root)
    more = read_published(spark, root).unionByName(passage(spark, "T2"))
    open_before = read_published(spark, root)
    second = publish_passage(more, root, based_on=first)
    assert tags(spark, root) == {"T1", "T2"} and {r["tag_code"] for r in open_before.collect()} == {"T1"}
    with pytest.raises(PublicationConflict):
        publish_passage(passage(spark, "T9"), root, based_on=first)
    assert current_version(spark, root) == second
    switch_to(spark, root, first)
    assert tags(spark, root) == {"T1"} and tags(spark, root, second) == {"T1", "T2"}
    with pytest.raises(ValueError, match="no complete version"):
        switch_to(spark, root, "v-000009-none")


def test_old_versions_expire(spark, root):
    made = [publish_passage(passage(spark, f"T{i}"), root) for i in range(4)]
    switch_to(spark, root, made[0])
    assert expire_versions(spark, root, keep=1) == made[1:3]
    assert versions(spark, root) == [made[0], made[3]] and tags(spark, root) == {"T0"}


def test_a_task_of_the_sink_does_not_sort_its_rows(spark, root, monkeypatch):
    """Files of the populations are open side by side while the tables are written, and only then."""
    from pyspark.sql import DataFrameWriter

    key, seen, write = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet

    def watched(self, *args, **named):
        seen.append(int(spark.conf.get(key)))
        return write(self, *args, **named)

    monkeypatch.setattr(DataFrameWriter, "parquet", watched)
    before = spark.conf.get(key)
    # More populations than files that may be open, so that some rows are sorted after all.
    rows = [state(f"T{i}", "LGS", basin=f"b{i % 40}", run=f"r{i % 3}") for i in range(400)]
    publish_passage(frames(spark, [], [], rows)[2].coalesce(1), root)
    assert min(seen) > 1 and spark.conf.get(key) == before
    got = read_published(spark, root).select("basin", "run", "tag_code").collect()
    assert sorted(map(tuple, got)) == sorted((r[0], r[1], r[3]) for r in rows)
