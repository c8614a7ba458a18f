"""Ingest checks and the passage sink."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.rows import GOJ, day, detection, frames, state, tagged
from weirwalk.plans.populations import run_batches, select_populations
from weirwalk.sources import tables

CH1 = select_populations("clearwater", "CH1")


def test_null_tag_is_rejected(spark):
    inputs = frames(
        spark, [detection(None, GOJ, day(5, 1))], [tagged(None)], [state(None, "LGR")]
    )
    checks = (tables.checked_detections, tables.checked_tagging, tables.checked_passage)
    for check, rows in zip(checks, inputs):
        with pytest.raises(PySparkException, match="must not be NULL"):
            check(rows).collect()


@pytest.mark.parametrize("adaptive", ["true", "false"])
@pytest.mark.parametrize("place", [0, 1, 2])
def test_a_null_tag_fails_a_run_whatever_the_other_inputs_hold(spark, place, adaptive):
    """Also on tables that no reader has checked, and where all other inputs are empty."""
    rows = [[detection(None, GOJ, day(5, 1))], [tagged(None)], [state(None, "LGR")]]
    good = [[detection("T1", GOJ, day(5, 1))], [tagged("T1")], [state("T1", "LGR", at_dam=0, below=1)]]
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        for others in ([[], [], []], good):
            given = [*others[:place], rows[place], *others[place + 1 :]]
            with pytest.raises(PySparkException, match="must not be NULL"):
                run_batches(*frames(spark, *given), CH1).collect()
        assert run_batches(*frames(spark, *good), CH1).count() == 1
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_repeated_tag_is_rejected(spark):
    inputs = frames(spark, [], [], [state("T1", "LGS"), state("T1", "LGS")])
    with pytest.raises(PySparkException, match="repeats"):
        run_batches(*inputs, CH1).collect()


def test_site_names_are_trimmed(spark):
    rows = frames(spark, [detection("T1", f" {GOJ} ", day(5, 1))], [], [])[0]
    assert tables.checked_detections(rows).first()["site_name"] == GOJ


def test_write_is_read_back_and_never_replaces(spark, tmp_path):
    passage = frames(spark, [], [], [state("T1", "LGS"), state("T2", "LGR", at_dam=1, below=0)])[2]
    path = str(tmp_path / "passage")
    tables.write_passage(passage, path)
    back = tables.read_passage(spark, path).select(*passage.columns)
    assert sorted(back.collect()) == sorted(passage.collect())
    assert back.filter(F.col("run") == "CH1").count() == 2
    with pytest.raises(PySparkException):
        tables.write_passage(passage, path)
