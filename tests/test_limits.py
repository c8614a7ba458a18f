"""Configurations without limits, sources read one by one, and unknown values."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.rows import GOJ, LMJ, day, detection, frames, state, tagged
from weirwalk import fixed_values as fv
from weirwalk.fixed_values import Population
from weirwalk.operators.state import append_missing
from weirwalk.plans.populations import run_batches, select_populations

CH1 = select_populations("clearwater", "CH1")


def test_many_populations_seasons_and_ages(spark, monkeypatch):
    seasons = {f"day{i}": ((5, i), (5, i)) for i in range(1, 21)}
    monkeypatch.setattr(fv, "SEASONS", {**fv.SEASONS, **seasons})
    populations = tuple(
        Population("b", f"r{i}", "Chinook", "CHK", f"day{i % 20 + 1}", f"age{i % 20}")
        for i in range(120)
    )
    detections = [detection(f"T{i}", GOJ, day(5, i % 20 + 1)) for i in range(120)]
    tags = [tagged(f"T{i}", age=f"age{i % 20}" if i % 3 else "other") for i in range(120)]
    states = [state(f"T{i}", "LGR", below=1, basin="b", run=f"r{i}") for i in range(120)]
    inputs = frames(spark, detections, tags, states)
    got = run_batches(*inputs, populations, dams=("LGS",), batches=("C01",)).collect()
    narrow = run_batches(*inputs, populations[7:8], dams=("LGS",), batches=("C01",)).collect()
    assert {r["tag_code"] for r in narrow} <= {r["tag_code"] for r in got}
    assert all(r["run"] == "r" + r["tag_code"][1:] for r in got)


def test_a_population_reads_only_its_release_sources(spark):
    rows = [detection(f"T_{s}", LMJ, day(5, 2), source=s) for s in fv.RELEASE_SOURCES]
    inputs = frames(spark, rows, [tagged(f"T_{s}", source=s, group="CHK") for s in fv.RELEASE_SOURCES], [])
    for sources in ((fv.LGR_RELEASE,), fv.RELEASE_SOURCES[1:], fv.RELEASE_SOURCES):
        one = Population("snake", "CH1", "Chinook", "CHK", "spring", None, sources)
        tags = {r["tag_code"] for r in run_batches(*inputs, (one,)).collect()}
        assert tags <= {f"T_{s}" for s in sources}


@pytest.mark.parametrize("source", ["Main", None])
def test_unknown_source_fails(spark, source):
    inputs = frames(spark, [detection("T1", GOJ, day(5, 1), source=source)], [], [])
    everything = select_populations("snake", "CH1")
    with pytest.raises(PySparkException, match="unknown source"):
        run_batches(*inputs, everything).collect()


@pytest.mark.parametrize("dam", ["LGX", None])
def test_unknown_checkpoint_fails(spark, dam):
    inputs = frames(spark, [detection("T1", GOJ, day(5, 1))], [], [state("T1", dam)])
    with pytest.raises(PySparkException, match="unknown checkpoint"):
        run_batches(*inputs, CH1).collect()


def test_appended_rows_keep_their_checkpoint(spark):
    detections, tagging, passage = frames(
        spark,
        [detection("T1", GOJ, day(5, 1)), detection("T2", GOJ, day(5, 2))],
        [],
        [state("T1", "LGS"), state("T2", "LMN"), state("T2", "LGR", at_dam=0, below=1)],
    )
    grown = append_missing(passage, passage.filter("dam = 'LGR'"), "LGS")
    assert {(r["dam"], r["tag_code"]) for r in grown.filter("dam = 'LGS'").collect()} == {
        ("LGS", "T1"),
        ("LGS", "T2"),
    }
    after = run_batches(detections, tagging, grown, CH1, batches=("C02",), dams=("LGS",))
    assert {r["tag_code"] for r in after.collect()} == {"T1", "T2"}
    assert after.filter(F.col("upstream") == 1).count() == 2
