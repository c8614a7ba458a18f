"""Borders and conflicts that the driver tables do not show."""

from datetime import datetime

import pytest

from tests.rows import GOJ, ICH, JDJ, LMJ, MCJ, day, detection, frames, state, tagged
from weirwalk.plans.populations import run_batches, select_populations

CH1 = select_populations("clearwater", "CH1")
CH0 = select_populations("clearwater", "CH0")
SNAKE = select_populations("snake", "CH1")


def run(spark, detections, passage, tagging=(), populations=CH1, **more):
    inputs = frames(spark, detections, list(tagging), passage)
    rows = run_batches(*inputs, populations, added=True, **more).collect()
    return {(r["dam"], r["tag_code"]): r for r in rows}


def flags(row):
    return row["upstream"], row["at_dam"], row["below"]


@pytest.mark.parametrize(
    ("populations", "run_name", "dates"),
    [
        (CH1, "CH1", {(4, 23): 0, (4, 24): 1, (4, 30): 1, (5, 1): 1, (5, 25): 1, (5, 26): 0}),
        (CH0, "CH0", {(6, 2): 0, (6, 3): 1, (6, 30): 1, (7, 1): 1, (7, 8): 1, (7, 9): 0}),
    ],
)
def test_season_borders(spark, populations, run_name, dates):
    seen = [detection(f"T{m}-{d}", GOJ, day(m, d)) for m, d in dates]
    lgr = [state(f"T{m}-{d}", "LGR", at_dam=0, below=1, run=run_name) for m, d in dates]
    rows = run(spark, seen, lgr, populations=populations)
    assert {key[1] for key in rows} == {f"T{m}-{d}" for (m, d), inside in dates.items() if inside}


def test_last_detection_decides(spark):
    seen = [detection("T1", GOJ, day(5, 1)), detection("T1", GOJ, day(6, 1))]
    assert run(spark, seen, [state("T1", "LGR", at_dam=0, below=1)]) == {}


@pytest.mark.parametrize("antenna", ["sample", "Raceway 2", "THE SAMPLE ROOM"])
def test_removed_is_not_below(spark, antenna):
    seen = [detection("T1", GOJ, day(5, 1), antenna), detection("T1", JDJ, day(5, 9))]
    row = run(spark, seen, [state("T1", "LGR", at_dam=0, below=1)])["LGS", "T1"]
    assert flags(row) == (1, 2, 0)


def test_adult_return_needs_a_later_year(spark):
    years = {"SAME": (2014, 2014), "LATER": (2016, 2014), "UNKNOWN": (2016, None)}
    seen, passage = [], []
    for tag, (seen_in, migrated) in years.items():
        for site in ("AFF - Upper ADULT Fishway", "east Ladder"):
            seen.append(detection(tag + site[:3], site, day(8, 1, seen_in), year=migrated))
            passage.append(state(tag + site[:3], "LGS"))
    rows = run(spark, seen, passage, batches=("C02",))
    below = {tag for (_, tag), row in rows.items() if row["below"] == 1}
    assert below == {"LATERAFF", "LATEReas"}


def test_ice_harbor_counts_below_lmn_but_not_for_101(spark):
    seen = [detection("T1", ICH, day(5, 1)), detection("T2", ICH, day(5, 1))]
    rows = run(spark, seen, [state("T1", "LMN"), state("T2", "LGR", at_dam=1, below=1)])
    assert rows["LMN", "T1"]["below"] == 1
    assert ("LMN", "T2") not in rows
    assert flags(rows["LGS", "T2"]) == (1, 0, 1)


def test_conflicting_sources(spark):
    """Both sources date the row: the later date wins, and the main source's facts."""
    seen = [
        detection("T1", LMJ, day(5, 1)),
        detection("T1", LMJ, day(5, 5), source="lgr_release"),
    ]
    facts = [
        tagged("T1", "main run"),
        tagged("T1", "release run", age="Yearling+", source="lgr_release", group="CHK"),
    ]
    lgr = [state("T1", "LGR", at_dam=1, below=1, basin="snake")]
    row = run(spark, seen, lgr, facts, SNAKE)["LMN", "T1"]
    assert (row["pass_date"], row["run_type"]) == (day(5, 5), "main run")


def test_tag_listed_twice_takes_the_lowest_facts(spark):
    facts = [tagged("T1", "b", datetime(2014, 3, 2)), tagged("T1", "c"), tagged("T1", "a", None)]
    row = run(spark, [], [state("T1", "LGS")], facts)["LGS", "T1"]
    assert (row["run_type"], row["release_date"]) == ("a", None)


def test_null_facts_overwrite(spark):
    passage = [("clearwater", "CH1", "LGS", "T1", None, "old", day(1, 1), None, None, None, None)]
    row = run(spark, [], passage, [tagged("T1", None, None)])["LGS", "T1"]
    assert (row["run_type"], row["release_date"]) == (None, None)
    untouched = run(spark, [], passage)["LGS", "T1"]
    assert (untouched["run_type"], untouched["release_date"]) == ("old", day(1, 1))


def test_undated_match_clears_the_pass_date(spark):
    passage = [
        ("clearwater", "CH1", "LGS", "T1", None, None, None, day(1, 1), None, None, None),
        state("T1", "LGR", at_dam=0, below=1),
    ]
    assert run(spark, [detection("T1", GOJ, None)], passage)["LGS", "T1"]["pass_date"] is None
    assert run(spark, [], passage)["LGS", "T1"]["pass_date"] == day(1, 1)


def test_fill_of_a_seeded_row_without_detections(spark):
    row = run(spark, [], [state("T1", "LGS", spp="Coho")])["LGS", "T1"]
    assert row["spp"] == "Coho" and row["added"] is None
    assert flags(row) == (1, None, 0)


def test_release_tag_enters_without_any_table(spark):
    seen = [detection("T1", LMJ, day(5, 1), source="lgr_release")]
    old = tagged("T1", age="Yearling+", source="lgr_release", group="CHK")
    young = tagged("T1", age="Subyearling", source="lgr_release", group="CHK")
    assert run(spark, seen, [], [old], SNAKE)["LMN", "T1"]["added"] == "C07"
    assert run(spark, seen, [], [young], SNAKE) == {}
    assert run(spark, seen, [], [old], CH1) == {}


def test_release_tag_of_any_age_for_steelhead(spark):
    seen = [detection("T1", LMJ, day(5, 1), source="lgr_release", group="STH")]
    rows = run(spark, seen, [], populations=select_populations("snake", "STH"))
    assert rows["LMN", "T1"]["added"] == "C07"


def test_rows_appended_after_the_last_fill_stay_bare(spark):
    seen = [detection("T1", LMJ, day(5, 1))]
    passage = [state("T1", "LGR", at_dam=1, below=1), state("T0", "LMN")]
    facts = [tagged("T0"), tagged("T1")]
    rows = run(spark, seen, passage, facts, batches=("C04", "C07"))
    assert (rows["LMN", "T0"]["spp"], rows["LMN", "T0"]["run_type"]) == ("Chinook", "Spring")
    assert (rows["LMN", "T1"]["spp"], rows["LMN", "T1"]["run_type"]) == (None, None)
    rows = run(spark, seen, passage, facts, batches=("C04", "C07", "C08"))
    assert (rows["LMN", "T1"]["spp"], rows["LMN", "T1"]["run_type"]) == ("Chinook", "Spring")


def test_release_mcn_dam_parameter(spark):
    seen = [detection("T1", MCJ, day(5, 1), source="lgs_release")]
    age = [tagged("T1", age="Yearling+", source="lgs_release", group="CHK")]
    names = ("C09",)
    assert run(spark, seen, [], age, SNAKE, batches=names) == {}
    rows = run(spark, seen, [], age, SNAKE, batches=names, release_mcn_dam="MCN")
    assert rows["MCN", "T1"]["added"] == "C09"


def test_tag_in_two_populations_is_filled_in_both(spark):
    passage = [state("T1", "LGS", run="CH0"), state("T1", "LGS", run="CH1")]
    inputs = frames(spark, [detection("T1", JDJ, day(5, 1))], [], passage)
    rows = run_batches(*inputs, CH0 + CH1, dams=("LGS",)).collect()
    assert {(r["run"], r["below"]) for r in rows} == {("CH0", 1), ("CH1", 1)}


def test_unknown_names_are_refused(spark):
    with pytest.raises(ValueError):
        run(spark, [], [], batches=("C99",))
    with pytest.raises(ValueError):
        run(spark, [], [], dams=("LGR",))
