"""Exported tables: names, dates, spellings, and what could not be read."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.rows import GOJ, day, frames
from weirwalk import schema
from weirwalk.sources.exports import (
    PassageTable,
    from_export,
    ingest_export,
    passage_from_export,
    passage_from_exports,
    passage_to_export,
)

LGS = PassageTable("snake", "CH1", "LGS")


def test_exported_names(spark):
    rows = spark.createDataFrame(
        [("T1", GOJ, "RIVER EXIT", day(5, 1), 2014)],
        "`Tag Code` string, `Site Name` string, `Antenna Group Name` string, "
        "`Obs Time Value` timestamp_ntz, `Migration Year YYYY` int",
    )
    named = from_export(rows, schema.DETECTIONS, "lgr_release", "CHK")
    assert named.columns == schema.DETECTIONS.fieldNames()
    assert (named.first()["source"], named.first()["tag_code"]) == ("lgr_release", "T1")


def test_export_dates_tags_and_sites(spark):
    rows = [("T1", "04/24/2014"), ("T2", " 04242014"), ("T3", "2014-04-24"), ("T4", "soon"), ("T5", None)]
    export = spark.createDataFrame(rows, "`Tag Code` string, `Release Date MMDDYYYY` string")
    got = from_export(export, schema.TAGGING, "main", None).orderBy("tag_code").collect()
    assert [r["release_date"] and r["release_date"].date().isoformat() for r in got] == ["2014-04-24"] * 3 + [None] * 2
    seen = spark.createDataFrame([("T1", f" {GOJ} "), (None, GOJ)], "`Tag Code` string, `Site Name` string")
    detections = from_export(seen, schema.DETECTIONS, "main", "CHK")
    assert detections.first()["site_name"] == GOJ
    with pytest.raises(PySparkException, match="must not be NULL"):
        detections.collect()


def test_unread_dates_stay_as_text_and_are_counted(spark, tmp_path):
    rows = [("T1", "04/24/2014"), ("T2", "soon"), (None, "later"), ("T3", None), (" ", "04/24/2014"), ("T4 ", " 13/45/2014 ")]
    export = spark.createDataFrame(rows, "`Tag Code` string, `Release Date MMDDYYYY` string")
    read, counts = ingest_export(export, schema.TAGGING, "main", None)
    read.write.parquet(str(tmp_path / "tagging"))
    assert counts.get == {"n_rows": 6, "n_rejected": 2, "n_unread_release_date": 2}
    got = spark.read.parquet(str(tmp_path / "tagging"))
    assert got.columns == [*schema.TAGGING.fieldNames(), "release_date_raw"]
    raw = {r["tag_code"]: r["release_date_raw"] for r in got.collect()}
    assert raw == {"T1": None, "T2": "soon", "T3": None, "T4": "13/45/2014"}


def test_counts_of_an_empty_export_and_unknown_sites(spark):
    names = "`Tag Code` string, `Site Name` string, `Obs Time Value` string"
    read, counts = ingest_export(spark.createDataFrame([], names), schema.DETECTIONS, "main", "CHK")
    assert read.collect() == [] and counts.get["n_rows"] == 0
    sites = [("T1", GOJ), ("T1", " east LADDER"), ("T1", "XYZ"), ("T1", None), (None, "XYZ")]
    rows = spark.createDataFrame([(*s, "2014-05-01 10:00:00") for s in sites], names)
    read, counts = ingest_export(rows, schema.DETECTIONS, "main", "CHK")
    assert len(read.collect()) == 4 and counts.get["n_unknown_site"] == 2


@pytest.mark.parametrize("name", ["Lower_Snake_CH1_LGS", "lower_snake_ch1_lgs", " Lower_Snake_CH1_LGS "])
def test_table_names(name):
    assert PassageTable.named(name) == LGS and LGS.name == "Lower_Snake_CH1_LGS"


@pytest.mark.parametrize("name", ["Lower_Snake_CH1", "Upper_Snake_CH1_LGS", "Lower_Snake_CH1_LGX", ""])
def test_other_names_are_refused(name):
    with pytest.raises(ValueError, match="not the name"):
        PassageTable.named(name)


def test_column_sets_of_the_four_checkpoints():
    found = {dam: PassageTable("salmon", "STH", dam).columns for dam in ("LGR", "LGS", "LMN", "MCN")}
    assert found["LGR"] == {"tag_code": "Tag Code", "at_dam": "LGR", "below": "Below_LGR"}
    assert [found[d]["upstream"] for d in ("LGS", "LMN", "MCN")] == ["LGR", "LGS", "LMN"]
    assert found["MCN"]["pass_date"] == "MCN_Pass_Date" and found["LMN"]["below"] == "Below_LMN"


def test_all_tables_of_a_population_and_back(spark):
    passage = frames(
        spark,
        [],
        [],
        [
            ("snake", "CH1", dam, f"T{i}", *(("Chinook", "Spring", day(3, 1), day(5, i + 1), i % 2) if dam != "LGR" else [None] * 5), i, 1 - i % 2)
            for dam in ("LGR", "LGS", "LMN", "MCN")
            for i in range(3)
        ],
    )[2]
    tables = [PassageTable("snake", "CH1", dam) for dam in ("LGR", "LGS", "LMN", "MCN")]
    stored = {t.name: passage_to_export(passage, t) for t in tables}
    assert stored["Lower_Snake_CH1_LMN"].columns[4:] == ["LMN_Pass_Date", "LGS", "LMN", "Below_LMN"]
    back = passage_from_exports(stored)
    assert back.columns == passage.columns and sorted(back.collect(), key=str) == sorted(passage.collect(), key=str)


def test_spellings_blanks_and_missing_columns(spark):
    rows = [(" T1 ", "chinook ", "1", " "), ("T2", "STH", " 2", "0"), ("T3", "Coho", None, "1"), ("T4", "", "", None), ("T5", None, "0", "1")]
    export = spark.createDataFrame(rows, "`TAG CODE` string, spp string, LGS string, below_lgs string").withColumn("x", F.lit(1))
    got = {r["tag_code"]: r for r in passage_from_export(export, LGS).collect()}
    assert {t: r["spp"] for t, r in got.items()} == {"T1": "Chinook", "T2": "Steelhead", "T3": "Coho", "T4": None, "T5": None}
    assert [(got[f"T{i}"]["at_dam"], got[f"T{i}"]["below"]) for i in range(1, 6)] == [(1, None), (2, 0), (None, 1), (None, None), (0, 1)]
    assert got["T1"]["pass_date"] is None and (got["T1"]["basin"], got["T1"]["dam"]) == ("snake", "LGS")


@pytest.mark.parametrize("flag", ["3", "yes", "-1"])
def test_other_flags_fail(spark, flag):
    export = spark.createDataFrame([("T1", flag, "1")], "`Tag Code` string, LGS string, Below_LGS string")
    with pytest.raises(PySparkException, match="no flag in LGS"):
        passage_from_export(export, LGS).collect()


@pytest.mark.parametrize("tag", [None, "", " "])
def test_missing_tags_fail(spark, tag):
    export = spark.createDataFrame([(tag, 1, 1)], "`Tag Code` string, LGS int, Below_LGS int")
    with pytest.raises(PySparkException, match="must not be NULL"):
        passage_from_export(export, LGS).collect()


def test_a_table_without_its_flags_is_refused(spark):
    with pytest.raises(ValueError, match="at_dam"):
        passage_from_export(spark.createDataFrame([("T1", 1)], "`Tag Code` string, Below_LGS int"), LGS)
