"""Shape of the physical plan, and stepwise runs against the single plan."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checks.queries import QUERIES
from tests.rows import LMJ, day, detection, frames, state, tagged
from weirwalk import fixed_values as fv
from weirwalk.plans.batches import BATCH_NAMES, needs
from weirwalk.plans.populations import run_batches, select_populations
from weirwalk.sources import driver_tables, tables


@pytest.fixture(scope="module")
def stored(spark, small_dir, tmp_path_factory):
    """The logical tables as files, read back as a job would read them."""
    root = tmp_path_factory.mktemp("logical")
    made = driver_tables.tables(spark, small_dir)
    made.detections.write.parquet(f"{root}/detections")
    made.tagging.write.parquet(f"{root}/tagging")
    tables.write_passage(made.passage, f"{root}/passage")
    return (
        tables.read_detections(spark, f"{root}/detections"),
        tables.read_tagging(spark, f"{root}/tagging"),
        tables.read_passage(spark, f"{root}/passage"),
    )


@pytest.fixture()
def whole_names(spark):
    """Plans print their filters in full."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.fixture()
def no_broadcast(spark, whole_names):
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
    }
    for key, value in keys.items():
        spark.conf.set(key, value)
    yield
    for key in keys:
        spark.conf.unset(key)


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_each_input_is_shuffled_once(stored, no_broadcast):
    plan = _plan(run_batches(*stored))
    assert len(re.findall(r"Exchange hashpartitioning\(tag_code#\d+, species_group#\d+", plan)) == 3
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 3
    assert "SinglePartition" not in plan and "RoundRobin" not in plan
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan


def test_a_run_reads_only_its_species_group_and_sources(spark, stored, tmp_path, whole_names):
    detections, tagging, passage = stored
    path = str(tmp_path / "partitioned")
    detections.write.partitionBy("species_group", "source").parquet(path)
    partitioned = tables.read_detections(spark, path)
    populations = select_populations("salmon", "STH")
    plan = _plan(run_batches(partitioned, tagging, passage, populations))
    filters = "".join(re.findall(r"PartitionFilters: \[[^\]]*\]", plan))
    assert re.search(r"species_group#\d+ = STH", filters) and re.search(r"source#\d+ = ", filters)
    same = run_batches(partitioned, tagging, passage, populations)
    assert same.exceptAll(run_batches(*stored, populations)).isEmpty()


def test_anti_join_is_not_broadcast_by_force(spark, small_dir, no_broadcast):
    from checks.queries import QUERIES

    assert "BroadcastHashJoin [tag_code" not in _plan(QUERIES["membership_precedence"](spark, small_dir))


def test_unused_columns_are_not_read(stored):
    everything = _plan(run_batches(*stored))
    assert "run_name" in everything and "release_date" in everything
    plan = _plan(run_batches(*stored).select("tag_code", "below"))
    assert "run_name" not in plan and "migration_year" in plan


def test_generated_methods_stay_compilable(spark, stored, no_broadcast):
    """Methods above 8000 bytes of bytecode are interpreted by the JVM."""
    result = run_batches(*stored)._jdf.queryExecution().executedPlan()
    debug = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$")
    code = getattr(debug, "MODULE$").codegenString(result)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8000


@pytest.mark.parametrize(
    ("condition", "columns"),
    [
        ("dam = 'LGS'", ["basin", "tag_code"]),
        ("at_dam = 2", ["run"]),
        ("added = 'C11'", ["basin", "run", "tag_code"]),
        ("spp IS NULL", ["dam"]),
    ],
)
def test_results_can_be_filtered_and_pruned(stored, condition, columns):
    result = run_batches(*stored, added=True)
    every = [r for r in result.filter(condition).collect()]
    assert len(result.filter(condition).select(*columns).collect()) == len(every)


def test_one_batch_at_a_time_gives_the_same_tables(spark, stored, tmp_path):
    """The state written between batches equals the state carried in the wide row."""
    detections, tagging, passage = stored
    lgr = passage.filter(F.col("dam") == "LGR")
    for name in BATCH_NAMES:
        after = run_batches(detections, tagging, passage, batches=(name,))
        path = str(tmp_path / name)
        tables.write_passage(lgr.unionByName(after), path)
        passage = tables.read_passage(spark, path)
    columns = ["basin", "run", "dam", "tag_code"]
    columns += [c for c in passage.columns if c not in columns]
    stepwise = passage.filter(F.col("dam") != "LGR").select(*columns)
    at_once = run_batches(*stored).select(*columns)
    assert stepwise.exceptAll(at_once).isEmpty() and at_once.exceptAll(stepwise).isEmpty()


def test_invariants(stored):
    passage = stored[2].select("basin", "run", "dam", "tag_code")
    result = run_batches(*stored, added=True).cache()
    filled = result.filter(F.col("upstream") != 1)
    removed = result.filter((F.col("at_dam") == 2) & (F.col("below") != 0))
    late = result.filter(F.col("added").isin("C11", "C14", "C15"))
    late = late.filter((F.col("at_dam") != 0) | (F.col("below") != 1))
    keys = ["basin", "run", "dam", "tag_code"]
    twice = result.groupBy(*keys).count().filter("count > 1")
    old = result.filter(F.col("added").isNotNull()).join(passage, keys, "left_semi")
    assert all(bad.isEmpty() for bad in (filled, removed, late, twice, old))
    assert {r["run"] for r in result.select("run").distinct().collect()} == {
        p.run for p in fv.POPULATIONS
    }


def test_a_tag_with_most_detections_leaves_each_task_as_one_row(spark, stored):
    """Copies of one tag's detections change nothing but the input size."""
    detections, tagging, passage = stored
    tag = detections.filter(F.col("source") == "main").first()["tag_code"]
    hot = detections.filter(F.col("tag_code") == tag).crossJoin(spark.range(5000)).drop("id")
    same = run_batches(detections.unionByName(hot), tagging, passage)
    assert same.exceptAll(run_batches(*stored)).isEmpty()


def _scans(plan, name):
    return len(re.findall(rf"FileScan parquet [^\n]*/{name}[\],]", plan))


def test_each_input_is_scanned_once(stored, no_broadcast):
    plan = _plan(run_batches(*stored))
    assert [_scans(plan, n) for n in ("detections", "tagging", "passage")] == [1, 1, 1]
    assert len(re.findall("FullOuter", plan)) == 1


@pytest.mark.parametrize("last", ["C01", "C03", "C05"])
def test_appends_of_the_main_source_read_no_tagging(stored, no_broadcast, last):
    names, dam = BATCH_NAMES[: BATCH_NAMES.index(last) + 1], {"C01": "LGS", "C03": "LMN", "C05": "MCN"}[last]
    plan = _plan(run_batches(*stored, batches=names, dams=(dam,), added=True))
    assert [_scans(plan, n) for n in ("detections", "tagging", "passage")] == [1, 0, 1]
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2
    assert re.search(r"PushedFilters: [^\n]*EqualTo\(source,main\)", plan)


def test_what_a_table_depends_on():
    assert needs(dams=("LGS",)).batches == ("C01", "C02", "C11")
    assert needs(dams=("LMN",)).batches == ("C01", "C02", "C03", "C04", "C07", "C08", "C11", "C14")
    assert needs().batches == BATCH_NAMES and needs().sources == fv.SOURCES
    early = needs(BATCH_NAMES[:6])
    assert (early.sources, early.ages, early.facts) == ((fv.MAIN,), False, True)
    append = needs(("C07",), ("LMN",))
    assert (append.sources, append.ages, append.facts) == ((fv.MAIN, fv.LGR_RELEASE), True, False)


def test_fewer_tables_are_a_part_of_all(stored):
    for dam in fv.FILLED_DAMS:
        alone = run_batches(*stored, dams=(dam,))
        within = run_batches(*stored).filter(F.col("dam") == dam)
        assert alone.exceptAll(within).isEmpty() and within.exceptAll(alone).isEmpty()


def test_a_task_holds_one_sort_of_its_rows(spark, stored, no_broadcast):
    """Rows that are grouped by hash and sorted again, or merged by their compressed size, fill a task's memory."""
    result = run_batches(*stored)
    plan = _plan(result)
    assert "collect_list" not in plan and "REPARTITION_BY_NUM" in plan
    assert len(re.findall(r"[+:]- (?:\*\(\d+\) )?Sort \[tag_code#\d+ ASC NULLS FIRST, species_group#\d+ ASC NULLS FIRST", plan)) == 2


def _dealt_into(frame, key):
    """The partitions that the shuffles by the key deal into."""
    return sorted(int(n) for n in re.findall(rf"Exchange hashpartitioning\({key}#\d+L?,(?: species_group#\d+,)? (\d+)\)", _plan(frame)))


def test_partitions_of_the_driver_tables_follow_their_rows(spark, tmp_path, no_broadcast, monkeypatch):
    """The configured number stays as it is; a task must not be dealt more rows as the tables grow."""
    n, at = 40, datetime(1995, 5, 5)
    orders = [(k, k, "F", at, "1-URGENT") for k in range(n)]
    lines = [(k, k + i, i + 1, "R", "F", at) for k in range(n) for i in range(4)]
    spark.createDataFrame(orders, driver_tables.ORDERS).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, driver_tables.LINEITEM).write.parquet(f"{tmp_path}/lineitem.parquet")
    small = driver_tables.tables(spark, str(tmp_path))
    assert small.partitions == 1
    monkeypatch.setattr(driver_tables, "ROWS_A_TASK", 4)
    large = driver_tables.tables(spark, str(tmp_path))
    assert large.partitions == 50 > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert _dealt_into(large.detections, "key") == [50, 50]
    assert _dealt_into(large.passage, "key") == [50, 50]
    for name in ("detections", "tagging", "passage"):
        few, many = getattr(small, name), getattr(large, name)
        assert few.count() and few.exceptAll(many).isEmpty() and many.exceptAll(few).isEmpty()
    run = QUERIES["history_all_populations"](spark, str(tmp_path))
    assert _dealt_into(run, "tag_code").count(50) == 3


@pytest.mark.parametrize(
    "name",
    (
        "c04_lmn_fill",
        "c06_mcn_fill",
        "c08_lmn_fill",
        "history_all_populations",
        "c12_mcn_addin_release",
        "c10_mcn_fill_release",
        "c13_mcn_fill_release",
        "c15_mcn_101_release",
        "c08_lmn_fill_release",
    ),
)
def test_a_batch_query_deals_its_rows_by_the_size_of_its_tables(spark, tmp_path, no_broadcast, monkeypatch, name):
    n, at = 40, datetime(1995, 5, 5)
    orders = [(k, k, "F", at, "1-URGENT") for k in range(n)]
    lines = [(k, k + i, i + 1, "R", "F", at) for k in range(n) for i in range(4)]
    spark.createDataFrame(orders, driver_tables.ORDERS).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, driver_tables.LINEITEM).write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(driver_tables, "ROWS_A_TASK", 4, raising=False)
    run = QUERIES[name](spark, str(tmp_path))
    assert _dealt_into(run, "key") == [50] * 4
    # Passage and tagging rows, and the marks behind their sum.
    assert _dealt_into(run, "tag_code")[1:] == [50] * 3


def test_rows_by_tag_lie_in_the_partitions_asked_for(spark, stored, no_broadcast):
    few, many = run_batches(*stored), run_batches(*stored, partitions=50)
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert _dealt_into(few, "tag_code") == [configured] * 3
    # One more than before: detections are combined on the map side and summed in the configured number first.
    assert _dealt_into(many, "tag_code") == [configured, 50, 50, 50]
    assert _dealt_into(run_batches(*stored, partitions=1), "tag_code") == [configured] * 3
    assert few.exceptAll(many).isEmpty() and many.exceptAll(few).isEmpty()


def test_no_task_groups_the_tagging_rows_that_it_scans(stored, no_broadcast):
    """They are dealt as they are and grouped in sorted order: a grouping of objects sorts, and holds, all that a task scans."""
    lines = _plan(run_batches(*stored)).splitlines()
    scan = next(i for i, line in enumerate(lines) if re.search(r"FileScan parquet .*/tagging[\],]", line))
    dealt = max(i for i in range(scan) if "Exchange hashpartitioning" in lines[i])
    assert not any("Aggregate" in line for line in lines[dealt:scan])
    assert not any("ObjectHashAggregate" in line for line in lines)


def test_ages_and_facts_of_a_tag_that_is_listed_twice(spark):
    """Any of a source's rows may have the population's age, whatever the number of ages; the lowest facts count."""
    ages = [f"age {i:03}" for i in range(130)]
    found = [detection(f"T{i}", LMJ, day(5, 2), source=fv.LGR_RELEASE) for i in range(130)]
    release = {"source": fv.LGR_RELEASE, "group": "CHK"}
    tags = [tagged(f"T{i}", run="late", age=ages[i], release=day(4, 2), **release) for i in range(130)]
    tags += [tagged(f"T{i}", run="soon", age=None if i % 2 else "it's other", release=day(4, 1), **release) for i in range(130)]
    inputs = frames(spark, found, tags, [])
    populations = tuple(
        fv.Population("snake", f"R{i}", "Chinook", "CHK", "spring", age, fv.RELEASE_SOURCES)
        for i, age in enumerate(ages)
    )
    rows = run_batches(*inputs, populations, batches=("C07", "C08"), dams=("LMN",))
    got = rows.select("run", "tag_code", "run_type").collect()
    assert sorted(map(tuple, got)) == sorted((f"R{i}", f"T{i}", "soon") for i in range(130))


def test_rows_with_facts_enter_beside_tables(spark):
    """A tag in one release population's table and seen at releases enters the others with the same facts."""
    both = tuple(
        fv.Population("snake", run, "Chinook", "CHK", "spring", None, fv.RELEASE_SOURCES)
        for run in ("CH0", "CH1")
    )
    found = [detection(t, LMJ, day(5, 2), source=fv.LGR_RELEASE) for t in ("T1", "T2", "T3")]
    tags = [tagged(t, run=f"of {t}", source=fv.LGR_RELEASE, group="CHK") for t in ("T1", "T2")]
    states = [state("T1", "LMN", basin="snake", run="CH1")]
    inputs = frames(spark, found, tags, states)
    rows = run_batches(*inputs, both, dams=("LMN",)).select("run", "tag_code", "run_type").collect()
    assert sorted(map(tuple, rows), key=str) == sorted(
        [(p.run, t, f"of {t}" if t != "T3" else None) for p in both for t in ("T1", "T2", "T3")], key=str
    )
