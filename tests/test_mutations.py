"""Each rule about old values and about several sources, broken on purpose: its query must differ from its SQL."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from checks.compare import duckdb_tables, spark_rows, sql_rows
from checks.queries import BATCH_QUERIES, FIRST_RELEASE_BATCH, QUERIES
from checks.sql_operators import statements
from tests.conftest import TESTDATA
from weirwalk import fixed_values as fv
from weirwalk.operators import joins, sets, state
from weirwalk.plans import batches, wide

SQL = statements(BATCH_QUERIES, FIRST_RELEASE_BATCH)


def forgetting(function, column):
    """The update on rows that have lost the column's old value."""

    def mutated(rows, *args, **more):
        lost = rows.withColumn(column, F.lit(None).cast(rows.schema[column].dataType))
        return function(lost, *args, **more)

    return mutated


def any_source_and_species(rows, tagging, age):
    if age is None:
        return rows
    return joins.semi_join(rows, tagging.filter(F.col("age") == age), ("tag_code",))


def earliest(parts, on=("tag_code", "species_group")):
    rows = parts[0].select(*on, "last_obs").unionByName(parts[1].select(*on, "last_obs"))
    return rows.groupBy(*on).agg(F.min("last_obs").alias("last_obs"))


def last_source_first():
    seen = [F.when(F.col(f"sees_{s}"), F.col(f"tagged_{s}")) for s in fv.SOURCES]
    return [
        F.coalesce(*reversed(seen[: i + 1])).alias(f"facts_{s}") for i, s in enumerate(fv.SOURCES)
    ]


def never_in_any_source(det, dam, skipped, by=joins.SOURCE_TAG):
    """As if a tag seen at the skipped checkpoint in one source were seen there in all."""
    seen = joins.detected_at(det, dam, by)
    return joins.anti_join(seen, joins.detected_at(det, skipped), ("tag_code", "species_group"))


def never_removed_in_any_source(det, dam, by=joins.SOURCE_TAG):
    gone = det.filter(joins.at_dam(dam) & joins.on_removal_antenna())
    return joins.anti_join(joins.detected_at(det, dam, by), gone, ("tag_code", "species_group"))


def code_without_old(rows, detected, removed, on):
    return STATE["at_dam_code"](rows.withColumn("at_dam", F.lit(None).cast("int")), detected, removed, on)


STATE = {name: getattr(state, name) for name in ("at_dam_code", "fill_null")}

MUTATIONS = {
    "flag lost: merge_detected": (state, "merge_flag", forgetting(state.merge_flag, "at_dam")),
    "flag lost: merge_removed": (state, "merge_flag", forgetting(state.merge_flag, "at_dam")),
    "flag lost: merge_below": (state, "merge_flag", forgetting(state.merge_flag, "below")),
    "date lost: merge_pass_date": (state, "merge_pass_date", forgetting(state.merge_pass_date, "pass_date")),
    "run lost: merge_release_facts": (state, "merge_release_facts", forgetting(state.merge_release_facts, "run_type")),
    "release lost: merge_release_facts": (state, "merge_release_facts", forgetting(state.merge_release_facts, "release_date")),
    "code lost: at_dam_code": (state, "at_dam_code", code_without_old),
    "overwritten: fill_null_species": (state, "fill_null", forgetting(state.fill_null, "spp")),
    "overwritten: fill_null_below": (state, "fill_null", forgetting(state.fill_null, "below")),
    "any source: release_age_semi_join": (joins, "of_age", any_source_and_species),
    "any source: age_yearling": (joins, "of_age", any_source_and_species),
    "any source: self_anti_never_at": (joins, "detected_at_never_at", never_in_any_source),
    "any source: detected_never_removed": (joins, "detected_never_removed", never_removed_in_any_source),
    "min for max: union_last_obs": (sets, "union_last_obs", earliest),
    "reversed: union_tagging": (sets, "fv", SimpleNamespace(SOURCES=fv.SOURCES[::-1])),
    "reversed: history_snake_ch1": (wide, "_facts", last_source_first),
    "reversed: c08_lmn_fill_release": (wide, "_facts", last_source_first),
    "unset forgotten: history_tributary_ch1": (batches, "UNSET", 0),
}


# Tags that are at two checkpoints in one source and at one of them in another are few.
RARE = ("self_anti_never_at", "detected_never_removed")


@pytest.mark.parametrize("mutation", MUTATIONS)
def test_a_broken_rule_shows(spark, small_dir, small_sql, monkeypatch, mutation):
    name = mutation.split(": ")[1]
    sf_dir = f"{TESTDATA}/sf0.01" if name in RARE else small_dir
    connection = duckdb_tables(sf_dir) if name in RARE else small_sql
    wanted = sql_rows(connection, SQL[name])[1]
    where, attribute, broken = MUTATIONS[mutation]
    monkeypatch.setattr(where, attribute, broken)
    assert spark_rows(QUERIES[name](spark, sf_dir)) != wanted
