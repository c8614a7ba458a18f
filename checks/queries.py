"""One query per operator, over the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirwalk import fixed_values as fv
from weirwalk import schema
from weirwalk.functions import predicates as p
from weirwalk.operators import aggregates, joins, sets, state
from weirwalk.operators.aggregates import SOURCE_TAG, TAG
from weirwalk.plans.batches import APPENDS, BATCH_NAMES
from weirwalk.plans.populations import run_batches, select_populations
from weirwalk.plans.wide import population_table
from weirwalk.sources import detection_store, exports, publish
from weirwalk.sources import driver_tables as source
from weirwalk.sources import tables as logical
from weirwalk.sources.driver_tables import Tables, tables
from weirwalk.sources.folders import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]

TRIBUTARIES = select_populations("clearwater") + select_populations("salmon")
SNAKE = select_populations("snake")
LMN_SITES, MCN_SITES = fv.dam_site_names("LMN"), fv.dam_site_names("MCN")
STATE_COLUMNS = ("basin", "run", "dam", "tag_code")

# Operator names used as query names, by batch.
BATCH_QUERIES = {
    "C01": "c01_lgs_addin",
    "C02": "c02_lgs_fill",
    "C03": "c03_lmn_addin",
    "C04": "c04_lmn_fill",
    "C05": "c05_mcn_addin",
    "C06": "c06_mcn_fill",
    "C07": "c07_lmn_addin",
    "C08": "c08_lmn_fill",
    "C09": "c09_mcn_addin",
    "C10": "c10_mcn_fill",
    "C11": "c11_lgs_101",
    "C12": "c12_mcn_addin",
    "C13": "c13_mcn_fill",
    "C14": "c14_lmn_101",
    "C15": "c15_mcn_101",
}
# The first batch that also looks at release sources.
FIRST_RELEASE_BATCH = "C07"
_BATCH_DAM = {name: query.split("_")[1].upper() for name, query in BATCH_QUERIES.items()}

QUERIES: dict[str, Query] = {}


def _on_detections(name: str) -> Callable:
    """Register a query of the detections."""

    def register(query: Callable[[DataFrame], DataFrame]) -> Callable:
        QUERIES[name] = lambda spark, sf_dir: query(source.detections(spark, sf_dir))
        return query

    return register


def _on_tables(name: str) -> Callable:
    """Register a query of all logical tables."""

    def register(query: Callable[[Tables], DataFrame]) -> Callable:
        QUERIES[name] = lambda spark, sf_dir: query(tables(spark, sf_dir))
        return query

    return register


def _states(t: Tables, *dams: str) -> DataFrame:
    """Start states of the checkpoints with species and species group of the population."""
    spark = t.passage.sparkSession
    known = population_table(spark, fv.POPULATIONS)
    known = F.broadcast(known.select("basin", "run", "species_group", "species"))
    return t.passage.filter(F.col("dam").isin(list(dams))).join(known, ["basin", "run"])


def _main(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("source") == fv.MAIN)


def _releases(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("source") != fv.MAIN)


# Sources


@_on_detections("scan_detections")
def scan_detections(det: DataFrame) -> DataFrame:
    return _main(det).drop("source")


@_on_detections("scan_release_detections")
def scan_release_detections(det: DataFrame) -> DataFrame:
    return _releases(det)


@_on_tables("scan_tagging")
def scan_tagging(t: Tables) -> DataFrame:
    return _main(t.tagging).select("tag_code", "run_name", "release_date")


@_on_tables("scan_release_tagging")
def scan_release_tagging(t: Tables) -> DataFrame:
    return _releases(t.tagging)


@_on_tables("scan_passage_state")
def scan_passage_state(t: Tables) -> DataFrame:
    rows = t.passage.filter((F.col("dam") == "LGR") & p.flags_are(at_dam=0, below=1))
    return rows.select("basin", "run", "tag_code")


@_on_tables("population_params")
def population_params(t: Tables) -> DataFrame:
    known = population_table(t.passage.sparkSession, fv.POPULATIONS)
    known = F.broadcast(known.withColumnRenamed("species", "spp"))
    columns = ("basin", "run", "spp", "species_group", "season", "age", "has_releases")
    tags = t.passage.filter(F.col("dam") == "LGR").groupBy("basin", "run")
    tags = tags.agg(F.count("*").alias("n_tags"))
    return tags.join(known, ["basin", "run"]).select(*columns, "n_tags")


# Stored detections, exported tables, published versions


def _on_store(name: str) -> Callable:
    """Register a query of the detections as the detection store gives them back."""

    def register(query: Callable[[DataFrame], DataFrame]) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            path = scratch_dir(spark)
            detection_store.write_detections(source.detections(spark, sf_dir), path)
            return query(detection_store.read_detections(spark, path))

        QUERIES[name] = run
        return query

    return register


@_on_store("store_round_trip")
def store_round_trip(det: DataFrame) -> DataFrame:
    return det


@_on_store("stored_site_set")
def stored_site_set(det: DataFrame) -> DataFrame:
    return filter_site_set(det)


@_on_store("stored_site_equal")
def stored_site_equal(det: DataFrame) -> DataFrame:
    return filter_site_equal(det)


@_on_store("stored_last_obs_mcn")
def stored_last_obs_mcn(det: DataFrame) -> DataFrame:
    return aggregates.last_obs(_main(det), MCN_SITES)


@_on_store("stored_last_obs_in_season")
def stored_last_obs_in_season(det: DataFrame) -> DataFrame:
    return last_obs_in_season(det)


@_on_store("stored_last_obs_by_source")
def stored_last_obs_by_source(det: DataFrame) -> DataFrame:
    return last_obs_by_source(det)


def _exported_passage(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The start state as 36 stored tables, with flags as text and species spelled in several ways."""
    path = scratch_dir(spark)
    logical.write_passage(source.passage(spark, sf_dir), path)
    passage = logical.read_passage(spark, path)
    odd = (F.substring("Tag Code", -2, 2).cast("int") % 4 == 1) & (F.col("Spp") != "Coho")
    spelled = F.when(odd, F.upper("Spp")).otherwise(F.concat(F.lit(" "), "Spp"))
    found = {}
    for population in fv.POPULATIONS:
        for dam in fv.DAMS:
            table = exports.PassageTable(population.basin, population.run, dam)
            rows = exports.passage_to_export(passage, table)
            rows = rows.withColumn(dam, F.concat(F.col(dam).cast("string"), F.lit(" ")))
            if dam != "LGR":
                day = F.date_format("Release_Date", exports.EXPORT_DATES[0])
                rows = rows.withColumns({"Spp": spelled, "Release_Date": day})
                rows = rows.withColumnRenamed("Tag Code", "tag code").withColumn("Remark", F.lit("by hand"))
            found[table.name] = rows
    return found


def ingest_passage_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exports.passage_from_exports(_exported_passage(spark, sf_dir))


QUERIES["ingest_passage_export"] = ingest_passage_export


def _tagging_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main tagging table as exported: dates in three formats, some in none, some tags missing."""
    number = F.substring("tag_code", 2, 20).cast("long")
    day = F.date_format("release_date", "MM/dd/yyyy")
    written = (
        F.when(number % 12 == 3, F.concat(F.lit("week "), (number % 53).cast("string")))
        .when(number % 4 == 1, F.date_format("release_date", "MMddyyyy"))
        .when(number % 4 == 2, F.date_format("release_date", "yyyy-MM-dd"))
        .otherwise(F.concat(F.lit(" "), day))
    )
    return _main(source.tagging(spark, sf_dir)).select(
        F.when(number % 97 != 5, F.col("tag_code")).alias("Tag Code"),
        F.col("run_name").alias("Run Name"),
        written.alias("Release Date MMDDYYYY"),
        F.col("age").alias("Age"),
    )


def ingest_tagging_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    export = _tagging_export(spark, sf_dir)
    rows, _ = exports.ingest_export(export, schema.TAGGING, fv.MAIN, None)
    return rows


def ingest_tagging_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was observed while the export was written as a logical table."""
    export = _tagging_export(spark, sf_dir)
    rows, counts = exports.ingest_export(export, schema.TAGGING, fv.MAIN, None)
    rows.write.parquet(scratch_dir(spark))
    return spark.createDataFrame([counts.get])


def ingest_detections_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of the main detections of one species group, on their way into the detection store."""
    spelled = {name: exported for exported, name in exports.EXPORT_COLUMNS.items()}
    det = _main(source.detections(spark, sf_dir)).filter(F.col("species_group") == "CHK")
    time = F.date_format("obs_time", "yyyy-MM-dd HH:mm:ss")
    number = F.substring("tag_code", 2, 20).cast("long")
    det = det.withColumn("obs_time", F.when(number % 50 != 7, time).otherwise("at dawn"))
    site = F.when(number % 30 == 1, "TWX - Estuary Towed Array").otherwise(F.col("site_name"))
    det = det.withColumn("site_name", site).drop("source", "species_group")
    rows, counts = exports.ingest_export(
        det.withColumnsRenamed(spelled), schema.DETECTIONS, fv.MAIN, "CHK"
    )
    rows.write.parquet(scratch_dir(spark))
    return spark.createDataFrame([counts.get])


QUERIES["ingest_tagging_export"] = ingest_tagging_export
QUERIES["ingest_tagging_counts"] = ingest_tagging_counts
QUERIES["ingest_detections_counts"] = ingest_detections_counts


def sink_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The start state published, a run from it published over it, and that read back."""
    t, root = tables(spark, sf_dir), scratch_dir(spark)
    first = publish.publish_passage(t.passage, root)
    start = publish.read_published(spark, root)
    filled = run_batches(t.detections, t.tagging, start, partitions=t.partitions)
    lgr = start.filter(F.col("dam") == "LGR")
    publish.publish_passage(lgr.unionByName(filled), root, based_on=first)
    return publish.read_published(spark, root)


QUERIES["sink_round_trip"] = sink_round_trip


# Predicates and projections


@_on_detections("filter_site_set")
def filter_site_set(det: DataFrame) -> DataFrame:
    return det.filter(p.at_sites(MCN_SITES)).select("tag_code", "site_name", "obs_time")


@_on_detections("filter_site_equal")
def filter_site_equal(det: DataFrame) -> DataFrame:
    return det.filter(p.at_sites(LMN_SITES)).select("tag_code", "site_name", "obs_time")


@_on_detections("filter_removed_antenna")
def filter_removed_antenna(det: DataFrame) -> DataFrame:
    return det.filter(p.on_removal_antenna()).select("tag_code", "antenna_group", "obs_time")


@_on_detections("filter_adult_return")
def filter_adult_return(det: DataFrame) -> DataFrame:
    columns = ("tag_code", "site_name", "obs_time", "migration_year")
    return det.filter(p.adult_return()).select(*columns)


def _detected_below(below: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        det = source.detections(spark, sf_dir)
        return aggregates.distinct_tags(det.filter(p.detected_below(below)), SOURCE_TAG)

    return query


for _below in fv.BELOW_ORD:
    QUERIES[f"detected_{_below}"] = _detected_below(_below)


def _season(season: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        det = _main(source.detections(spark, sf_dir))
        return aggregates.last_obs_in_season(det, LMN_SITES, season)

    return query


for _name in fv.SEASONS:
    QUERIES[f"season_{_name}"] = _season(_name)


def _age(age: str | None) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = tables(spark, sf_dir)
        tags = aggregates.distinct_tags(_releases(t.detections), SOURCE_TAG)
        return joins.of_age(tags, t.tagging, age)

    return query


QUERIES["age_yearling"] = _age("Yearling+")
QUERIES["age_subyearling"] = _age("Subyearling")
QUERIES["age_any"] = _age(None)


@_on_tables("fill_null_species")
def fill_null_species(t: Tables) -> DataFrame:
    rows = state.fill_null(_states(t, *fv.FILLED_DAMS), "spp", F.col("species"))
    return rows.select(*STATE_COLUMNS, "spp")


@_on_tables("fill_null_below")
def fill_null_below(t: Tables) -> DataFrame:
    rows = state.fill_null(_states(t, *fv.FILLED_DAMS), "below", F.lit(0))
    return rows.select(*STATE_COLUMNS, "below")


@_on_tables("new_row_detector")
def new_row_detector(t: Tables) -> DataFrame:
    return t.passage.filter(p.brand_new()).select(*STATE_COLUMNS)


@_on_tables("filter_state_flags")
def filter_state_flags(t: Tables) -> DataFrame:
    rows = t.passage.filter(p.flags_are(below=1))
    return rows.select(*STATE_COLUMNS, "at_dam", "below")


@_on_tables("project_release_facts")
def project_release_facts(t: Tables) -> DataFrame:
    # The species is that of the population whose table the row is for.
    rows = _states(t, "LGR").select("basin", "run", "tag_code", F.col("species").alias("spp"))
    return rows.join(_main(t.tagging), "tag_code").select(
        "basin", "run", "tag_code", F.col("run_name").alias("run_type"), "release_date", "spp"
    )


@_on_tables("membership_precedence")
def membership_precedence(t: Tables) -> DataFrame:
    below = sets.union_detected_below(t.detections, (fv.MAIN,), "below_lmn_101")
    members = [_states(t, "LGR"), _states(t, "LGS")]
    return joins.in_any_not_in(below, members, _states(t, "LMN"), TAG)


# Joins


@_on_tables("semi_join_state")
def semi_join_state(t: Tables) -> DataFrame:
    members = _states(t, "LGR").filter(p.flags_are(below=1))
    rows = joins.semi_join(_main(t.detections), members)
    return rows.select("tag_code", "site_name", "obs_time")


@_on_tables("anti_join_state")
def anti_join_state(t: Tables) -> DataFrame:
    rows = _main(t.detections).filter(p.at_dam("LMN"))
    return joins.anti_join(rows, _states(t, "LMN")).select("tag_code", "obs_time")


@_on_detections("self_semi_detected_at")
def self_semi_detected_at(det: DataFrame) -> DataFrame:
    return joins.detected_at(det, "MCN")


@_on_detections("self_anti_never_at")
def self_anti_never_at(det: DataFrame) -> DataFrame:
    return joins.detected_at_never_at(det, "LMN", "LGS")


@_on_detections("detected_never_removed")
def detected_never_removed(det: DataFrame) -> DataFrame:
    return joins.detected_never_removed(det, "MCN")


@_on_tables("semi_join_state_difference")
def semi_join_state_difference(t: Tables) -> DataFrame:
    members = _states(t, "LGR").filter(p.flags_are(below=1))
    missed = joins.anti_join(members, _states(t, "LMN"))
    return joins.semi_join(aggregates.last_obs(_main(t.detections), MCN_SITES), missed)


@_on_tables("membership_any_of_two")
def membership_any_of_two(t: Tables) -> DataFrame:
    tags = aggregates.distinct_tags(_main(t.detections))
    members = [_states(t, "LGS"), _states(t, "LMN")]
    return joins.in_any_not_in(tags, members, _states(t, "MCN"), TAG)


@_on_tables("membership_any_of_three")
def membership_any_of_three(t: Tables) -> DataFrame:
    tags = aggregates.distinct_tags(_main(t.detections))
    members = [_states(t, "LGR"), _states(t, "LGS"), _states(t, "LMN")]
    return joins.in_any_not_in(tags, members, _states(t, "MCN"), TAG)


@_on_tables("release_age_semi_join")
def release_age_semi_join(t: Tables) -> DataFrame:
    rows = joins.of_age(_releases(t.detections), t.tagging, "Yearling+")
    return rows.select("source", "tag_code", "site_name", "obs_time")


# Aggregations


def _last_obs(dam: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        det = _main(source.detections(spark, sf_dir))
        return aggregates.last_obs(det, fv.dam_site_names(dam))

    return query


for _dam in fv.FILLED_DAMS:
    QUERIES[f"last_obs_{_dam.lower()}"] = _last_obs(_dam)


@_on_detections("last_obs_in_season")
def last_obs_in_season(det: DataFrame) -> DataFrame:
    return aggregates.last_obs_in_season(_main(det), fv.dam_site_names("LGS"), "spring")


@_on_detections("distinct_tags")
def distinct_tags(det: DataFrame) -> DataFrame:
    return aggregates.distinct_tags(det)


@_on_detections("last_obs_by_source")
def last_obs_by_source(det: DataFrame) -> DataFrame:
    return aggregates.last_obs_by_source(det, LMN_SITES)


# Set operations


def _union_keys(branches: int) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        det = source.detections(spark, sf_dir).filter(p.at_dam("MCN"))
        parts = [det.filter(F.col("source") == s) for s in fv.SOURCES[:branches]]
        return sets.union_keys(parts)

    return query


for _n in (2, 3, 4):
    QUERIES[f"union_keys_{_n}"] = _union_keys(_n)


@_on_detections("union_last_obs")
def union_last_obs(det: DataFrame) -> DataFrame:
    by_source = aggregates.last_obs_by_source(det, MCN_SITES)
    skipped = joins.detected_at_never_at(_releases(det), "MCN", "LMN")
    releases = joins.semi_join(by_source, skipped, SOURCE_TAG)
    return sets.union_last_obs([_main(by_source), releases])


@_on_tables("union_tagging")
def union_tagging(t: Tables) -> DataFrame:
    return sets.union_tagging(t.tagging, fv.SOURCES)


@_on_detections("union_detected_below")
def union_detected_below(det: DataFrame) -> DataFrame:
    return sets.union_detected_below(det, fv.SOURCES, "below_mcn")


@_on_tables("chained_insert")
def chained_insert(t: Tables) -> DataFrame:
    below = t.detections.filter(p.detected_below("below_lgs"))
    below = aggregates.distinct_tags(below, SOURCE_TAG)
    known = joins.semi_join(below, _states(t, "LGR"))
    parts = [known.filter(F.col("source") == s) for s in fv.SOURCES[:3]]
    return sets.chained_insert(_states(t, "LGS"), parts, TAG)


# State updates


def _lgs(t: Tables) -> DataFrame:
    return _states(t, "LGS")


def _shown(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.select("basin", "run", "tag_code", *columns)


@_on_tables("append_missing_tags")
def append_missing_tags(t: Tables) -> DataFrame:
    missed = _states(t, "LGR").filter(p.flags_are(at_dam=0, below=1))
    rows = state.append_missing(_lgs(t).drop("species_group", "species"), missed, "LGS")
    return _shown(rows, "dam", "spp", "upstream", "at_dam", "below")


@_on_tables("set_upstream_flag")
def set_upstream_flag(t: Tables) -> DataFrame:
    return _shown(state.set_upstream(_lgs(t)), "upstream", "at_dam")


@_on_tables("removed_clears_below")
def removed_clears_below(t: Tables) -> DataFrame:
    rows = _states(t, "LGR").withColumn("below", F.lit(1))
    return _shown(state.removed_clears_below(rows), "at_dam", "below")


@_on_tables("set_history_101")
def set_history_101(t: Tables) -> DataFrame:
    rows = state.set_history_101(_states(t, *fv.DAMS))
    return _shown(rows, "dam", "upstream", "at_dam", "below")


@_on_tables("merge_detected")
def merge_detected(t: Tables) -> DataFrame:
    kept = joins.detected_never_removed(_main(t.detections), "LGS")
    return _shown(state.merge_flag(_lgs(t), kept, "at_dam", 1, TAG), "at_dam")


def _removed_at_lgs(t: Tables) -> DataFrame:
    return _main(t.detections).filter(p.at_dam("LGS") & p.on_removal_antenna())


@_on_tables("merge_removed")
def merge_removed(t: Tables) -> DataFrame:
    return _shown(state.merge_flag(_lgs(t), _removed_at_lgs(t), "at_dam", 2, TAG), "at_dam")


@_on_tables("merge_below")
def merge_below(t: Tables) -> DataFrame:
    below = sets.union_detected_below(t.detections, (fv.MAIN,), "below_lgs")
    return _shown(state.merge_flag(_lgs(t), below, "below", 1, TAG), "below")


@_on_tables("merge_pass_date")
def merge_pass_date(t: Tables) -> DataFrame:
    last = aggregates.last_obs(_main(t.detections), fv.dam_site_names("LGS"))
    return _shown(state.merge_pass_date(_lgs(t), last, TAG), "pass_date")


@_on_tables("merge_release_facts")
def merge_release_facts(t: Tables) -> DataFrame:
    facts = sets.union_tagging(t.tagging, (fv.MAIN,))
    return _shown(state.merge_release_facts(_lgs(t), facts), "run_type", "release_date")


@_on_tables("at_dam_code")
def at_dam_code(t: Tables) -> DataFrame:
    seen = joins.detected_at(_main(t.detections), "LGS")
    return _shown(state.at_dam_code(_lgs(t), seen, _removed_at_lgs(t), TAG), "at_dam")


# Batches and whole runs


def _batch(name: str, populations: tuple[fv.Population, ...]) -> Query:
    """What an appending batch adds, or the table a filling batch leaves."""
    names, dam = BATCH_NAMES[: BATCH_NAMES.index(name) + 1], _BATCH_DAM[name]

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = tables(spark, sf_dir)
        rows = run_batches(
            t.detections,
            t.tagging,
            t.passage,
            populations,
            names,
            (dam,),
            name in APPENDS,
            partitions=t.partitions,
        )
        if name in APPENDS:
            return rows.filter(F.col("added") == name).select("basin", "run", "tag_code")
        return rows.drop("dam")

    return query


def _history(populations: tuple[fv.Population, ...]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = tables(spark, sf_dir)
        return run_batches(t.detections, t.tagging, t.passage, populations, partitions=t.partitions)

    return query


for _name, _query in BATCH_QUERIES.items():
    if _name < FIRST_RELEASE_BATCH:
        QUERIES[_query] = _batch(_name, fv.POPULATIONS)
    else:
        QUERIES[_query] = _batch(_name, TRIBUTARIES)
        QUERIES[f"{_query}_release"] = _batch(_name, SNAKE)

for _run in ("CH0", "CH1", "STH"):
    QUERIES[f"history_tributary_{_run.lower()}"] = _history(
        tuple(q for q in TRIBUTARIES if q.run == _run)
    )
    QUERIES[f"history_snake_{_run.lower()}"] = _history(select_populations("snake", _run))
QUERIES["history_all_populations"] = _history(fv.POPULATIONS)
