"""The logical tables derived from an order/line-item star schema.

One order stands for one individual and one line item for one detection. The
whole tables are mapped; FIXTURES.md gives the rules.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirwalk import fixed_values as fv
from weirwalk.functions.predicates import any_of, at_dam
from weirwalk.sources.tables import checked_detections, checked_passage, checked_tagging

# What the mapped sites, antennas, basins and ages are called.
UPPER_ADULT_SITE = "AFF - Upper ADULT Fishway"
LADDER_SITE = "LDR - East Ladder"
BASINS = ("clearwater", "salmon", "snake")
RUNS = ("CH0", "CH1", "STH")

# Run names and flags (upstream, at the checkpoint, below; -1 is none) of an earlier run.
OLD_RUNS = ("Old run 0", "Old run 1", "Old run 2")
OLD_FLAGS = ((-1, -1, 1, 0, -1, 1), (-1, -1, 0, 1, 2, -1), (-1, -1, 1, -1, 1, 0))

# The columns of the driver tables that are mapped; the schema spares reading footers.
ORDERS = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_orderdate timestamp_ntz, o_orderpriority string"
)
# Every so many-th block of keys of the Snake is tagged and seen in two sources,
# every second of them in three.
SHARED_BLOCK, SHARED_EVERY, SHARED_AT = 7, 16, 3
LINEITEM = (
    "l_orderkey bigint, l_partkey bigint, l_linenumber int, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
)
# Orders and line items that a task is dealt, so that what it sorts does not grow with the tables.
ROWS_A_TASK = 500_000


@dataclass(frozen=True)
class Tables:
    """The three inputs of every passage job, and the partitions that their size asks for."""

    detections: DataFrame
    tagging: DataFrame
    passage: DataFrame
    partitions: int = 1


def _pick(index: Column, values: tuple[str | int, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def tag_code(key: Column) -> Column:
    digits = key.cast("string")
    return F.concat(F.lit("T"), F.lpad(digits, F.greatest(F.length(digits), F.lit(8)), F.lit("0")))


def partitions(spark: SparkSession, sf_dir: str) -> int:
    """Partitions of ``ROWS_A_TASK`` orders and line items; they are counted from the files' footers."""
    orders = spark.read.schema(ORDERS).parquet(f"{sf_dir}/orders.parquet")
    lines = spark.read.schema(LINEITEM).parquet(f"{sf_dir}/lineitem.parquet")
    return -(-(orders.count() + lines.count()) // ROWS_A_TASK) or 1


def _dealt_by_key(rows: DataFrame, parts: int) -> DataFrame:
    """Rows shuffled by key into ``parts`` partitions, one for each core at least.

    The number is named, as the configured one need not follow the tables, and partitions are
    merged by compressed bytes. One partition's rows are left to Spark, which may broadcast them.
    """
    if parts == 1:
        return rows
    return rows.repartition(max(parts, rows.sparkSession.sparkContext.defaultParallelism), "key")


def _line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.read.schema(LINEITEM).parquet(f"{sf_dir}/lineitem.parquet")
    names = tuple(name for _, _, name, _ in fv.SITES) + (UPPER_ADULT_SITE, LADDER_SITE)
    return lines.withColumn("site_name", _pick(F.col("l_partkey") % 12, names))


def _individuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.schema(ORDERS).parquet(f"{sf_dir}/orders.parquet")
    key = F.col("o_orderkey")
    block = F.expr("o_orderkey div 20") % 6
    release = _pick(F.greatest(block - 2, F.lit(0)), fv.SOURCES)
    return orders.select(
        key.alias("key"),
        _pick(F.col("o_custkey") % 3, BASINS).alias("basin"),
        _pick(F.expr("o_orderkey div 60") % 3, RUNS).alias("run"),
        release.alias("release"),
        F.year("o_orderdate").alias("migration_year"),
        F.col("o_orderpriority").alias("run_name"),
        F.col("o_orderdate").alias("release_date"),
        F.when(F.col("o_orderstatus") == "F", "Subyearling").otherwise("Yearling+").alias("age"),
    ).withColumns(
        {
            "species_group": F.when(F.col("run") == "STH", "STH").otherwise("CHK"),
            "source": F.when(F.col("basin") == "snake", F.col("release")).otherwise(fv.MAIN),
        }
    )


def _in_all_sources(fish: DataFrame) -> DataFrame:
    """The individuals once for each source that lists them: ``copy`` 0 is their own, 1 and 2 the next ones."""
    block = F.expr(f"key div {SHARED_BLOCK}")
    copies = F.when(F.col("basin") != "snake", 0).when(block % SHARED_EVERY != SHARED_AT, 0)
    copies = copies.when(block % (2 * SHARED_EVERY) == SHARED_AT, 2).otherwise(1)
    own = F.array_position(F.array(*[F.lit(s) for s in fv.SOURCES]), F.col("source")) - 1
    return fish.withColumn("copy", F.explode(F.sequence(F.lit(0), copies))).withColumn(
        "source", _pick((own + F.col("copy")) % len(fv.SOURCES), fv.SOURCES)
    )


def detections(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """Line items as detections; ``parts`` are the ``partitions`` where they are known."""
    parts = parts or partitions(spark, sf_dir)
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    # Other sources saw the individual at other times, at some of the sites, and never removed it.
    antenna = (
        F.when(F.col("copy") > 0, "RIVER EXIT")
        .when((flag == "R") & (status == "F"), "SAMPLE ROOM")
        .when((flag == "A") & (status == "F"), "East Raceway 3")
        .otherwise("RIVER EXIT")
    )
    one, zero = F.lit(1), F.lit(0)
    april = F.make_timestamp_ntz(F.year("l_shipdate"), F.lit(4), one, zero, zero, zero)
    shift = F.make_dt_interval(F.dayofyear("l_shipdate") % 100, F.col("l_linenumber"))
    lines = _line_items(spark, sf_dir).select(
        F.col("l_orderkey").alias("key"),
        "l_returnflag",
        "l_linestatus",
        "site_name",
        (april + shift).alias("obs_time"),
        F.when(F.col("l_linenumber") % 2 == 1, 2).otherwise(-2).alias("days"),
        (F.expr("l_partkey div 12") % 3 != 0).alias("copied"),
    )
    fish = _in_all_sources(_individuals(spark, sf_dir))
    fish = fish.select("key", "migration_year", "source", "species_group", "copy")
    both = _dealt_by_key(lines, parts).join(_dealt_by_key(fish, parts), "key")
    rows = both.filter((F.col("copy") == 0) | F.col("copied")).select(
        tag_code(F.col("key")).alias("tag_code"),
        "site_name",
        antenna.alias("antenna_group"),
        (F.col("obs_time") + F.make_dt_interval(F.col("days") * F.col("copy"))).alias("obs_time"),
        "migration_year",
        "source",
        "species_group",
    )
    return checked_detections(rows)


def tagging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as tagging facts. The main source serves every species; sources contradict each other."""
    group = F.when(F.col("source") != fv.MAIN, F.col("species_group"))
    copy = F.col("copy")
    days = F.when(F.col("key") % 2 == 1, 3).otherwise(-3)
    other_age = F.when(F.col("age") == "Yearling+", "Subyearling").otherwise("Yearling+")
    name = F.concat(F.lit("Conflict "), copy.cast("string"))
    rows = _in_all_sources(_individuals(spark, sf_dir)).select(
        tag_code(F.col("key")).alias("tag_code"),
        F.when(copy > 0, name).otherwise(F.col("run_name")).alias("run_name"),
        (F.col("release_date") + F.make_dt_interval(days * copy)).alias("release_date"),
        F.when(copy == 1, other_age).otherwise(F.col("age")).alias("age"),
        "source",
        group.alias("species_group"),
    )
    return checked_tagging(rows)


def passage(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """Orders as the start state of the passage tables of all four checkpoints.

    Rows of the three lower checkpoints hold values of an earlier run: names, dates
    and flags, any of them missing in some rows. ``parts`` as for the detections.
    """
    parts = parts or partitions(spark, sf_dir)
    seen = (
        _line_items(spark, sf_dir)
        .filter(any_of([at_dam(d) for d in fv.FILLED_DAMS]))
        .select(F.col("l_orderkey").alias("key"), *[at_dam(d).alias(d) for d in fv.FILLED_DAMS])
    )
    seen = _dealt_by_key(seen, parts).groupBy("key").agg(*[F.bool_or(d).alias(d) for d in fv.FILLED_DAMS])
    key = F.col("key")
    fish = _individuals(spark, sf_dir).select("key", "basin", "run", F.col("release_date").alias("day"))
    at_lgr = (key % 3).cast("int")
    below = F.when((key % 3 != 2) & (F.expr("key div 3") % 5 < 4), 1).otherwise(0)
    spp = F.when(F.col("run") == "STH", "Steelhead").otherwise("Chinook")
    spp = F.when(F.expr("key div 12") % 5 == 0, "Coho").otherwise(spp)
    spp = F.when((key % 2 == 1) & (F.col("dam") != "LGR"), spp)

    def entry(dam: str, up: Column, at: Column, under: Column) -> Column:
        place = F.lit(fv.DAMS.index(dam)).alias("place")
        flags = (up.alias("upstream"), at.alias("at_dam"), under.alias("below"))
        return F.struct(F.lit(dam).alias("dam"), place, *flags)

    def old(dam: str) -> Column:
        """Flags of an earlier run, by the key and the checkpoint."""
        turn = (F.expr("key div 12") + 2 * fv.DAMS.index(dam)) % 6
        flags = [_pick(turn, values) for values in OLD_FLAGS]
        return entry(dam, *[F.nullif(flag, F.lit(-1)) for flag in flags])

    none = F.lit(None).cast("int")
    entries = F.array(
        entry("LGR", none, at_lgr, below),
        F.when(F.col("LGS") & (key % 3 == 1), old("LGS")),
        F.when(F.col("LMN") & (key % 4 == 0), old("LMN")),
        F.when(F.col("MCN") & (key % 5 == 0), old("MCN")),
    )
    block, place = F.expr("key div 12"), F.col("place")
    turn, lower = block + place, place > 0
    older = F.col("day") - F.make_dt_interval((block % 20 + 5).cast("int"))
    later = F.col("day") + F.make_dt_interval((block % 7).cast("int"), place)
    rows = (
        _dealt_by_key(fish, parts)
        .join(seen, "key", "left")
        .select("key", "basin", "run", "day", F.explode(entries).alias("entry"))
        .filter(F.col("entry").isNotNull())
        .select("key", "basin", "run", "day", "entry.*")
        .select(
            "basin",
            "run",
            "dam",
            tag_code(key).alias("tag_code"),
            spp.alias("spp"),
            F.when(lower & (turn % 4 != 0), _pick(block % 3, OLD_RUNS)).alias("run_type"),
            F.when(lower & (turn % 3 != 0), older).alias("release_date"),
            F.when(lower & (turn % 5 > 1), later).alias("pass_date"),
            "upstream",
            "at_dam",
            "below",
        )
    )
    return checked_passage(rows)


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    """All three logical tables of a scale-factor directory."""
    parts = partitions(spark, sf_dir)
    return Tables(
        detections(spark, sf_dir, parts), tagging(spark, sf_dir), passage(spark, sf_dir, parts), parts
    )
