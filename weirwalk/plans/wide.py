"""One row per (population, tag) that carries all the batches read and write.

No batch relates two tags, so once the inputs meet on the tag every batch is a
column expression. Each input is read once and shuffled once on (tag_code,
species_group): detections as already combined bit marks (twice where more partitions are
asked for than are configured), tagging rows and passage rows. Passage and tagging rows of a tag are sorted together on
that partitioning, and one full outer join puts the marks beside them: a tag has a
wide row whichever input it is in, so no input can be left unread and unchecked.
Behind the sort a task holds the rows of one tag at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weirwalk import fixed_values as fv
from weirwalk import schema
from weirwalk.fixed_values import Population
from weirwalk.functions.features import (
    LAST_OBS,
    MARKS,
    bits,
    known_source,
    last_column,
    required,
    seen_at_releases,
    tag_features,
)
from weirwalk.functions.predicates import season_bounds
from weirwalk.operators.aggregates import TAG

# Stands for NULL in a flag while the batches run, so that tests of flags are
# two-valued. Passage tables never hold it.
UNSET = -1
FACTS_TYPE = "struct<release_date: timestamp_ntz, run_name: string>"
FLAGS = ("upstream", "at_dam", "below")


def population_table(spark: SparkSession, populations: tuple[Population, ...]) -> DataFrame:
    """The population parameters as a small table, one row per population."""
    if len({(p.basin, p.run) for p in populations}) < len(populations):
        raise ValueError("a (basin, run) occurs twice")
    masks = _age_masks(populations)
    rows = [
        {
            "population": i,
            "basin": p.basin,
            "run": p.run,
            "species": p.spp,
            "species_group": p.species_group,
            "season": p.season,
            "season_first": season_bounds(p.season)[0],
            "season_last": season_bounds(p.season)[1],
            "age": p.age,
            **{f"age_{n}": mask.get(p.age, 0) for n, mask in enumerate(masks)},
            "has_releases": bool(p.release_sources),
            **{f"sees_{s}": s == fv.MAIN or s in p.release_sources for s in fv.SOURCES},
        }
        for i, p in enumerate(populations)
    ]
    text, number, flag = pa.string(), pa.int32(), pa.bool_()
    fields = [
        pa.field("population", number, False),
        pa.field("basin", text, False),
        pa.field("run", text, False),
        pa.field("species", text, False),
        pa.field("species_group", text, False),
        pa.field("season", text, False),
        pa.field("season_first", number, False),
        pa.field("season_last", number, False),
        pa.field("age", text),
        *[pa.field(f"age_{n}", pa.int64(), False) for n in range(len(masks))],
        pa.field("has_releases", flag, False),
        *[pa.field(f"sees_{s}", flag, False) for s in fv.SOURCES],
    ]
    return spark.createDataFrame(pa.Table.from_pylist(rows, pa.schema(fields)))


def _age_masks(populations: tuple[Population, ...]) -> list[dict[str, int]]:
    """A bit for each age class of the populations, in as many longs as that takes."""
    ages = sorted({p.age for p in populations if p.age is not None})
    longs = [ages[first : first + 63] for first in range(0, len(ages), 63)]
    return [{age: 1 << bit for bit, age in enumerate(some)} for some in longs]


def _one_of(column: str, values: tuple[str, ...]) -> Column:
    return F.col(column) == values[0] if len(values) == 1 else F.col(column).isin(list(values))


def _groups(populations: tuple[Population, ...]) -> list[str]:
    return sorted({p.species_group for p in populations})


def _of(populations: tuple[Population, ...], rows: DataFrame) -> DataFrame:
    """Passage rows of the populations: a static filter, so that stored partitions are pruned."""
    wanted = F.lit(False)
    for p in populations:
        wanted = wanted | ((F.col("basin") == p.basin) & (F.col("run") == p.run))
    return rows.filter(wanted)


def _configured(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _dealt_by_tag(rows: DataFrame, partitions: int) -> DataFrame:
    """Rows shuffled by tag into as many partitions as the configuration says, or more.

    The number is named, so that they are not merged: what they are merged by are
    compressed bytes, and rows that are sorted take many times as many.
    """
    return rows.repartition(max(partitions, _configured(rows.sparkSession)), *TAG)


def states_by_tag(
    passage: DataFrame,
    tagging: DataFrame | None,
    known: DataFrame,
    populations: tuple[Population, ...],
    partitions: int = 1,
) -> DataFrame:
    """Passage rows as one row per tag and population, with the tag's tagging facts beside them.

    ``held_by`` is the population, NULL on a row of the tagging facts alone; a column for each
    checkpoint has the tag's row there, or NULL; ``leads`` marks one row of each tag and ``held``
    is the set of all its populations. The columns of ``_of_tagging`` follow. Fails on a NULL tag, on a key
    that occurs twice at a checkpoint and on an unknown checkpoint.

    Tagging rows get the partitioning that the passage rows get, ``partitions`` where that is more than is
    configured, and one sort serves the grouping of both, what is told of a tag as a whole, and the join behind.
    """
    known = F.broadcast(known.select("population", "basin", "run", "species_group"))
    unknown = F.raise_error(
        F.concat(F.lit("unknown checkpoint: "), F.coalesce("dam", F.lit("NULL")))
    )
    dam = F.when(F.coalesce(F.col("dam").isin(list(fv.DAMS)), F.lit(False)), F.col("dam"))
    rows = _of(populations, passage).withColumns(
        {"dam": F.coalesce(dam, unknown), "tag_code": required("tag_code")}
    )
    rows = _dealt_by_tag(rows.join(known, ["basin", "run"]).drop("basin", "run"), partitions)
    facts: dict[str, Column] = {}
    if tagging is not None:
        # Not grouped before they are dealt: hardly a tag is listed twice, and a grouping
        # would hold all that a task scans.
        listed = _dealt_by_tag(tagging_rows(tagging, populations), partitions)
        rows = rows.unionByName(listed, allowMissingColumns=True)
        facts = _of_tagging(populations)
    pivot = [column.alias(name) for name, column in facts.items()]
    for dam in fv.DAMS:
        values = F.when(F.col("dam") == dam, F.struct(*schema.PASSAGE_VALUES))
        pivot.append(F.first(values, ignorenulls=True).alias(dam))
        pivot.append(F.count(values).alias(f"n_{dam}"))
    by_population = rows.groupBy(*TAG, "population").agg(*pivot)
    most = F.greatest(*[F.col(f"n_{dam}") for dam in fv.DAMS])
    twice = F.raise_error(F.concat(F.lit("tag repeats in a passage table: "), F.col("tag_code")))
    held_by = F.when(most > 1, twice.cast("int")).otherwise(F.col("population"))
    # The row of the tagging facts has no population and comes first.
    of_tag = Window.partitionBy(*TAG).orderBy("population")
    so_far = of_tag.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = of_tag.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # One row for each population: as many as the configuration has, whatever the data.
    return by_population.select(
        *TAG,
        held_by.alias("held_by"),
        *fv.DAMS,
        (F.row_number().over(of_tag) == 1).alias("leads"),
        F.collect_set("population").over(whole).alias("held"),
        *[F.first(c, ignorenulls=True).over(so_far).alias(c) for c in facts],
    )


def tagging_rows(tagging: DataFrame, populations: tuple[Population, ...]) -> DataFrame:
    """Tagging rows, once for each species group that they serve, with their ages as bits."""
    groups = F.array(*[F.lit(g) for g in _groups(populations)])
    group = F.when(F.col("species_group").isNull(), groups).otherwise(F.array("species_group"))
    rows = tagging.withColumns({"source": known_source(), "tag_code": required("tag_code")})
    ages = []
    for n, mask in enumerate(_age_masks(populations)):
        bit = [F.lit(v) if isinstance(v, str) else F.lit(v).cast("long") for p in mask.items() for v in p]
        ages.append(F.try_element_at(F.create_map(*bit), F.col("age")).alias(f"age_{n}"))
    rows = rows.withColumn("species_group", F.explode(group))
    return rows.select(*TAG, "source", "release_date", "run_name", *ages)


def _of_tagging(populations: tuple[Population, ...]) -> dict[str, Column]:
    """What a tag's tagging rows say of it, by source.

    ``tagged_<source>`` holds the facts of a source; one that lists the tag twice
    gives the lowest (release_date, run_name). ``ages_<source>_<n>`` has the bits of its ages.
    Neither needs objects, so that rows are grouped in the order in which they are sorted.
    """
    facts = F.struct("release_date", "run_name")
    here = {source: F.col("source") == source for source in fv.SOURCES}
    told = {f"tagged_{s}": F.min(F.when(here[s], facts)) for s in fv.SOURCES}
    for n in range(len(_age_masks(populations))):
        for s in fv.SOURCES:
            told[f"ages_{s}_{n}"] = F.bit_or(F.when(here[s], F.col(f"age_{n}")))
    return told


def _population_ids(populations: tuple[Population, ...]) -> Column:
    """The population in whose tables the tag is; on one row of the tag also those with releases
    that a tag of a release source may enter without being in any table.
    """
    enters = {
        group: [
            i for i, p in enumerate(populations) if p.release_sources and p.species_group == group
        ]
        for group in _groups(populations)
    }
    none = F.array().cast("array<int>")
    ids = none
    for group, numbers in enters.items():
        if numbers:
            new = F.array(*[F.lit(i) for i in numbers])
            ids = F.when((F.col("species_group") == group) & seen_at_releases(), new).otherwise(ids)
    # A tag that only detections know has no row of its own, and leads none.
    leads = F.coalesce("leads", F.lit(True))
    ids = F.when(leads, F.array_except(ids, F.coalesce("held", none))).otherwise(none)
    own = F.array_compact(F.array("held_by"))
    # The species group is that of either side of the join, so the condition keeps both sides.
    return F.when(F.col("species_group").isNotNull(), F.concat(own, ids))


def _held(dam: str) -> list[str]:
    """A checkpoint's columns from the tag's row there, which is NULL where the population's table has none."""
    columns = [f"{dam} IS NOT NULL AS in_{dam}", f"CAST(NULL AS string) AS added_{dam}"]
    for name in schema.PASSAGE_VALUES:
        value = f"{dam}.{name}"
        value = f"coalesce({value}, {UNSET})" if name in FLAGS else value
        columns.append(f"{value} AS {dam}_{name}")
    return columns


def _population_marks(n_ages: int) -> Column:
    """The marks as the row's population sees them.

    Drops the sources that the population does not read and adds the age and
    season facts. No age class means every tag is of the right age. The bits of the age
    classes are in ``n_ages`` columns.
    """
    found = [F.col("marks")]
    for source in fv.SOURCES:
        of_age = F.col("age").isNull()
        for n in range(n_ages):
            same = F.col(f"ages_{source}_{n}").bitwiseAND(F.col(f"age_{n}")) != 0
            of_age = of_age | F.coalesce(same, F.lit(False))
        found.append(F.when(of_age, _bit((source, "aged"))).otherwise(_bit()))
    for source, dam in LAST_OBS:
        day = f"day_{last_column(source, dam)}"
        in_season = F.expr(f"{day} BETWEEN season_first AND season_last")
        fact = (source, f"season_{dam.lower()}")
        found.append(F.when(in_season, _bit(fact)).otherwise(_bit()))
    # A fold is not generated code: it keeps the join before and the batches behind in
    # methods of their own, each small enough to be compiled.
    marks = F.aggregate(F.array(*found), _bit(), lambda done, one: done.bitwiseOR(one))
    visible = _bit(*[m for m in MARKS if m[0] == fv.MAIN])
    for source in fv.RELEASE_SOURCES:
        of_source = _bit(*[m for m in MARKS if m[0] == source])
        visible = visible.bitwiseOR(F.when(F.col(f"sees_{source}"), of_source).otherwise(_bit()))
    return marks.bitwiseAND(visible)


def _bit(*facts: tuple[str, str]) -> Column:
    return F.lit(bits(facts)).cast("long")


def _facts() -> list[Column]:
    """``facts_<source>``: from the first source that the population reads and that
    lists the tag, in the fixed order, up to and with that one.
    """
    seen = [F.when(F.col(f"sees_{s}"), F.col(f"tagged_{s}")) for s in fv.SOURCES]
    return [F.coalesce(*seen[: i + 1]).alias(f"facts_{s}") for i, s in enumerate(fv.SOURCES)]


def _no_facts(populations: tuple[Population, ...]) -> list[Column]:
    """The columns of ``_of_tagging`` where tagging is not read."""
    kinds = {name: FACTS_TYPE if name.startswith("tagged_") else "long" for name in _of_tagging(populations)}
    return [F.lit(None).cast(kind).alias(name) for name, kind in kinds.items()]


def wide_rows(
    detections: DataFrame,
    tagging: DataFrame | None,
    passage: DataFrame,
    populations: tuple[Population, ...] = fv.POPULATIONS,
    sources: tuple[str, ...] = fv.SOURCES,
    partitions: int = 1,
) -> DataFrame:
    """The wide rows of the populations, before any batch.

    ``sources`` are the detection sources that will be looked at; without ``tagging``
    no tag has facts or ages. The rows lie in ``partitions`` where that is more than is configured.
    """
    groups = _groups(populations)
    detections = detections.filter(F.col("species_group").isin(groups))
    if not any(p.release_sources for p in populations):
        sources = (fv.MAIN,)
        tagging = None if tagging is None else tagging.filter(F.col("source") == fv.MAIN)
    if sources != fv.SOURCES:
        detections = detections.filter(_one_of("source", sources))
    known = F.broadcast(population_table(passage.sparkSession, populations))
    last = [last_column(source, dam) for source, dam in LAST_OBS]
    # Month and day as one number, once per tag and not once per population.
    days = {f"day_{c}": F.month(c) * 100 + F.day(c) for c in last}
    here = F.col("population") == F.col("held_by")
    states = states_by_tag(passage, tagging, known, populations, partitions)
    if tagging is None:
        states = states.select("*", *_no_facts(populations))
    features = tag_features(detections)
    if partitions > _configured(passage.sparkSession):
        # Combined on the map side and summed in the configured number, which they leave as one row per tag.
        features = _dealt_by_tag(features, partitions)
    rows = (
        features.withColumns(days)
        .join(states, list(TAG), "full_outer")
        .withColumn("marks", F.coalesce("marks", F.lit(0).cast("long")))
        .withColumn("population", F.explode(_population_ids(populations)))
        .join(known.drop("species_group", "season"), "population")
        .withColumns({dam: F.when(here, F.col(dam)) for dam in fv.DAMS})
    )
    columns = ["tag_code", "basin", "run", "species", "has_releases"]
    for source, dam in LAST_OBS:
        last = last_column(source, dam)
        columns.append(f"CASE WHEN sees_{source} THEN {last} END AS {last}")
    for dam in fv.DAMS:
        columns += _held(dam)
    marks = _population_marks(len(_age_masks(populations))).alias("marks")
    return rows.select(marks, *_facts(), *[F.expr(column) for column in columns])


@dataclass(frozen=True)
class Facts:
    """Tagging sources, in order, of a checkpoint's rows, and batches whose rows get none."""

    sources: tuple[str, ...]
    not_added_by: tuple[str, ...] = ()


def passage_tables(
    wide: DataFrame,
    facts: dict[str, Facts],
    dams: tuple[str, ...] = fv.FILLED_DAMS,
    added: bool = False,
) -> DataFrame:
    """Wide rows back as passage rows; a narrow step.

    ``facts`` names the checkpoints whose species and tagging facts are set. A
    tagging match overwrites run and release date, also with NULL. ``added`` adds the batch that appended the row, NULL for
    rows of the start state.
    """
    if not set(dams) <= set(fv.FILLED_DAMS):
        raise ValueError(f"not among {fv.FILLED_DAMS}: {dams}")
    key = ("basin", "run", "tag_code")
    tracked = added or any(f.not_added_by for f in facts.values())

    def entry(dam: str) -> Column:
        fields = [f"'dam', '{dam}'"]
        for value in schema.PASSAGE_VALUES:
            held = f"{dam}_{value}"
            held = f"nullif({held}, {UNSET})" if value in FLAGS else held
            fields.append(f"'{value}', {held}")
        fields += [f"'added', added_{dam}"] if tracked else []
        return F.expr(f"CASE WHEN in_{dam} THEN named_struct({', '.join(fields)}) END")

    entries = F.array_compact(F.array(*[entry(dam) for dam in dams]))
    sources = ("species", "has_releases", *[f"facts_{s}" for s in fv.SOURCES])
    rows = wide.select(*key, *sources, F.explode(entries).alias("entry"))
    rows = rows.select(*key, *sources, "entry.*")

    tagged = F.when(F.lit(False), F.col(f"facts_{fv.MAIN}"))
    filled = F.lit(False)
    for dam, written in facts.items():
        here = F.col("dam") == dam
        if written.not_added_by:
            late = F.col("added").isin(list(written.not_added_by))
            here = here & ~F.coalesce(late, F.lit(False))
        if len(written.sources) > 1:
            upto = F.col(f"facts_{written.sources[-1]}")
            tagged = tagged.when(here & F.col("has_releases"), upto)
        tagged = tagged.when(here, F.col(f"facts_{fv.MAIN}"))
        filled = filled | here
    rows = rows.withColumn("tagged", tagged)
    hit = F.col("tagged").isNotNull()
    rows = rows.withColumns(
        {
            "spp": F.when(filled, F.coalesce("spp", "species")).otherwise(F.col("spp")),
            "run_type": F.when(hit, F.col("tagged.run_name")).otherwise(F.col("run_type")),
            "release_date": F.when(hit, F.col("tagged.release_date")).otherwise(
                F.col("release_date")
            ),
        }
    )
    columns = ["dam", *schema.PASSAGE_VALUES, *(["added"] if added else [])]
    return rows.select(*key, *columns)
