"""Per-tag features: everything the batches ask of the detections, in one pass.

Each detection becomes a bit mark: ten yes/no facts for each of four sources,
40 bits of one long. OR and MAX combine on the map side, so a tag holding a
large share of all detections leaves each map task as one row.

Twelve more bits are for facts about the tag and its population: whether it was
tagged at the right age in a source, and whether a last detection falls in the
season. With them a batch tests all it needs in one masked comparison.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirwalk import fixed_values as fv
from weirwalk.functions.predicates import adult_return, on_removal_antenna, season_bounds

FACTS = (
    "at_lgs",
    "at_lmn",
    "at_mcn",
    "removed_lgs",
    "removed_lmn",
    "removed_mcn",
    "below_lgs",
    "below_lmn",
    "below_mcn",
    "below_lmn_101",
)

# The last observation times some batch reads, by source.
LAST_OBS = (
    (fv.MAIN, "LGS"),
    (fv.MAIN, "LMN"),
    (fv.MAIN, "MCN"),
    (fv.LGR_RELEASE, "LMN"),
    (fv.LGR_RELEASE, "MCN"),
    (fv.LGS_RELEASE, "LMN"),
    (fv.LGS_RELEASE, "MCN"),
    (fv.LMN_RELEASE, "MCN"),
)

# A fact is named by (source, fact); the order here is the order of the bits.
MARKS = (
    [(source, fact) for source in fv.SOURCES for fact in FACTS]
    + [(source, "aged") for source in fv.SOURCES]
    + [(source, f"season_{dam.lower()}") for source, dam in LAST_OBS]
)
Fact = tuple[str, str]


def bits(facts: Iterable[Fact]) -> int:
    """The bits that stand for the facts."""
    return sum(1 << MARKS.index(fact) for fact in set(facts))


def has_any(facts: Iterable[Fact]) -> Column:
    """At least one of the facts holds for the row's marks."""
    return F.expr(f"marks & {bits(facts)}L <> 0L")


def has_all(facts: Iterable[Fact], but_none: Iterable[Fact] = ()) -> Column:
    """All of the facts hold for the row's marks and none of the others does."""
    return F.expr(f"marks & {bits([*facts, *but_none])}L = {bits(facts)}L")


def last_column(source: str, dam: str) -> str:
    return f"last_{source}_{dam.lower()}"


def _longs(values: Iterable[int]) -> Column:
    return F.expr("array(" + ", ".join(f"{v}L" for v in values) + ")")


def _marks(ord_: Column, dam_number: Column, source_number: Column) -> Column:
    """The bit mark of one telling detection: at a known site, or an adult return.

    No known site has the name of an adult ladder, so the patterns are looked at
    once, by the filter before, and antennas only where one can remove.
    """

    def mark(facts: Iterable[str]) -> int:
        return bits((fv.MAIN, fact) for fact in facts)

    sites, removals = [], []
    for n, _, _, dam in fv.SITES:
        below = [b for b, (first, last) in fv.BELOW_ORD.items() if first <= n <= last]
        sites.append(mark(below + ([f"at_{dam.lower()}"] if dam else [])))
        removals.append(mark([f"removed_{dam.lower()}"] if dam else []))
    adult = F.lit(mark(fv.BELOW_ORD)).cast("long")
    here = F.when(ord_.isNull(), adult).otherwise(F.element_at(_longs(sites), ord_))
    removed = F.when(
        (dam_number > 0) & on_removal_antenna(), F.element_at(_longs(removals), ord_)
    ).otherwise(0)
    shifts = _longs(1 << (i * len(FACTS)) for i in range(len(fv.SOURCES)))
    return here.bitwiseOR(removed) * F.element_at(shifts, source_number)


def number_in(column: str, names: Iterable[str]) -> Column:
    """Position of the value in the list, counted from 1; NULL when it is not there."""
    pairs = ", ".join(f"'{name}', {i}" for i, name in enumerate(names, start=1))
    return F.expr(f"try_element_at(map({pairs}), {column})")


def tag_features(detections: DataFrame) -> DataFrame:
    """One row per (tag_code, species_group): the OR of the marks and the last times.

    Detections that tell nothing are dropped before the shuffle; an unknown source and
    a NULL tag fail the job.
    """
    ord_, source_number = F.col("ord"), F.col("source_number")
    dam_numbers = ", ".join(str(fv.DAMS.index(dam) if dam else 0) for *_, dam in fv.SITES)
    dam_number = F.expr(f"coalesce(element_at(array({dam_numbers}), ord), 0)")
    last = [last_column(source, dam) for source, dam in LAST_OBS]
    rows = (
        detections.withColumns({"source": known_source(), "tag_code": required("tag_code")})
        .withColumns(
            {
                "ord": number_in("site_name", [name for _, _, name, _ in fv.SITES]),
                "source_number": number_in("source", fv.SOURCES),
            }
        )
        .filter(ord_.isNotNull() | adult_return())
        .withColumn("dam_number", dam_number)
        .withColumn("slot", source_number * 10 + F.col("dam_number"))
        .select(
            "species_group",
            "tag_code",
            _marks(ord_, F.col("dam_number"), source_number).alias("marks"),
            *[
                F.when(
                    F.col("slot") == (fv.SOURCES.index(source) + 1) * 10 + fv.DAMS.index(dam),
                    F.col("obs_time"),
                ).alias(last_column(source, dam))
                for source, dam in LAST_OBS
            ],
        )
    )
    return rows.groupBy("tag_code", "species_group").agg(
        F.bit_or("marks").alias("marks"), *[F.max(c).alias(c) for c in last]
    )


def required(column: str) -> Column:
    """The column, failing the job on the first NULL."""
    return F.coalesce(F.col(column), F.raise_error(F.lit(f"{column} must not be NULL")))


def known_source() -> Column:
    """The source column, failing the job on one that is not known."""
    named = F.when(F.col("source").isin(list(fv.SOURCES)), F.col("source"))
    said = F.concat(F.lit("unknown source: "), F.coalesce("source", F.lit("NULL")))
    return F.coalesce(named, F.raise_error(said))


def seen_at_releases() -> Column:
    """The tag was seen at a checkpoint in some release source."""
    return has_any((s, f"at_{d.lower()}") for s, d in LAST_OBS if s in fv.RELEASE_SOURCES)
