"""Row predicates as Column builders over the logical tables."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from weirwalk import fixed_values as fv


def any_of(conditions: list[Column]) -> Column:
    """OR of a non-empty list of conditions."""
    return reduce(or_, conditions)


def at_sites(names: list[str]) -> Column:
    """Detected at one of the named sites."""
    if len(names) == 1:
        return F.col("site_name") == names[0]
    return F.col("site_name").isin(names)


def at_dam(dam: str) -> Column:
    """Detected at a reader of the checkpoint."""
    return at_sites(fv.dam_site_names(dam))


def on_removal_antenna() -> Column:
    """Detected on an antenna that takes the individual out of the river."""
    return any_of([F.col("antenna_group").ilike(f"%{word}%") for word in fv.REMOVAL_ANTENNAS])


def adult_return() -> Column:
    """Detected on an adult ladder in a year after the migration year."""
    ladder = any_of([F.col("site_name").ilike(f"%{word}%") for word in fv.ADULT_SITES])
    return ladder & (F.year("obs_time") > F.col("migration_year"))


def detected_below(below: str) -> Column:
    """Detected at a site of the below set, or back as an adult."""
    return at_sites(fv.below_site_names(below)) | adult_return()


def month_day(when: Column) -> Column:
    """Month and day as one number, 424 for 24 April."""
    return F.month(when) * 100 + F.dayofmonth(when)


def season_bounds(season: str) -> tuple[int, int]:
    """First and last day of a season as month-day numbers."""
    (first_month, first_day), (last_month, last_day) = fv.SEASONS[season]
    return first_month * 100 + first_day, last_month * 100 + last_day


def in_season(when: Column, season: str) -> Column:
    """The time falls on a month and day of the season, in any year."""
    return month_day(when).between(*season_bounds(season))


def has_age(age: str | None) -> Column:
    """Tagging row of the age class; no age class means every row."""
    return F.lit(True) if age is None else F.col("age") == age


def flags_are(at_dam: int | None = None, below: int | None = None) -> Column:
    """Passage flags equal the given values. A NULL flag equals nothing."""
    condition = F.lit(True)
    if at_dam is not None:
        condition = condition & (F.col("at_dam") == at_dam)
    if below is not None:
        condition = condition & (F.col("below") == below)
    return condition


def brand_new() -> Column:
    """None of the three flags has been set yet."""
    return F.col("upstream").isNull() & F.col("at_dam").isNull() & F.col("below").isNull()
