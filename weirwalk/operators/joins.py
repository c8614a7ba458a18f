"""Semi- and anti-joins on the tag.

Anti-joins are plain LEFT ANTI on keys that ingest has checked for NULL, so a
large right side becomes a sort-merge join rather than the broadcast a NOT IN
needs. Tests of one tag against its own other detections are one grouped pass,
not a self-join: the group leaves each map task as one row, whatever its size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirwalk.functions.predicates import at_dam, has_age, on_removal_antenna
from weirwalk.operators.aggregates import SOURCE_TAG, TAG


def semi_join(rows: DataFrame, keys: DataFrame, on: tuple[str, ...] = TAG) -> DataFrame:
    """Rows whose key is in the key table.

    Keeps rows as they are. To go on to one row per key, group first and join the
    groups: a key with very many rows is then one row at the join.
    """
    return rows.join(keys.select(*on), list(on), "left_semi")


def anti_join(rows: DataFrame, keys: DataFrame, on: tuple[str, ...] = TAG) -> DataFrame:
    """Rows whose key is not in the key table."""
    return rows.join(keys.select(*on), list(on), "left_anti")


def _tags_where(
    detections: DataFrame, ever: Column, never: Column | None, by: tuple[str, ...]
) -> DataFrame:
    if never is None:
        return detections.filter(ever).select(*by).distinct()
    told = detections.filter(ever | never).groupBy(*by)
    told = told.agg(F.bool_or(ever).alias("ever"), F.bool_or(never).alias("never"))
    return told.filter(F.col("ever") & ~F.coalesce("never", F.lit(False))).select(*by)


def detected_at(detections: DataFrame, dam: str, by: tuple[str, ...] = SOURCE_TAG) -> DataFrame:
    """Tags detected at the checkpoint."""
    return _tags_where(detections, at_dam(dam), None, by)


def detected_at_never_at(
    detections: DataFrame, dam: str, skipped: str, by: tuple[str, ...] = SOURCE_TAG
) -> DataFrame:
    """Tags detected at one checkpoint and never at another."""
    return _tags_where(detections, at_dam(dam), at_dam(skipped), by)


def detected_never_removed(
    detections: DataFrame, dam: str, by: tuple[str, ...] = SOURCE_TAG
) -> DataFrame:
    """Tags detected at the checkpoint and never on a removal antenna there."""
    return _tags_where(detections, at_dam(dam), at_dam(dam) & on_removal_antenna(), by)


def in_any_not_in(
    keys: DataFrame, members: list[DataFrame], excluded: DataFrame, on: tuple[str, ...]
) -> DataFrame:
    """Keys found in at least one member table and not in the excluded table.

    The member tables are one union of keys, so the test is one semi-join.
    """
    known = members[0].select(*on)
    for member in members[1:]:
        known = known.unionByName(member.select(*on))
    return anti_join(semi_join(keys, known, on), excluded, on)


def of_age(rows: DataFrame, tagging: DataFrame, age: str | None) -> DataFrame:
    """Rows of release sources whose tag was tagged at the age class in the same source."""
    if age is None:
        return rows
    return semi_join(rows, tagging.filter(has_age(age)), SOURCE_TAG)
