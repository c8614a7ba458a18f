"""Unions of sources: key sets, last detections, tagging facts, chained inserts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirwalk import fixed_values as fv
from weirwalk.functions.predicates import detected_below
from weirwalk.operators.aggregates import TAG
from weirwalk.operators.joins import anti_join


def union_keys(key_sets: list[DataFrame], on: tuple[str, ...] = TAG) -> DataFrame:
    """Distinct union of key sets."""
    return reduce(DataFrame.unionByName, [k.select(*on) for k in key_sets]).distinct()


def union_last_obs(parts: list[DataFrame], on: tuple[str, ...] = TAG) -> DataFrame:
    """Union of (key, last_obs) tables with one row per key: the latest."""
    rows = reduce(DataFrame.unionByName, [p.select(*on, "last_obs") for p in parts])
    return rows.groupBy(*on).agg(F.max("last_obs").alias("last_obs"))


def union_tagging(
    tagging: DataFrame, sources: tuple[str, ...], by: tuple[str, ...] = ("tag_code",)
) -> DataFrame:
    """Tagging facts over the sources with one row per key.

    A tag found in several sources takes the first source in the fixed order,
    then the lowest (release_date, run_name).
    """
    rank = F
    for i, source in enumerate(fv.SOURCES):
        rank = rank.when(F.col("source") == source, i)
    first = F.min(F.struct(rank.alias("rank"), "release_date", "run_name")).alias("first")
    rows = tagging.filter(F.col("source").isin(list(sources))).groupBy(*by).agg(first)
    return rows.select(*by, "first.run_name", "first.release_date")


def union_detected_below(
    detections: DataFrame, sources: tuple[str, ...], below: str, by: tuple[str, ...] = TAG
) -> DataFrame:
    """Tags seen in the below set in any of the sources: one filter, one distinct."""
    rows = detections.filter(F.col("source").isin(list(sources)) & detected_below(below))
    return rows.select(*by).distinct()


def chained_insert(
    state: DataFrame, key_sets: list[DataFrame], on: tuple[str, ...]
) -> DataFrame:
    """The keys a chain of guarded inserts adds to a table.

    Each insert of the chain skips what the earlier ones added. Only keys are
    inserted, so that is the distinct union without the keys already there.
    """
    return anti_join(union_keys(key_sets, on), state, on)
