"""Grouped maxima and key sets. All of them combine on the map side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirwalk.functions.predicates import at_sites, in_season

# The tag comes first: sorts compare its leading bytes before anything else.
TAG = ("tag_code", "species_group")
SOURCE_TAG = ("tag_code", "species_group", "source")


def last_obs(detections: DataFrame, sites: list[str], by: tuple[str, ...] = TAG) -> DataFrame:
    """Last detection per key at the given sites."""
    return detections.filter(at_sites(sites)).groupBy(*by).agg(F.max("obs_time").alias("last_obs"))


def last_obs_in_season(
    detections: DataFrame, sites: list[str], season: str, by: tuple[str, ...] = TAG
) -> DataFrame:
    """Last detection per key, kept when it falls in the season.

    The season is tested after the maximum: an earlier detection in season does
    not count when the last one is outside.
    """
    return last_obs(detections, sites, by).filter(in_season(F.col("last_obs"), season))


def distinct_tags(rows: DataFrame, by: tuple[str, ...] = TAG) -> DataFrame:
    """The key set of a table."""
    return rows.select(*by).distinct()


def last_obs_by_source(detections: DataFrame, sites: list[str]) -> DataFrame:
    """Last detection per source and tag at the given sites."""
    return last_obs(detections, sites, SOURCE_TAG)
