"""Passage-table updates as table-to-table transforms.

A passage table is a row per (basin, run, tag_code) with the columns of
``schema.PASSAGE``. Merges are left joins: rows without a match keep their
values. Each merge first makes its source unique per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirwalk.functions.predicates import brand_new
from weirwalk.operators.joins import anti_join

KEY = ("basin", "run", "tag_code")


def append_missing(
    state: DataFrame, keys: DataFrame, dam: str, on: tuple[str, ...] = KEY
) -> DataFrame:
    """Add a row for each key the checkpoint's table does not hold.

    New rows carry the checkpoint; all their other columns are NULL. Rows of other
    checkpoints stay as they are and count for nothing.
    """
    held = state.filter(F.col("dam") == dam)
    new = anti_join(keys.select(*on).distinct(), held, on).withColumn("dam", F.lit(dam))
    return state.unionByName(new, allowMissingColumns=True)


def set_upstream(state: DataFrame) -> DataFrame:
    """Mark every row as present upstream."""
    return state.withColumn("upstream", F.lit(1))


def fill_null(state: DataFrame, column: str, value: Column) -> DataFrame:
    """Set a column where it is NULL."""
    return state.withColumn(column, F.coalesce(F.col(column), value))


def removed_clears_below(state: DataFrame) -> DataFrame:
    """An individual removed at the checkpoint is not counted below it."""
    return state.withColumn(
        "below", F.when(F.col("at_dam") == 2, 0).otherwise(F.col("below"))
    )


def set_history_101(state: DataFrame) -> DataFrame:
    """Rows with none of the flags set become 1-0-1, judged on the row as it was."""
    return state.withColumns(
        {
            "upstream": F.when(brand_new(), 1).otherwise(F.col("upstream")),
            "at_dam": F.when(brand_new(), 0).otherwise(F.col("at_dam")),
            "below": F.when(brand_new(), 1).otherwise(F.col("below")),
        }
    )


def merge_flag(
    state: DataFrame, keys: DataFrame, column: str, value: int, on: tuple[str, ...] = KEY
) -> DataFrame:
    """Set a flag on the rows whose key is in the key set."""
    hits = keys.select(*on).distinct().withColumn("hit", F.lit(True))
    merged = state.join(hits, list(on), "left")
    return merged.withColumn(
        column, F.when(F.col("hit"), value).otherwise(F.col(column))
    ).select(*state.columns)


def merge_pass_date(
    state: DataFrame, last_obs: DataFrame, on: tuple[str, ...] = KEY
) -> DataFrame:
    """Copy the last detection to the rows it matches."""
    source = last_obs.groupBy(*on).agg(
        F.max("last_obs").alias("last_obs"), F.lit(True).alias("hit")
    )
    merged = state.join(source, list(on), "left")
    return merged.withColumn(
        "pass_date", F.when(F.col("hit"), F.col("last_obs")).otherwise(F.col("pass_date"))
    ).select(*state.columns)


def merge_release_facts(
    state: DataFrame, facts: DataFrame, on: tuple[str, ...] = ("tag_code",)
) -> DataFrame:
    """Copy run and release date from tagging facts, one row per key.

    A match overwrites both columns, also with NULL.
    """
    source = facts.select(
        *on,
        F.col("run_name"),
        F.col("release_date").alias("facts_release_date"),
        F.lit(True).alias("hit"),
    )
    merged = state.join(source, list(on), "left")
    return merged.withColumns(
        {
            "run_type": F.when(F.col("hit"), F.col("run_name")).otherwise(F.col("run_type")),
            "release_date": F.when(F.col("hit"), F.col("facts_release_date")).otherwise(
                F.col("release_date")
            ),
        }
    ).select(*state.columns)


def at_dam_code(
    state: DataFrame, detected: DataFrame, removed: DataFrame, on: tuple[str, ...] = KEY
) -> DataFrame:
    """Set at_dam to 2 for removed keys, else to 1 for detected keys.

    Both key sets meet the table in one join; removal wins.
    """
    codes = (
        detected.select(*on, F.lit(1).alias("code"))
        .unionByName(removed.select(*on, F.lit(2).alias("code")))
        .groupBy(*on)
        .agg(F.max("code").alias("code"))
    )
    merged = state.join(codes, list(on), "left")
    return merged.withColumn(
        "at_dam", F.coalesce(F.col("code"), F.col("at_dam"))
    ).select(*state.columns)
