"""Rendezvous (highest random weight) sharding of keyed rows.

Every shard draws a score for every key, and the key goes to the shard with the best one. A new shard only draws scores of its own,
so it takes rows into itself and moves none between the others. A shard of weight w gets rows in proportion to w.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weirwalk.llm.common import groups_for, table, text_or_empty

SHARDS = 24
#: Rows of one shard that one group numbers together; more rows make more groups, never larger ones.
SLOT_GROUP_ROWS = 2048


def _score(key: Column, shard: int, weight: float) -> Column:
    """-w / ln(u) with u uniform in (0, 1), drawn from the key and the shard's number."""
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11).cast("double") + 0.5) * F.lit(2.0**-53)
    return F.lit(float(weight)) / -F.log(u)


def rendezvous_shard(key: Column, weights: Sequence[float]) -> Column:
    """The number of the key's shard among shards of the given weights (positive); equal scores go to the lower number.

    The shard depends on the key and the weights alone, so repeated keys meet in one shard; null keys share one shard too.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive, one for each shard")
    drawn = [F.struct(_score(key, i, w).alias("score"), F.lit(-i).alias("rank")) for i, w in enumerate(weights)]
    return (-F.array_max(F.array(*drawn))["rank"]).cast("int")


def with_slots(rows: DataFrame, shard: str, key: str, groups: Column, ties: Sequence[str] = (), slot: str = "slot") -> DataFrame:
    """Adds each row's place in its shard, gapless from 0.

    Rows of a shard are numbered in order of a hash of the key. Ranges of that hash split a shard into so many `groups`, which are
    numbered in separate tasks from the running count of the groups before; the numbers don't depend on how many groups there are.
    """
    hashed = rows.withColumn("__hash", F.xxhash64(F.col(key), F.lit("slot"))).withColumn(
        "__group", F.floor((F.shiftrightunsigned("__hash", 11).cast("double") * F.lit(2.0**-53)) * groups).cast("int")
    )
    before = Window.partitionBy(shard).orderBy("__group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        hashed.groupBy(shard, "__group").agg(F.count("*").alias("__n")).select(shard, "__group", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    )
    within = Window.partitionBy(shard, "__group").orderBy(F.shiftrightunsigned("__hash", 11), "__hash", key, *ties)
    return (
        hashed.withColumn("__row", F.row_number().over(within))
        .join(offsets, [shard, "__group"])
        .withColumn(slot, (F.col("__before") + F.col("__row") - 1).cast("long"))
        .drop("__hash", "__group", "__row", "__before")
    )


def shard_documents(docs: DataFrame, weights: Sequence[float], grown: Sequence[float] | None = None, key: str = "doc_id") -> DataFrame:
    """All columns of `docs` with shard, slot and grown_shard (the shard under the weights `grown`, null without them).

    Null keys share a shard; repeated rows get one slot each; an empty table gives an empty result. Columns named shard, slot or
    grown_shard in `docs` are replaced.
    """
    clean = docs.drop("shard", "slot", "grown_shard")
    placed = clean.withColumn("shard", rendezvous_shard(F.col(key), weights)).withColumn(
        "grown_shard", rendezvous_shard(F.col(key), grown) if grown else F.lit(None).cast("int")
    )
    others = [c for c, kind in clean.dtypes if c != key and not kind.startswith(("map", "variant"))]
    groups = groups_for(clean.count(), SLOT_GROUP_ROWS * len(weights))
    return with_slots(placed, "shard", key, F.lit(groups), ties=[f"`{c}`" for c in others])


def op5_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = text_or_empty(F.col("text"))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    shards = shard_documents(docs, [1.0] * SHARDS, [1.0] * (SHARDS + 1))
    return shards.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
