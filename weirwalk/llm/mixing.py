"""Mixing sources to target weights, with exact budgets and whole repeats.

Each source gets a target in words. Its documents stand in the order of a hash of their ids (a random order that a rerun repeats), the
words before each one are a distributed prefix sum, and the source is cut at the exact word where its target is reached. A target above
the source's size takes whole passes over the source first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weirwalk.llm.common import groups_for, n_words, table

#: Weights by the sources' order, again and again.
WEIGHTS = (1.0, 2.0, 3.0)
MOST_PASSES = 3
#: Rows of one source that one group sums together; more rows make more groups.
GROUP_ROWS = 4096
_WHITE, _BLACK = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"


def _cycled(index: Column, weights: tuple[float, ...]) -> Column:
    return F.element_at(F.array(*map(F.lit, weights)), (F.pmod(index, F.lit(len(weights))) + 1).cast("int"))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most_passes: int = MOST_PASSES) -> DataFrame:
    """(source, source_size) with one row per source → the same with target.

    Targets share the sum of all sizes by weight; none is above `most_passes` times its source's size, and what is cut off is shared
    among the others. That is one water level: target = least(most, level * weight). Sources stand in code point order, null last, and
    the k-th has the k-th weight, repeating. The windows here run over one row per source, not over documents.
    """
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    listed = sizes.withColumn("weight", _cycled(F.row_number().over(everything) - 1, weights)).withColumn(
        "most", F.col("source_size") * F.lit(float(most_passes))
    )
    filling = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before, whole = filling.rowsBetween(Window.unboundedPreceding, -1), filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = listed.select(
        "*",
        F.sum("source_size").over(whole).cast("double").alias("total"),
        F.coalesce(F.sum("most").over(before), F.lit(0.0)).alias("full"),
        (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("open"),
    ).withColumn("level", (F.col("total") - F.col("full")) / F.col("open"))
    level = F.max(F.when(F.col("level") * F.col("weight") <= F.col("most"), F.col("level"))).over(whole)
    return filled.select("source", "source_size", F.least("most", F.coalesce(level, F.col("most") / F.col("weight")) * F.col("weight")).alias("target"))


def mix_sources(docs: DataFrame, size: Column, weights: tuple[float, ...] = WEIGHTS, most_passes: int = MOST_PASSES, key: str = "doc_id") -> DataFrame:
    """All columns of `docs` (needs `key` and `source`) with size, source_size, target, passes, taken and cut.

    taken is what the mix takes of a document: `passes` whole repeats, and `cut` words more (its whole size, or less in the one document
    where the source's target is reached). Null sources form a source of their own; sizes are 0 or more; a repeated row is a document
    of its own; an empty table gives an empty result. Columns with these names in `docs` are replaced.
    """
    made = ("size", "source_size", "target", "passes", "taken", "cut")
    rows = docs.drop(*made).withColumn("size", size)
    n_rows = docs.count()
    digits = 1
    while 16**digits < groups_for(n_rows, GROUP_ROWS):
        digits += 1
    keyed = rows.withColumn("__key", F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))).withColumn("__group", F.substring("__key", 1, digits))

    groups = keyed.groupBy("source", "__group").agg(F.sum("size").alias("__size"))
    targets = source_targets(groups.groupBy("source").agg(F.sum("__size").alias("source_size")), weights, most_passes)
    budget, words = F.floor("target").cast("long"), F.greatest(F.col("source_size"), F.lit(1))
    plan = targets.withColumn("passes", F.floor(budget / words)).withColumn("__rest", budget - F.col("passes") * F.col("source_size"))
    offsets = groups.withColumn(
        "__before", F.coalesce(F.sum("__size").over(Window.partitionBy("source").orderBy("__group").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    offsets, plan = offsets.select(F.col("source").alias("__s"), F.col("__group").alias("__g"), "__before"), plan.withColumnRenamed("source", "__t")
    steps = offsets.join(plan, F.col("__s").eqNullSafe(F.col("__t"))).drop("__t")

    within = Window.partitionBy("source", "__group").orderBy("__key", key, "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.withColumn("__within", F.coalesce(F.sum("size").over(within), F.lit(0)))
    joined = placed.join(steps, F.col("source").eqNullSafe(F.col("__s")) & (F.col("__group") == F.col("__g")))
    cut = F.least(F.col("size"), F.greatest(F.lit(0), F.col("__rest") - F.col("__before") - F.col("__within"))).cast("long")
    return (
        joined.withColumn("cut", cut)
        .withColumn("taken", (F.col("passes") * F.col("size") + F.col("cut")).cast("long"))
        .select(*rows.columns, "source_size", "target", "passes", "cut", "taken")
    )


def first_words(text: Column, n: Column) -> Column:
    """A text up to the end of its n-th word, white space kept."""
    return F.array_join(F.slice(F.split(text, f"(?<={_BLACK})(?={_WHITE})"), F.lit(1), n.cast("int")), "")


def mixed_documents(docs: DataFrame, text: str = "text", **options: object) -> DataFrame:
    """The mix itself, with the columns of `docs`: a row for each whole repeat of a document, and one for its cut part.

    The cut part keeps the document's id; n_chars, if there is one, follows its text. Documents without words are in no mix.
    """
    mixed = mix_sources(docs, n_words(F.col(text)), **options)
    copies = F.concat(F.array_repeat(F.col("size"), F.col("passes").cast("int")), F.when(F.col("cut") > 0, F.array("cut")).otherwise(F.array()))
    out = mixed.filter("size > 0").withColumn("__words", F.explode(copies))
    whole = F.col("__words") == F.col("size")
    out = out.withColumn(text, F.when(whole, F.col(text)).otherwise(first_words(F.col(text), F.col("__words"))))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(whole, F.col("n_chars")).otherwise(F.char_length(text)).cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", n_words(F.col("text")).alias("words"))
    return mix_sources(docs, F.col("words")).select("doc_id", "size", "source_size", "target", "taken")


OP9_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents
), by_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM sized GROUP BY source
), filled AS (
  SELECT *, 3.0 * source_size AS most, CAST(sum(source_size) OVER () AS DOUBLE) AS total,
         coalesce(sum(3.0 * source_size) OVER before, 0) AS full_before, sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS open_weight
  FROM by_source
  WINDOW before AS (ORDER BY 3.0 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), water AS (
  SELECT *, max(CASE WHEN (total - full_before) / open_weight * weight <= most THEN CAST((total - full_before) AS DOUBLE) / open_weight END) OVER () AS level
  FROM filled
), targets AS (
  SELECT source, source_size, CAST(least(most, level * weight) AS DOUBLE) AS target FROM water
), running AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         CAST(floor(t.target) AS BIGINT) // greatest(t.source_size, 1) AS passes,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY md5(CAST(s.doc_id AS VARCHAR)), s.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS words_before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(passes * size + least(size, greatest(0, CAST(floor(target) AS BIGINT) - passes * source_size - words_before)) AS BIGINT) AS taken
FROM running
"""
