"""What the operators share: tables, intermediate results in the shared folder, words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirwalk.sources.folders import scratch_dir

#: A word is a run without ASCII white space; bytes.split() cuts at the same places.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession) -> str:
    """A fresh folder under spark.checkpoint.dir, which all executors share; where that is unset, a local session has its own, and a cluster fails."""
    return scratch_dir(spark)


def stored(df: DataFrame, path: str | None = None) -> DataFrame:
    """The rows written as Parquet in the shared folder and read again: later jobs don't repeat the work, and it survives lost executors."""
    spark = df.sparkSession
    path = path or work_dir(spark)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def groups_for(rows: int, per_group: int) -> int:
    """How many hash groups keep each near per_group rows."""
    return max(1, -(-rows // per_group))


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def n_words(text: Column) -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
