"""A corpus pipeline of five stages, from raw documents to packed token sequences.

Each stage takes (spark, docs, sf_dir), works on all that the one before kept, and returns the columns of documents; the last returns packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirwalk.llm.common import stored, table
from weirwalk.llm.mixing import mixed_documents
from weirwalk.llm.near_dedup import without_near_duplicates
from weirwalk.llm.packing import END_ID, TOKENIZER, best_fit_pack, token_pieces
from weirwalk.llm.secret_forest import redacted_secrets
from weirwalk.llm.suffix_repeats import repetition_rules

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules keep."""
    return repetition_rules(docs).filter("kept").select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, by shingles of five words and a similarity of 0.8 or more."""
    return without_near_duplicates(docs, words_each=5)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced in their texts."""
    return redacted_secrets(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: documents as often as their source is repeated, the last one cut; without words, none."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all texts, packed into sequences of 1024 tokens."""
    pieces = token_pieces(docs, public_tokenizers.path(TOKENIZER), END_ID)
    return best_fit_pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("source_mix", source_mix),
    ("packing", packing),
]

#: Stages such as components of near-duplicates and a trained forest are beyond SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
