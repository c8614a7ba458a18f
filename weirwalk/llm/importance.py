"""Resampling documents towards a target distribution, by hashed features and a distributed radix sort.

A document's features are its runs of words, hashed into buckets. A bucket's gain is the logarithm of how much more often the target has it
than the corpus; a document's weight is the sum of its features' gains, looked up in one array. Gumbel noise from a hash of the key makes
the highest scores a weighted draw without replacement, the same in every rerun.

Ranks come from a least-significant-digit radix sort over the composite key (score falling, key rising, nulls last). A pass is a stable
counting sort: rows lie in blocks of consecutive places; rows are counted by digit and block; sums over all smaller digits, and over earlier
blocks of the same digit, give each block's offset for each digit; a row's new place is the offset and its number among the block's rows with
its digit. Blocks bound what one task sorts, whatever the scores are, and each pass is written to the shared folder.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weirwalk.llm.common import stored, table

BUCKETS, LONGEST_RUN = 10_000, 1
FEWEST_WORDS, DRAWN_HUNDREDTHS, SEED = 20, 10, 2024
#: Bits of a digit, and places of a block.
DIGIT_BITS, BLOCK_ROWS = 12, 1 << 16
#: Words are runs of digits, letters a to z and all characters beyond ASCII, here as UTF-8 bytes, A to Z in lower case.
_WORD = re.compile(rb"[0-9a-z\x80-\xFF]+")


def feature_buckets(text: str | None, buckets: int = BUCKETS, longest: int = LONGEST_RUN) -> tuple[int, np.ndarray]:
    """The number of words, and the bucket of each run of 1 to `longest` words, repeats counted."""
    words = _WORD.findall((text or "").encode().lower())
    runs = list(words)
    for n in range(2, longest + 1):
        runs += [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
    hashes = np.fromiter(map(zlib.crc32, runs), np.uint32, len(runs))
    return len(words), (hashes % np.uint32(buckets)).astype(np.uint32)


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS, longest: int = LONGEST_RUN) -> np.ndarray:
    """How often each bucket occurs in all rows; a task hands on one sum for each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for value in batch.column(0):
                counts += np.bincount(feature_buckets(value.as_py(), buckets, longest)[1], minlength=buckets)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(buckets)), pa.array(counts)], names=["bucket", "n"])

    return _summed(docs.select(text).mapInArrow(count, "bucket bigint, n bigint"), buckets)


def _summed(partial: DataFrame, buckets: int) -> np.ndarray:
    counts = np.zeros(buckets, np.int64)
    for row in partial.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row["bucket"]] = row["n"]
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of (target share / corpus share), one added to each bucket, rounded down."""
    n, m = int(corpus.sum()) + len(corpus), int(target.sum()) + len(target)
    return np.array([math.floor(1000 * math.log((t + 1) * n / ((s + 1) * m))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def gumbel(key: int | None, seed: int = SEED) -> int:
    """Thousandths of a Gumbel variate from the key; a null key is an empty one."""
    h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored_documents(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", buckets: int = BUCKETS, longest: int = LONGEST_RUN, seed: int = SEED) -> DataFrame:
    """(row, key, n_words, n_features, weight, score) for every row of `docs`, stored; `row` is unique and any.

    Texts are cut into words once: buckets are stored as arrays, counted, and then looked up in the array of gains.
    """
    key_type = docs.schema[key].dataType.simpleString()
    narrow = np.uint16 if buckets <= 1 << 16 else np.uint32

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, len(batch), 512):
                part = batch.slice(first, 512)
                cuts = [feature_buckets(value.as_py(), buckets, longest) for value in part.column(1)]
                arrays = [pa.array([n for n, _ in cuts], pa.int64()), pa.array([x.astype(narrow).tobytes() for _, x in cuts], pa.binary())]
                yield pa.RecordBatch.from_arrays([part.column(0), *arrays], names=[key, "n_words", "buckets"])

    arrays = stored(docs.select(key, text).mapInArrow(cut, f"`{key}` {key_type}, n_words bigint, buckets binary").withColumn("row", F.monotonically_increasing_id()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for value in batch.column(0):
                counts += np.bincount(np.frombuffer(value.as_py(), narrow), minlength=buckets)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(buckets)), pa.array(counts)], names=["bucket", "n"])

    corpus = _summed(arrays.select("buckets").mapInArrow(count, "bucket bigint, n bigint"), buckets)
    # One number for each bucket, whatever the tables hold.
    gain = gains(corpus, bucket_counts(target, text, buckets, longest))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(value.as_py(), narrow) for value in batch.column("buckets")]
            weight = np.array([gain[x].sum() for x in found], np.int64)
            noise = np.array([gumbel(k, seed) for k in batch.column(key).to_pylist()], np.int64)
            columns = [batch.column("row"), batch.column(key), batch.column("n_words"), pa.array([len(x) for x in found], pa.int64()), pa.array(weight), pa.array(weight + noise)]
            yield pa.RecordBatch.from_arrays(columns, names=["row", key, "n_words", "n_features", "weight", "score"])

    made = f"row bigint, `{key}` {key_type}, n_words bigint, n_features bigint, weight bigint, score bigint"
    return stored(arrays.select("row", key, "n_words", "buckets").mapInArrow(score, made))


def radix_places(rows: DataFrame, parts: list[tuple[Column, int]], row: str = "row", block_rows: int = BLOCK_ROWS, digit_bits: int = DIGIT_BITS) -> DataFrame:
    """(row, place): places 0, 1, 2 ... by the composite key `parts`, most significant part first.

    A part is a column of whole numbers that are not negative, and how many bits they have at most. `row` is a unique number;
    rows with the same key stand in a fixed order that it decides.
    """
    keys = [F.coalesce(column, F.lit(0)).cast("long").alias(f"part{i}") for i, (column, _) in enumerate(parts)]
    digits = [(f"part{i}", shift) for i, (_, width) in reversed(list(enumerate(parts))) for shift in range(0, width, digit_bits)]
    names = [f"part{i}" for i in range(len(parts))]
    n_rows = rows.count()
    blocks = max(1, -(-n_rows // block_rows))
    # Before the first pass any order will do that a rerun repeats: blocks by hash, and rows by number in them.
    placed = rows.select(F.col(row).alias("row"), *keys, F.col(row).alias("place"), F.pmod(F.xxhash64(row), F.lit(blocks)).alias("block"))
    for name, shift in digits or [(names[-1], 0)]:
        cut = placed.withColumn("digit", F.shiftright(name, shift).bitwiseAND((1 << digit_bits) - 1).cast("int"))
        counts = cut.groupBy("digit", "block").agg(F.count("*").alias("n"))
        of_digit = counts.groupBy("digit").agg(F.sum("n").alias("n"))
        # A row for each digit, of which there are few.
        before = Window.orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
        of_digit = of_digit.select("digit", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("smaller"))
        earlier = Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        offsets = counts.withColumn("earlier", F.coalesce(F.sum("n").over(earlier), F.lit(0))).join(F.broadcast(of_digit), "digit")
        offsets = offsets.select("digit", "block", (F.col("smaller") + F.col("earlier")).alias("offset"))
        number = F.row_number().over(Window.partitionBy("block", "digit").orderBy("place")) - 1
        moved = cut.withColumn("number", number).join(offsets.hint("merge"), ["block", "digit"]).withColumn("place", F.col("offset") + F.col("number"))
        placed = stored(moved.select("row", *names, "place", F.expr(f"place div {block_rows}").alias("block")))
    return placed.select("row", "place")


def _width(least: int | None, most: int | None) -> int:
    return 0 if least is None or most is None else (most - least + 1).bit_length()


def importance_resampled(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", hundredths: int = DRAWN_HUNDREDTHS, fewest_words: int = FEWEST_WORDS, **features: int) -> DataFrame:
    """(key, n_features, weight, score, rank) for every row of `docs`; rank counts the drawn rows from 1 by falling score and is null for the others.

    Drawn are `hundredths` of 100 (rounded down) of the rows with `fewest_words` words or more. Ties go to the smaller key, null keys last; rows
    with the same key are documents of their own, in any but a fixed order. Null and empty texts have no features, weight 0 and are never
    drawn. An empty table gives an empty result, an empty target one feature share for all. `key` is a whole number; other columns are ignored.
    """
    scored = scored_documents(docs, target, key, text, **features)
    able = scored.filter(F.col("n_words") >= fewest_words)
    lowest, highest, first, last, n = able.agg(F.min("score"), F.max("score"), F.min(key), F.max(key), F.count("*")).first()
    drawn = n * hundredths // 100
    score_part = (F.lit(highest) - F.col("score"), _width(lowest, highest))
    # A null key is the one behind the last.
    key_part = (F.coalesce(F.col(key) - F.lit(first), F.lit(0 if last is None else last - first + 1)), _width(first, last) + 1)
    places = radix_places(able, [score_part, key_part]).filter(F.col("place") < drawn)
    ranks = places.select("row", (F.col("place") + 1).alias("rank"))
    return scored.join(ranks.hint("merge"), "row", "left").select(key, "n_features", "weight", "score", "rank")


def resampled_documents(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", **more: int) -> DataFrame:
    """The drawn rows of `docs`, all columns. Keys must be unique."""
    drawn = importance_resampled(docs, target, key, text, **more).filter("rank IS NOT NULL").select(key)
    return docs.join(drawn, key, "left_semi").select(docs.columns)


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resampled(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
