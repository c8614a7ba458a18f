"""A quality classifier by nearest-neighbour voting in a latent semantic space.

1. A text's terms are its words, the shapes of its words (letters and digits as classes, other characters kept), runs of three words that
   stood before, words said twice, and its length class; each is hashed to one of 4096 features, weighted by log(1 + count) and by how few of
   all documents have it. Document frequencies cover every document.
2. A sample of labelled documents, at most `SAMPLE_ROWS` and chosen by a hash of their ids, spans the space: a truncated singular value
   decomposition of their feature vectors. Their latent vectors and labels, bounded by that number, are broadcast.
3. Every document is projected, its exact cosines with all labelled vectors are computed in blocks (double precision), and the nearest vote for
   their labels, weighted by similarity. Of labelled documents that are equally near, those with smaller ids vote.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, StructField, StructType

from weirwalk.llm.common import stored, table

FEATURES, DIMENSIONS, NEIGHBOURS = 4096, 48, 25
#: The most labelled rows that the classifier is fitted on.
SAMPLE_ROWS = 8192
ACCEPTED_FROM = 0.3
_BLOCK = 256
#: Cosines are equal if they agree to so many decimals; a block's products may differ in the last bits.
_DECIMALS = 12
_CLASSES = [(re.compile(rb"[a-z\x80-\xff]+"), b"a"), (re.compile(rb"[A-Z]+"), b"A"), (re.compile(rb"[0-9]+"), b"0")]


def _word_features(word: bytes) -> tuple[int, int]:
    shape = word
    for pattern, letter in _CLASSES:
        shape = pattern.sub(letter, shape)
    return zlib.crc32(word.lower()) % FEATURES, zlib.crc32(b"shape " + shape) % FEATURES


#: Only words of ordinary length are remembered, which bounds the memory of a task.
_REMEMBERED_BYTES = 64
_remembered = lru_cache(maxsize=100_000)(_word_features)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """A text's features in order, and their counts."""
    words = (text or "").encode().split()
    counts: Counter[int] = Counter()
    for word, n in Counter(words).items():
        content, shape = _remembered(word) if len(word) <= _REMEMBERED_BYTES else _word_features(word)
        counts[content] += n
        counts[shape] += n
    runs = len(words) - 2
    again = runs - len(set(zip(words, words[1:], words[2:], strict=False))) if runs > 0 else 0
    if again:
        counts[zlib.crc32(b"again") % FEATURES] += again
        counts[zlib.crc32(b"again share %d" % (10 * again // runs)) % FEATURES] += runs
    doubled = sum(map(bytes.__eq__, words, words[1:]))
    if doubled:
        counts[zlib.crc32(b"doubled share %d" % (10 * doubled // len(words))) % FEATURES] += len(words)
    counts[zlib.crc32(b"length %d" % len(words).bit_length()) % FEATURES] += 1
    at = np.array(sorted(counts), np.int64)
    return at, np.array([counts[i] for i in at.tolist()], np.float64)


def featured(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with features and counts (packed 16-bit and 32-bit numbers) in place of the text, written once: every later step reads these and no text.

    Columns named features or counts are replaced.
    """
    clean = docs.drop("features", "counts")
    others = [c for c in clean.columns if c != text]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(value.as_py()) for value in batch.column(len(others))]
            at = pa.array([x.astype("<u2").tobytes() for x, _ in found], pa.binary())
            counts = pa.array([_planes(n) for _, n in found], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], at, counts], names=[*others, "features", "counts"])

    schema = StructType([clean.schema[c] for c in others] + [StructField("features", BinaryType()), StructField("counts", BinaryType())])
    return stored(clean.select(*others, text).mapInArrow(make, schema))


def _planes(counts: np.ndarray) -> bytes:
    """Counts byte by byte: their high bytes, mostly 0, lie together and compress well."""
    return counts.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpacked(at: pa.Scalar, counts: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(counts.as_py(), np.uint8).reshape(4, -1)
    return np.frombuffer(at.as_py(), "<u2"), np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.float64)


def document_frequencies(rows: DataFrame) -> np.ndarray:
    """How many of all featured rows have each feature; the last number is that of rows. Tasks send one row per feature at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(FEATURES + 1, np.int64)
        for batch in batches:
            found[:FEATURES] += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u2"), minlength=FEATURES)
            found[FEATURES] += len(batch)
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(found[at])], names=["feature", "n"])

    counted = rows.select("features").mapInArrow(count, "feature bigint, n bigint").groupBy("feature").agg(F.sum("n").alias("n"))
    out = np.zeros(FEATURES + 1, np.int64)
    for row in counted.collect():
        out[row["feature"]] = row["n"]
    return out


class Neighbours(NamedTuple):
    """How rare each feature is, the axes of the space, and the labelled documents' vectors and labels by ascending id."""

    rarity: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def scores(self, rows: list[tuple[np.ndarray, np.ndarray]], neighbours: int = NEIGHBOURS) -> np.ndarray:
        """The labels' mean over the nearest, weighted by cosine; the sample's mean if there is nothing to weigh."""
        if not len(self.labels):
            return np.full(len(rows), 0.5)
        # Blocks of one size, whatever the batch: a row's products don't depend on the rows beside it.
        block = np.zeros((-(-len(rows) // _BLOCK) * _BLOCK, self.axes.shape[1]))
        block[: len(rows)] = projected(rows, self.rarity, self.axes)
        cosines = np.round(block @ self.vectors.T, _DECIMALS)[: len(rows)]
        nearest = _nearest(cosines, min(neighbours, len(self.labels)))
        weights = np.maximum(np.take_along_axis(cosines, nearest, axis=1), 0) ** 4
        total = weights.sum(axis=1)
        votes = (weights * self.labels[nearest]).sum(axis=1)
        return np.clip(np.where(total > 0, votes / np.maximum(total, 1e-300), self.labels.mean()), 0, 1)


def projected(rows: list[tuple[np.ndarray, np.ndarray]], rarity: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Latent vectors of unit length of rows of features; zero for one that shares no direction with the sample."""
    out = np.zeros((len(rows), axes.shape[1]))
    for i, (at, counts) in enumerate(rows):
        out[i] = (np.log1p(counts) * rarity[at]) @ axes[at]
    return _unit(out)


def _nearest(cosines: np.ndarray, k: int) -> np.ndarray:
    """The places of each row's k largest cosines, ascending; of equal ones the first."""
    found = np.argpartition(cosines, cosines.shape[1] - k, axis=1)[:, -k:]
    values = np.take_along_axis(cosines, found, axis=1)
    least = values.min(axis=1, keepdims=True)
    # Where more are equal to the last one than there is room for, argpartition may have taken any of them.
    for i in np.flatnonzero((cosines == least).sum(axis=1) > (values == least).sum(axis=1)):
        above = np.flatnonzero(cosines[i] > least[i])
        found[i] = np.append(above, np.flatnonzero(cosines[i] == least[i])[: k - len(above)])
    return np.sort(found, axis=1)


def _unit(rows: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)


def fit(rows: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, dimensions: int = DIMENSIONS, key: str = "doc_id") -> Neighbours:
    """`rows` are featured documents; `labels` has `key` and label (0 or 1) of those to learn from.

    Labels with nulls are left out. An id counts once: with its highest label, and with the least of its rows' packed features if several rows have it.
    """
    known = document_frequencies(rows)
    rarity = np.log((1.0 + known[FEATURES]) / (1.0 + known[:FEATURES]))
    usable = labels.select(key, F.col("label").cast("double").alias("label")).dropna().groupBy(key).agg(F.max("label").alias("label"))
    chosen = usable.orderBy(F.xxhash64(key), key).limit(sample_rows)
    # At most sample_rows rows of 16 bytes.
    labelled = rows.select(key, "features", "counts").join(F.broadcast(chosen), key)
    one_each = labelled.groupBy(key, "label").agg(F.min(F.struct("features", "counts")).alias("row")).select(key, "label", "row.*")
    sample = one_each.toArrow().sort_by(key)
    found = list(map(_unpacked, sample["features"], sample["counts"]))
    matrix = np.zeros((len(found), FEATURES), np.float32)
    for i, (at, counts) in enumerate(found):
        matrix[i, at] = np.log1p(counts) * rarity[at]
    axes = _right_axes(_unit(matrix), dimensions).astype(np.float64)
    return Neighbours(rarity, axes, projected(found, rarity, axes), sample["label"].to_numpy().astype(np.float64))


def _right_axes(matrix: np.ndarray, dimensions: int) -> np.ndarray:
    """The leading right singular vectors, by subspace iteration from fixed random directions."""
    if not len(matrix):
        return np.zeros((matrix.shape[1], 1), np.float32)
    axes = np.random.default_rng(11).standard_normal((matrix.shape[1], min(dimensions + 8, *matrix.shape))).astype(np.float32)
    for _ in range(6):
        axes, _ = np.linalg.qr(matrix.T @ (matrix @ axes))
    _, _, turned = np.linalg.svd(matrix @ axes, full_matrices=False)
    return (axes @ turned.T)[:, :dimensions].astype(np.float32)


def score_documents(rows: DataFrame, model: Neighbours) -> DataFrame:
    """Featured documents with score, the probability of label 1 by the neighbours' vote, in place of their features.

    Whole texts, whatever their length. A null or empty text has its length class alone. Repeated rows get the same score; an empty table gives an
    empty result. Without labelled rows every score is 0.5. A column named score is replaced.
    """
    others = [c for c in rows.columns if c not in ("features", "counts", "score")]
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, len(batch), _BLOCK):
                part = batch.slice(first, _BLOCK)
                scores = shared.value.scores(list(map(_unpacked, part.column(len(others)), part.column(len(others) + 1))))
                yield pa.RecordBatch.from_arrays([*part.columns[:-2], pa.array(scores)], names=[*others, "score"])

    schema = StructType([*(rows.schema[c] for c in others), StructField("score", DoubleType())])
    return rows.select(*others, "features", "counts").mapInArrow(score, schema)


def op3_quality_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    rows = featured(table(spark, sf_dir, "documents").select("doc_id", "text"))
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = fit(rows, labels.filter(~held_out).select("doc_id", F.col("quality").alias("label")))
    scored = score_documents(rows, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= ACCEPTED_FROM).cast("int").alias("predicted"))
