"""Approximate nearest neighbours by a forest of random-projection trees.

1. Equal vectors are one point; a point keeps its smallest ids, enough to fill any answer.
2. Trees are grown on a sample of points, bounded by a parameter: each node halves its points by their projections on the difference of two of them.
   The number of leaves grows with the number of points, as long as the sample fills them. Trees are broadcast; that is what the sample bounds.
3. Every point goes down every tree to its leaf.
4. A query searches all trees through one priority queue, ordered by the worst margin on the way to a node: it takes leaf after leaf, from
   whichever tree is nearest, until the leaves that it has hold enough points by their true counts over all data. How many are enough is measured: for
   a few queries the true neighbours are found by brute force in blocks, and the search must go far enough for the share `RECALL` of them.
5. Points and queries of a leaf meet in groups of bounded size, where all distances are computed exactly, in double precision, on the original
   vectors; the nearest of each group go on, and the nearest of those are the answer.

Vectors without clusters need a large share of all leaves for a high recall; the measured depth grows and shrinks with the data.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weirwalk.llm.common import stored, table

TREES, NEAREST = 8, 10
#: The most points that trees are grown on, and the points of all data that a leaf should hold.
SAMPLE_POINTS, LEAF_POINTS = 16384, 256
#: Queries whose true neighbours say how far to search, and the share of these neighbours that must be reached.
MEASURED_QUERIES, RECALL = 64, 0.97
#: The most points, and the most queries, of one leaf that one group compares.
GROUP_POINTS, GROUP_QUERIES = 4096, 4096
EVERY = 100


class Tree(NamedTuple):
    """Inner node i splits by normals[i] and cuts[i]; its children are nodes left[i] and right[i], leaf k is written as -1 - k."""

    normals: np.ndarray
    cuts: np.ndarray
    left: np.ndarray
    right: np.ndarray
    leaves: int

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), np.int64)
        waiting = [(0, np.arange(len(points)))] if len(self.cuts) else []
        while waiting:
            node, rows = waiting.pop()
            up = points[rows] @ self.normals[node] > self.cuts[node]
            for child, part in ((self.left[node], rows[~up]), (self.right[node], rows[up])):
                if child < 0:
                    out[part] = -1 - child
                elif len(part):
                    waiting.append((child, part))
        return out


def grow(points: np.ndarray, leaf_points: int, seed: int) -> Tree:
    rng = np.random.default_rng(seed)
    normals, cuts, left, right, leaves = [], [], [], [], 0

    def node(rows: np.ndarray) -> int:
        nonlocal leaves
        if len(rows) > leaf_points:
            for _ in range(3):
                a, b = points[rng.choice(rows, 2, replace=False)]
                normal = a - b
                length = np.linalg.norm(normal)
                at = points[rows] @ (normal / length) if length > 0 else None
                if at is not None and at.min() < (cut := float(np.median(at))) < at.max():
                    place = len(cuts)
                    normals.append(normal / length)
                    cuts.append(cut)
                    left.append(0)
                    right.append(0)
                    left[place], right[place] = node(rows[at <= cut]), node(rows[at > cut])
                    return place
        leaves += 1
        return -leaves

    root = node(np.arange(len(points)))
    if root < 0:
        return Tree(np.empty((0, points.shape[1])), np.empty(0), np.empty(0, np.int64), np.empty(0, np.int64), 1)
    return Tree(np.array(normals), np.array(cuts), np.array(left), np.array(right), leaves)


def search(trees: list[Tree], held: list[np.ndarray], query: np.ndarray, searched: int) -> list[tuple[int, int]]:
    """(tree, leaf) in the order of one priority queue over all trees, until the leaves hold `searched` points."""
    queue = [(0.0, t, 0 if len(tree.cuts) else -1) for t, tree in enumerate(trees)]
    margins = [tree.normals @ query - tree.cuts for tree in trees]
    heapq.heapify(queue)
    out, points = [], 0
    while queue and points < searched:
        worst, t, node = heapq.heappop(queue)
        if node < 0:
            out.append((t, -1 - node))
            points += int(held[t][-1 - node])
            continue
        margin = float(margins[t][node])
        near, far = (trees[t].right[node], trees[t].left[node]) if margin > 0 else (trees[t].left[node], trees[t].right[node])
        heapq.heappush(queue, (worst, t, int(near)))
        heapq.heappush(queue, (max(worst, abs(margin)), t, int(far)))
    return out


def _usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vector) as doubles; vectors that are null, empty or zero or hold null or non-finite components take no part, nor do null ids."""
    values = F.col(vector).cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(key).cast("long").alias("id"), values.alias("vector")).filter(F.col(key).isNotNull() & finite)
    return rows.filter(F.exists("vector", lambda x: x != 0))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.stack(column.to_numpy(zero_copy_only=False)).astype(np.float64)


def _distances(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact, from differences, a few queries at a time."""
    step = max(1, (1 << 22) // max(1, points.size))
    return np.concatenate([np.sqrt(((queries[i : i + step, None, :] - points[None]) ** 2).sum(axis=2)) for i in range(0, len(queries), step)])


def _nearest_rows(apart: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, point) positions of the k nearest points of each query, ties to the smaller id."""
    by_id = np.argsort(ids, kind="stable")
    at = by_id[np.argsort(apart[:, by_id], axis=1, kind="stable")[:, :k]]
    return np.repeat(np.arange(len(at)), at.shape[1]), at.ravel()


def _depth(points: DataFrame, asked: DataFrame, forest: list[Tree], held: list[np.ndarray], k: int) -> int:
    """How many points a search must go through to reach the share RECALL of true neighbours of some queries."""
    some = asked.orderBy(F.xxhash64("id"), "id").limit(MEASURED_QUERIES).toPandas()
    vectors = np.stack(some["vector"].to_numpy()).astype(np.float64)
    shared = points.sparkSession.sparkContext.broadcast(vectors)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                apart = _distances(shared.value, _matrix(batch.column(1)))
                query, at = _nearest_rows(apart, batch.column(0).to_numpy(), k + 1)
                columns = [pa.array(query), batch.column(0).take(pa.array(at)), pa.array(apart[query, at]), batch.column(1).take(pa.array(at))]
                yield pa.RecordBatch.from_arrays(columns, names=["query", "point", "score", "vector"])

    near = points.select("point", "vector").mapInArrow(nearest, "query bigint, point bigint, score double, vector array<double>")
    best = near.withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy("score", "point"))).filter(F.col("n") <= k + 1).toPandas()
    true = np.stack(best["vector"].to_numpy()).astype(np.float64)
    leaves = np.stack([tree.leaf_of(true) for tree in forest])
    needed = np.empty(len(best))
    for query, rows in best.groupby("query").indices.items():
        order = np.array(search(forest, held, vectors[query], np.iinfo(np.int64).max))
        passed = np.cumsum([held[t][leaf] for t, leaf in order])
        reached = {(t, leaf): n for (t, leaf), n in zip(map(tuple, order.tolist()), passed.tolist(), strict=True)}
        for row in rows:
            needed[row] = min(reached[t, int(leaf)] for t, leaf in enumerate(leaves[:, row]))
    return int(np.quantile(needed[best["score"] > 0] if (best["score"] > 0).any() else needed, RECALL, method="higher"))


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, k: int = NEAREST, key: str = "vec_id", vector: str = "embedding", trees: int = TREES) -> DataFrame:
    """(query_id, rank, id, score) of the `k` nearest found for each query vector, by Euclidean distance, ties to the smaller id.

    `queries` has the columns of `vectors`; a vector with the query's own id is no answer. Vectors that can't be compared (see `_usable`) take no
    part, and neither do those of another length than most. A repeated id with the same vector counts once. Fewer candidates than `k`
    give all of them; empty tables give an empty result.
    """
    spark = vectors.sparkSession
    rows, asked = _usable(vectors, key, vector), _usable(queries, key, vector).distinct()
    length = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if length is None:
        return spark.createDataFrame([], "query_id bigint, rank int, id bigint, score double")
    rows, asked = rows.filter(F.size("vector") == length["n"]), stored(asked.filter(F.size("vector") == length["n"]))
    if asked.isEmpty():
        return spark.createDataFrame([], "query_id bigint, rank int, id bigint, score double")

    # A point's smallest ids: one more than asked for, as one may be the query's own. Its copies are numbered in parts before they meet.
    copies = rows.groupBy("vector", "id").agg(F.lit(1)).withColumn("part", F.pmod(F.xxhash64("id"), F.lit(64)))
    for by in (["vector", "part"], ["vector"]):
        copies = copies.withColumn("n", F.row_number().over(Window.partitionBy(*by).orderBy("id"))).filter(F.col("n") <= k + 1)
    points = stored(copies.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids")).withColumn("point", F.col("ids")[0]))
    n_points = points.count()
    sample = points.orderBy(F.xxhash64("point"), "point").limit(SAMPLE_POINTS).select("vector").toPandas()["vector"]
    sampled = np.stack(sample.to_numpy()).astype(np.float64)
    forest = [grow(sampled, max(2, LEAF_POINTS * len(sampled) // n_points), seed) for seed in range(trees)]
    shared = spark.sparkContext.broadcast(forest)

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                at = np.stack([tree.leaf_of(_matrix(batch.column(1))) for tree in shared.value], axis=1)
                which = pa.array(np.repeat(np.arange(len(at)), at.shape[1]))
                columns = [pa.array(np.tile(np.arange(at.shape[1], dtype=np.int32), len(at))), pa.array(at.ravel()), *(c.take(which) for c in batch.columns)]
                yield pa.RecordBatch.from_arrays(columns, names=["tree", "leaf", "point", "vector", "ids"])

    point_schema = "tree int, leaf bigint, point bigint, vector array<double>, ids array<bigint>"
    placed = points.select("point", "vector", "ids").mapInArrow(leaves, point_schema)
    held = [np.zeros(tree.leaves, np.int64) for tree in forest]
    # One number for each leaf; the sample bounds how many there are.
    for row in placed.groupBy("tree", "leaf").count().collect():
        held[row["tree"]][row["leaf"]] = row["count"]
    depth = _depth(points, asked, forest, held, k)
    counts = spark.sparkContext.broadcast(held)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, query in enumerate(batch.column(0).to_pylist()):
                one = batch.slice(row, 1).column(1)
                found = np.array(search(shared.value, counts.value, _matrix(one)[0], depth), np.int64)
                parts = np.array([-(-counts.value[t][leaf] // GROUP_POINTS) for t, leaf in found])
                columns = [np.full(len(found), query), found[:, 0].astype(np.int32), found[:, 1], parts.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), one.take(pa.array(np.zeros(len(found), np.int64)))], names=["query", "tree", "leaf", "parts", "asked"])

    wanted = stored(asked.mapInArrow(look, "query bigint, tree int, leaf bigint, parts int, asked array<double>"))
    # Both sides of a leaf are dealt into parts, and each part of the one meets each of the other.
    leaf_parts = wanted.groupBy("tree", "leaf").agg(F.max("parts").alias("parts"), F.ceil(F.count("*") / GROUP_QUERIES).cast("int").alias("query_parts"))
    deal = lambda column, n: F.pmod(F.xxhash64(column), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = wanted.drop("parts").join(leaf_parts, ["tree", "leaf"]).withColumn("query_part", deal("query", "query_parts")).withColumn("part", every("parts"))
    right = placed.join(leaf_parts, ["tree", "leaf"]).withColumn("part", deal("point", "parts")).withColumn("query_part", every("query_parts"))
    by = ["tree", "leaf", "part", "query_part"]

    def measure(asked_rows: pd.DataFrame, held_rows: pd.DataFrame) -> pd.DataFrame:
        """One row for each query: its nearest points here, with all their kept ids."""
        if not len(asked_rows) or not len(held_rows):
            return pd.DataFrame({"query": [], "points": [], "ids": [], "scores": []})
        a, b = (np.stack(x.to_numpy()).astype(np.float64) for x in (asked_rows["asked"], held_rows["vector"]))
        apart, points, ids = _distances(a, b), held_rows["point"].to_numpy(), held_rows["ids"].to_numpy()
        query, at = _nearest_rows(apart, points, k + 1)
        each = at.reshape(len(a), -1)
        scores = np.take_along_axis(apart, each, axis=1)
        return pd.DataFrame({"query": asked_rows["query"].to_numpy(), "points": list(points[each]), "ids": [list(ids[row]) for row in each], "scores": list(scores)})

    def merge(found: pd.DataFrame) -> pd.DataFrame:
        """The nearest of all groups of one query; a point that several trees led to counts once."""
        points, at = np.unique(np.concatenate(found["points"].to_numpy()), return_index=True)
        scores = np.concatenate(found["scores"].to_numpy())[at]
        ids = [x for row in found["ids"] for x in row]
        best = np.lexsort((points, scores))[: k + 1]
        query = int(found["query"].iloc[0])
        rows = sorted((float(scores[i]), int(one)) for i in best for one in ids[at[i]] if one != query)[:k]
        return pd.DataFrame({"query_id": [query] * len(rows), "rank": range(1, len(rows) + 1), "id": [one for _, one in rows], "score": [score for score, _ in rows]})

    left, right = left.select(*by, "query", "asked"), right.select(*by, "point", "vector", "ids")
    schema = "query bigint, points array<bigint>, ids array<array<bigint>>, scores array<double>"
    measured = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(measure, schema)
    return measured.groupBy("query").applyInPandas(merge, "query_id bigint, rank int, id bigint, score double")


def op6_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = nearest_neighbours(vectors, vectors.filter(F.col("vec_id") % EVERY == 0))
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
