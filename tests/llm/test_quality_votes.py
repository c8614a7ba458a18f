import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from weirwalk.llm import quality_neighbours as qn


def counted(text):
    """The features of a text, said once more and without tables."""
    words, out = (text or "").encode().split(), Counter()
    for word in words:
        out[zlib.crc32(word.lower()) % qn.FEATURES] += 1
        shape = re.sub(rb"[0-9]+", b"0", re.sub(rb"[A-Z]+", b"A", re.sub(rb"[a-z\x80-\xff]+", b"a", word)))
        out[zlib.crc32(b"shape " + shape) % qn.FEATURES] += 1
    threes = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    if again := len(threes) - len(set(threes)):
        out[zlib.crc32(b"again") % qn.FEATURES] += again
        out[zlib.crc32(b"again share %d" % (10 * again // len(threes))) % qn.FEATURES] += len(threes)
    if doubled := sum(words[i] == words[i + 1] for i in range(len(words) - 1)):
        out[zlib.crc32(b"doubled share %d" % (10 * doubled // len(words))) % qn.FEATURES] += len(words)
    out[zlib.crc32(b"length %d" % len(words).bit_length()) % qn.FEATURES] += 1
    return out


def vector(text, rarity, axes):
    out = [0.0] * axes.shape[1]
    for feature, n in counted(text).items():
        for j, x in enumerate(axes[feature]):
            out[j] += math.log1p(n) * rarity[feature] * x
    norm = math.sqrt(sum(x * x for x in out))
    return [x / norm for x in out] if norm else out


def test_votes_by_loops(spark, small_dir):
    texts = {row["doc_id"]: row["text"] for row in spark.read.parquet(f"{small_dir}/documents.parquet").collect()}
    held_out = {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in texts}
    labels = {row["doc_id"]: row["quality"] for row in spark.read.parquet(f"{small_dir}/labels.parquet").collect() if not held_out.get(row["doc_id"], True)}
    assert 0 < len(labels) <= qn.SAMPLE_ROWS
    frequencies = Counter(feature for text in texts.values() for feature in counted(text))
    rarity = [math.log((1 + len(texts)) / (1 + frequencies[i])) for i in range(qn.FEATURES)]
    rows = qn.featured(spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text"))
    given = spark.createDataFrame(list(labels.items()), "doc_id bigint, label int")
    model = qn.fit(rows, given)
    assert np.allclose(model.rarity, rarity)
    # The axes are orthonormal and hold as much of the sample as the best ones of a full decomposition.
    matrix = np.zeros((len(labels), qn.FEATURES))
    for i, key in enumerate(sorted(labels)):
        for feature, n in counted(texts[key]).items():
            matrix[i, feature] = math.log1p(n) * rarity[feature]
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    assert np.allclose(model.axes.T @ model.axes, np.eye(model.axes.shape[1]), atol=1e-4)
    best = (np.linalg.svd(matrix, compute_uv=False)[: model.axes.shape[1]] ** 2).sum()
    assert ((matrix @ model.axes) ** 2).sum() >= 0.98 * best
    known = {i: vector(texts[i], rarity, model.axes) for i in labels}
    got = {row["doc_id"]: row for row in qn.op3_quality_neighbours(spark, small_dir).collect()}
    assert {i: row["held_out"] for i, row in got.items()} == held_out
    for i in sorted(texts)[:50]:
        own = vector(texts[i], rarity, model.axes)
        near = sorted((-round(sum(a * b for a, b in zip(own, other, strict=True)), 12), j) for j, other in known.items())[: qn.NEIGHBOURS]
        weights = [(max(-c, 0.0) ** 4, labels[j]) for c, j in near]
        total = sum(w for w, _ in weights)
        want = sum(w * label for w, label in weights) / total if total else sum(labels.values()) / len(labels)
        assert abs(got[i]["score"] - want) < 1e-6 and got[i]["predicted"] == int(got[i]["score"] >= 0.3)


def test_of_equally_near_documents_the_first_vote():
    rng = np.random.default_rng(5)
    for _ in range(50):
        cosines = rng.integers(0, 4, (7, 40)) / 4
        k = int(rng.integers(1, 40))
        want = [sorted(sorted(range(40), key=lambda j: (-row[j], j))[:k]) for row in cosines]
        assert qn._nearest(cosines, k).tolist() == want


def test_whole_words_and_all_counts_are_features(spark):
    head = "x" * 80
    assert counted(head + "9") == dict(zip(*(x.tolist() for x in qn.features(head + "9")), strict=True))
    shape = [zlib.crc32(b"shape " + s) % qn.FEATURES for s in (b"a", b"a0")]
    assert shape[0] in qn.features(head)[0] and shape[0] not in qn.features(head + "9")[0] and shape[1] in qn.features(head + "9")[0]
    row = qn.featured(spark.createDataFrame([(1, "of " * 70_000)], "doc_id bigint, text string")).toArrow()
    at, counts = qn._unpacked(row["features"][0], row["counts"][0])
    assert dict(zip(at.tolist(), counts.tolist(), strict=True))[zlib.crc32(b"of") % qn.FEATURES] == 70_000


def test_repeated_rows_score_alike_wherever_they_stand(spark):
    words = np.random.default_rng(2).choice(["alpha", "beta", "gamma", "DELTA", "5", "x,y"], (700, 30))
    rows = [(i, " ".join(w)) for i, w in enumerate(words.tolist())]
    rows += [(i + 1000, rows[i % 7][1]) for i in range(600)] + [(3, "another text of the id 3"), (3, rows[3][1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    labels = spark.createDataFrame([(i, i % 2) for i in range(700)] + [(1000 + i, 1) for i in range(40)] + [(3, 0), (3, None)], "doc_id bigint, label int")
    featured = qn.featured(docs.select("*", F.col("text").alias("said")))
    models = [qn.fit(rows, labels) for rows in (featured, featured.repartition(3))]
    assert all(np.array_equal(a, b) for a, b in zip(*models, strict=True))
    scores = {}
    for row in qn.score_documents(featured.coalesce(2), models[0]).collect() + qn.score_documents(featured, models[1]).collect():
        scores.setdefault(row["said"], set()).add(row["score"])
    assert all(len(each) == 1 for each in scores.values())
