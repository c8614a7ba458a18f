import re

import numpy as np
from pyspark.sql import functions as F

from weirwalk.llm.masked_likelihood import CLASSES, WINDOWS, Network, fit, score_documents, window_counts, windows, word_counts, words_of
from weirwalk.llm.projection_forest import nearest_neighbours, op6_projection_forest
from weirwalk.llm.quality_neighbours import featured, op3_quality_neighbours
from weirwalk.llm.quality_neighbours import fit as fit_quality
from weirwalk.llm.quality_neighbours import score_documents as score_quality
from weirwalk.llm.secret_forest import redacted_documents, scan_secrets
from weirwalk.llm.suffix_repeats import REPEAT_WORDS, WINDOW, repeats, repetition_rules

from .brute import repeated, words

ODD = [(1, None), (2, ""), (3, " \n "), (None, "a b"), (4, "word " * 4000), (4, "word " * 4000)]


def odd(spark):
    return spark.createDataFrame([(*row, 0.5) for row in ODD], "doc_id bigint, text string, score double")


def test_network_gradients():
    rng = np.random.default_rng(0)
    counts, network, at = rng.poisson(0.05, (500, CLASSES)).astype(float), Network(kind=np.float64), rng.choice(WINDOWS, 500, replace=False)
    _, gradients = network.gradients(counts, at)
    for weight, gradient in zip(network.weights, gradients, strict=True):
        where = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        old, step = weight[where], 1e-5
        weight[where] = old + step
        up = network.gradients(counts, at)[0]
        weight[where] = old - step
        down = network.gradients(counts, at)[0]
        weight[where] = old
        assert abs((up - down) / (2 * step) - gradient[where]) < 1e-6


def test_masked_likelihood_against_word_by_word(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs)
    texts = {row["doc_id"]: row["text"] for row in docs.collect()}
    counts = {bytes(row["word"]): row["n"] for row in word_counts(docs).collect()}
    assert sum(counts.values()) == sum(len(words(text)) for text in texts.values()) == window_counts(docs, model.classes).sum()
    log_p = model.log_p.reshape(WINDOWS, CLASSES)
    assert np.allclose(np.exp(log_p).sum(axis=1), 1, atol=1e-4)
    scored = {row["doc_id"]: row for row in score_documents(docs, model).collect()}
    for doc_id in list(texts)[:20]:
        w, total = words_of(texts[doc_id]), 0.0
        for i in range(len(w)):
            # A word's score needs no more than five words around it.
            near = w[max(0, i - 2) : i + 3]
            codes, here = model.classes.codes(near), min(i, 2)
            total += log_p[windows(codes.near, codes.far)[here], codes.target[here]] + np.log(model.classes.within(codes))[here]
        assert abs(scored[doc_id]["log_likelihood"] - total) < 1e-3 * max(1, abs(total))
    shuffled = docs.select("doc_id", F.array_join(F.shuffle(F.split("text", " ")), " ").alias("text"))
    assert score_documents(shuffled, model).agg(F.sum("log_likelihood")).first()[0] < sum(row["log_likelihood"] for row in scored.values())


def test_masked_likelihood_of_odd_rows(spark):
    got = score_documents(odd(spark), fit(odd(spark))).collect()
    assert [row["n_words"] for row in got if row["doc_id"] in (1, 2, 3)] == [0, 0, 0] and len(got) == len(ODD)
    assert all(np.isfinite(row["log_likelihood"]) for row in got)
    assert score_documents(odd(spark).limit(0), fit(odd(spark).limit(0))).count() == 0


def test_quality_on_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = {row["doc_id"]: row["quality"] for row in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    got = [row for row in op3_quality_neighbours(spark, sf_dir).collect() if row["held_out"] and row["doc_id"] in labels]
    assert sum(row["predicted"] == labels[row["doc_id"]] for row in got) >= 0.95 * len(got)
    assert all(0 <= row["score"] <= 1 for row in got)


def test_quality_of_odd_rows(spark):
    rows = featured(odd(spark))
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (4, 1)], "doc_id bigint, label int")
    model = fit_quality(rows, labels)
    assert score_quality(rows, model).count() == len(ODD)
    none = fit_quality(rows, labels.limit(0))
    assert {row["score"] for row in score_quality(rows, none).collect()} == {0.5}
    assert score_quality(featured(odd(spark).limit(0)), fit_quality(featured(odd(spark).limit(0)), labels)).count() == 0


def test_planted_secrets_are_found_and_redacted(spark, small_dir):
    hexes = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"
    rows = [(1, f'the token = "{hexes}" of'), (2, f"sha1 {hexes}"), (3, "card 4785380592391139 and"), (4, None), (5, ""), (None, f'x\npassword: "{hexes}"'), (6, "plain words only")]
    docs = spark.createDataFrame([(*row, 1) for row in rows], "doc_id bigint, text string, n bigint")
    found = scan_secrets(docs).collect()
    text = dict(rows)
    assert all(text[row["doc_id"]][row["start"] : row["start"] + row["length"]] == row["secret"] for row in found)
    assert {row["doc_id"]: row["is_secret"] for row in found} == {1: True, 2: False, 3: False, None: True}
    clean = {row["doc_id"]: row["text"] for row in redacted_documents(docs, scan_secrets(docs)).collect()}
    assert clean[1] == 'the token = "[SECRET]" of' and clean[2] == text[2] and clean[4] is None and len(clean) == len(rows)
    assert scan_secrets(docs.limit(0)).count() == 0
    whole = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    planted = {(row["doc_id"], m) for row in whole.collect() for m in re.findall(r'token = "([0-9a-f]{40})"', row["text"])}
    assert {(row["doc_id"], row["secret"]) for row in scan_secrets(whole).filter("is_secret").collect()} == planted


def brute_nearest(points, query, k):
    at = sorted((float(np.sqrt(((np.array(v) - np.array(points[query])) ** 2).sum())), i) for i, v in points.items() if i != query)
    return at[:k]


def test_forest_recall(spark):
    sf_dir = "/root/testdata/sf0.1"
    points = {row["vec_id"]: row["embedding"] for row in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()}
    got: dict[int, list] = {}
    for row in sorted(op6_projection_forest(spark, sf_dir).collect(), key=lambda row: row["rank"]):
        got.setdefault(row["query_id"], []).append((row["score"], row["vec_id"]))
    true = {query: brute_nearest(points, query, 10) for query in points if query % 100 == 0}
    assert set(got) == set(true) and all(len(rows) == 10 and rows == sorted(rows) for rows in got.values())
    hits = sum(len({i for _, i in got[q]} & {i for _, i in true[q]}) for q in true)
    assert hits >= 0.9 * sum(map(len, true.values()))


def test_forest_with_odd_vectors(spark):
    rows = [(i, [1.0, 0.0]) for i in range(40)] + [(50, [0.0, 0.0]), (51, None), (52, [1.0, float("nan")]), (53, [None, 1.0]), (54, [3.0]), (100, [1.0, 1.0]), (None, [1.0, 2.0]), (100, [1.0, 1.0]), (55, [])]
    vectors = spark.createDataFrame([(*row, 1) for row in rows], "vec_id bigint, embedding array<float>, rank int")
    got = nearest_neighbours(vectors, vectors.filter("vec_id % 50 = 0")).orderBy("query_id", "rank").collect()
    assert [row["id"] for row in got if row["query_id"] == 0] == list(range(1, 11))
    assert [row["id"] for row in got if row["query_id"] == 100] == list(range(10))
    assert {row["query_id"] for row in got} == {0, 100}
    assert nearest_neighbours(vectors.limit(0), vectors).count() == 0 and nearest_neighbours(vectors, vectors.limit(0)).count() == 0


def test_repeats_against_all_suffix_pairs():
    rng = np.random.default_rng(1)
    for _ in range(60):
        docs = [[bytes([97 + x]) for x in rng.integers(0, rng.integers(1, 4), rng.integers(0, 40))] for _ in range(rng.integers(1, 5))]
        for doc, found in zip(docs, repeats(docs, 3, 4), strict=True):
            assert (found.windows, found.covered, found.longest) == repeated(doc, 3, 4)
            assert len({i + k for i, n in found.spans for k in range(n)}) == found.covered


def test_rules_on_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [*ODD, (5, text), (6, text + "\n" + text), (7, text + "\n" + " ".join(text.split()[:10]))]
    docs = spark.createDataFrame([(*row, True) for row in rows], "doc_id bigint, text string, kept boolean")
    got = {row["doc_id"]: row for row in repetition_rules(docs).collect()}
    assert [got[i]["kept"] for i in (1, 2, 3, 4, 5, 6, 7)] == [False, False, False, False, True, False, True]
    assert (got[6]["n_words"], got[6]["n_repeat_words"], got[6]["n_dup_lines"], got[6]["longest_repeat"]) == (120, 120, 1, 60)
    for row in got.values():
        w = words(row["text"])[:200]
        if row["n_words"] <= 200:
            assert (row["n_repeat_words"], row["covered_words"], row["longest_repeat"]) == repeated(w, WINDOW, REPEAT_WORDS)
    assert repetition_rules(docs.limit(0)).count() == 0
