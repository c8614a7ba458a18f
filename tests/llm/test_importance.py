import collections
import hashlib
import math
import zlib

import pytest
from pyspark.sql import functions as F

from weirwalk.llm.importance import feature_buckets, importance_resampled, op13_importance_resampling, radix_places, resampled_documents

from .brute import lower


def features(text):
    out, word = [], ""
    for c in lower(text) + " ":
        if c in "0123456789abcdefghijklmnopqrstuvwxyz" or ord(c) > 127:
            word += c
        else:
            out += [word] if word else []
            word = ""
    return out


def resampled(rows, benchmark, buckets=10000, fewest=20, hundredths=10):
    """doc_id → (n_features, weight, score, rank), one step after another."""

    def counted(texts):
        return collections.Counter(zlib.crc32(w.encode()) % buckets for text in texts for w in features(text))

    s, t = counted(text for _, text in rows), counted(benchmark)
    n, m = sum(s.values()), sum(t.values())
    out, able = {}, []
    for doc_id, text in rows:
        words = features(text)
        weight = 0
        for w in words:
            b = zlib.crc32(w.encode()) % buckets
            weight += math.floor(1000 * math.log((t[b] + 1) * (n + buckets) / ((s[b] + 1) * (m + buckets))))
        h = int(hashlib.sha256(f"2024:{doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out[doc_id] = [len(words), weight, score, None]
        able += [(-score, doc_id)] if len(words) >= fewest else []
    for rank, (_, doc_id) in enumerate(sorted(able)[: len(able) * hundredths // 100], 1):
        out[doc_id][3] = rank
    return {i: tuple(x) for i, x in out.items()}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_against_brute_force(spark, sf):
    sf_dir = f"/root/testdata/{sf}"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    benchmark = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    got = op13_importance_resampling(spark, sf_dir).collect()
    assert {r["doc_id"]: (r["n_features"], r["weight"], r["score"], r["rank"]) for r in got} == resampled(rows, benchmark)
    assert len(got) == len(rows) and any(r["rank"] for r in got)


def test_words_and_longer_runs():
    text = "Ab-c É2 x\x00y  _z{"
    assert features(text) == ["ab", "c", "É2", "x", "y", "z"]
    n, found = feature_buckets(text, 1000, 1)
    assert n == 6 and list(found) == [zlib.crc32(w.encode()) % 1000 for w in features(text)]
    runs = ["ab", "c", "É2", "ab c", "c É2", "ab c É2"]
    assert list(feature_buckets("Ab c É2", 1000, 3)[1]) == [zlib.crc32(w.encode()) % 1000 for w in runs]


@pytest.mark.parametrize("block_rows", [7, 1000])
def test_radix_places_with_ties_and_wide_keys(spark, block_rows):
    rows = spark.range(300).select("id", (F.pmod(F.xxhash64("id"), F.lit(7)) * 2**40).alias("a"), (F.lit(300) - F.col("id") % 150).alias("b"))
    made = lambda: sorted((r["place"], r["row"]) for r in radix_places(rows, [(F.col("a"), 43), (F.col("b"), 9)], "id", block_rows, digit_bits=8).collect())
    places, keys = made(), {r["id"]: (r["a"], r["b"]) for r in rows.collect()}
    assert [place for place, _ in places] == list(range(300)) and len({row for _, row in places}) == 300
    assert [keys[row] for _, row in places] == sorted(keys.values()) and places == made()


def test_one_score_for_most_rows(spark):
    """All blocks have most of their rows in one digit."""
    rows = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(9).alias("a"))
    places = radix_places(rows, [(F.col("a"), 13)], "id", 64, 6).toPandas().sort_values("place")
    wanted = sorted(i if i % 3 == 0 else 9 for i in range(5000))
    assert [i if i % 3 == 0 else 9 for i in places["row"]] == wanted and list(places["place"]) == list(range(5000))
    assert places["row"].nunique() == 5000


def odd_rows(spark):
    long = "Word " * 30000
    rows = [(1, None), (2, ""), (3, " \n!?"), (None, "a b " * 20), (4, long), (4, long), (5, "a b " * 10), (6, "a b " * 10)]
    return spark.createDataFrame([(*row, 0.5, "x") for row in rows], "doc_id bigint, text string, score double, rank string")


def test_odd_rows_and_repeated_ones(spark, small_dir):
    docs, target = odd_rows(spark), spark.createDataFrame([("b b b",), (None,)], "text string")
    got = importance_resampled(docs, target, hundredths=100).collect()
    assert len(got) == 8 and sorted(r["rank"] for r in got if r["rank"]) == [1, 2, 3, 4, 5]
    found = {r["doc_id"]: r for r in got}
    assert all(found[i]["n_features"] == found[i]["weight"] == 0 and found[i]["rank"] is None for i in (1, 2, 3))
    four = [r for r in got if r["doc_id"] == 4]
    assert four[0]["score"] == four[1]["score"] and abs(four[0]["rank"] - four[1]["rank"]) == 1
    drawn = resampled_documents(docs, target, hundredths=100)
    assert drawn.columns == docs.columns and drawn.filter("doc_id = 5").first()["score"] == 0.5


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert importance_resampled(none, none).collect() == []
    one = importance_resampled(spark.createDataFrame([(1, "a " * 30)], "doc_id bigint, text string"), none, hundredths=100).collect()
    assert [(r["n_features"], r["rank"]) for r in one] == [(30, 1)]
