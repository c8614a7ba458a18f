import zlib

from pyspark.sql import functions as F

from weirwalk.llm.common import n_words
from weirwalk.llm.mixing import mix_sources, mixed_documents, op9_source_mix
from weirwalk.llm.sharding import op5_rendezvous_shards, shard_documents

from .brute import words


def test_shards_are_gapless_and_stable(spark, small_dir):
    texts = {row["doc_id"]: row["text"] for row in spark.read.parquet(f"{small_dir}/documents.parquet").collect()}
    got = op5_rendezvous_shards(spark, small_dir).toPandas()
    assert len(got) == len(texts) and set(got["law"]) == {"key"}
    for _, rows in got.groupby("shard"):
        assert sorted(rows["slot"]) == list(range(len(rows)))
    moved = got[got["shard"] != got["grown_shard"]]
    assert set(moved["grown_shard"]) <= {24} and 0 < len(moved) < len(got) / 8
    for row in got.itertuples():
        raw = texts[row.doc_id].encode()
        assert (row.size, row.text_crc32) == (len(raw) + 8, zlib.crc32(raw))


def test_weights_and_odd_keys(spark):
    docs = spark.range(4000).withColumn("shard", F.lit("clash")).withColumnRenamed("id", "doc_id")
    counts = {row["shard"]: row["count"] for row in shard_documents(docs, [1.0, 3.0]).groupBy("shard").count().collect()}
    assert 0.7 < counts[1] / 4000 < 0.8
    odd = spark.createDataFrame([(None, "a"), (None, "a"), (5, None), (5, None)], "doc_id bigint, text string")
    got = shard_documents(odd, [1.0] * 3).collect()
    assert len(got) == 4 and {row["grown_shard"] for row in got} == {None}
    assert len({(row["shard"], row["slot"]) for row in got}) == 4
    assert shard_documents(odd.limit(0), [1.0]).count() == 0


def test_mix_meets_every_target(spark, small_dir):
    got = op9_source_mix(spark, small_dir).toPandas()
    assert abs(got.groupby("source_size")["target"].first().mul(1).sum() - got["size"].sum()) < 1e-6 * got["size"].sum() or got["source_size"].duplicated().any()
    for (_, target), rows in got.groupby(["source_size", "target"]):
        assert abs(rows["taken"].sum() - target) <= 1 or rows["size"].sum() > rows["source_size"].iloc[0]
    assert (got["taken"] <= 3 * got["size"]).all()


def test_mix_of_odd_rows(spark):
    rows = [(1, "a b c", "x"), (2, None, "x"), (3, "", None), (4, "a  b\nc d", None), (5, "w " * 40, "y"), (5, "w " * 40, "y"), (None, "q q", "z")]
    docs = spark.createDataFrame([(*row, 1, 2) for row in rows], "doc_id bigint, text string, source string, n_chars bigint, target int")
    mixed = mix_sources(docs, n_words(F.col("text"))).toPandas()
    assert len(mixed) == len(rows) and list(mixed.sort_values("size")["size"]) == sorted(len(words(text)) for _, text, _ in rows)
    assert (mixed["target"] <= 3 * mixed["source_size"]).all() and (mixed["taken"] <= 3 * mixed["size"]).all()
    made = mixed_documents(docs)
    assert made.columns == docs.columns
    total = sum(len(words(row["text"])) for row in made.collect())
    assert total == mixed["taken"].sum()
    assert mixed_documents(docs.limit(0)).count() == 0
    again = mix_sources(docs.repartition(3), n_words(F.col("text"))).toPandas()
    assert sorted(again["taken"]) == sorted(mixed["taken"])
