import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from weirwalk.llm import token_files
from weirwalk.llm.common import work_dir
from weirwalk.llm.packing import END_ID, TightestBin, best_fit_pack, op10_best_fit, pack_histogram, sequences, token_pieces
from weirwalk.llm.token_files import PerfectHash, op1_token_files, read_token_files, write_token_files
from weirwalk.llm.tokens import WordwiseTokenizer

from .brute import best_fit_decreasing

WORD, BYTE = (public_tokenizers.path(name) for name in ("word_bpe_49k.json", "byte_bpe_50k.json"))
ODD = ["", " ", "\n\n  a  b", "it's  'sample' 'Sx  12³ ½x\r\n\t y.\x1c.", "é ́x İstanbul ΣΑΣ", "<|endoftext|> a", "a\xa0  b", "x" * 500 + " " + "9" * 300, "a 　 b\n Word, WORD!"]
ROWS = [(3, "a b"), (3, "c"), (None, "x y z"), (5, None), (7, ""), (9, "long " * 3000)]
SCHEMA = "doc_id bigint, text string, ids string"


def whole(path, text, end):
    ids = Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids
    return np.array([*ids, end], "<u4")


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_wordwise_ids_equal_whole_text_ids(path, spark, small_dir):
    texts = [row["text"] for row in spark.read.parquet(f"{small_dir}/documents.parquet").collect()] + ODD
    wordwise, plain = WordwiseTokenizer(path), Tokenizer.from_file(path)
    for text in texts:
        assert wordwise.encode(text) == np.array(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text[:60]


def test_perfect_hash_is_minimal():
    hashes = np.random.default_rng(0).integers(0, 2**63, 5000).astype(np.uint64)
    assert sorted(PerfectHash.build(hashes).slots(hashes)) == list(range(5000))
    assert len(PerfectHash.build(hashes[:0]).slots(hashes[:3])) == 3


def test_files_give_back_every_document(spark, small_dir, monkeypatch):
    monkeypatch.setattr("weirwalk.llm.token_files.SHARD_ROWS", 32)
    monkeypatch.setattr("weirwalk.llm.token_files.INDEX_ROWS", 40)
    texts = {row["doc_id"]: row["text"] for row in spark.read.parquet(f"{small_dir}/documents.parquet").collect()}
    start = 0
    got = op1_token_files(spark, small_dir).orderBy("doc_id").collect()
    assert [row["doc_id"] for row in got] == sorted(texts)
    for row in got:
        ids = whole(WORD, texts[row["doc_id"]], 1)
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_files_with_odd_rows(spark):
    docs = spark.createDataFrame([(*row, "clash") for row in ROWS], SCHEMA)
    files = write_token_files(docs, work_dir(spark), WORD, 1)
    asked = docs.select("doc_id").unionByName(spark.createDataFrame([(99,)], "doc_id bigint"))
    got = sorted((row["start"], row["doc_id"], bytes(row["ids"])) for row in read_token_files(asked, files).collect())
    assert [i for _, i, _ in got] == [None, 3, 3, 5, 7, 9]
    assert {ids for _, i, ids in got if i == 3} == {whole(WORD, text, 1).tobytes() for text in ("a b", "c")}
    assert read_token_files(docs, write_token_files(docs.limit(0), work_dir(spark), WORD, 1)).count() == 0


def test_a_key_of_very_many_rows(spark, monkeypatch):
    monkeypatch.setattr(token_files, "PART_IDS", 5000)
    n, hot = 50_000, 7
    rows = [(hot if i % 3 else i + 100, f"text {i}") for i in range(n)] + [(None, f"none {i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    files = write_token_files(docs, work_dir(spark), WORD, 1)
    back = read_token_files(docs.select("doc_id").repartition(9), files).toPandas()
    plain = Tokenizer.from_file(WORD)
    want = Counter((key, np.array([*plain.encode(text, add_special_tokens=False).ids, 1], "<u4").tobytes()) for key, text in rows)
    assert Counter((None if pd.isna(key) else int(key), bytes(ids)) for key, ids in zip(back["doc_id"], back["ids"])) == want
    placed = back.sort_values("start")
    assert list(placed["start"]) == [0, *(placed["ids"].map(len) // 4).cumsum()[:-1]]
    # Fewer asked than there are: those with the lowest numbers, each once.
    few = read_token_files(spark.createDataFrame([(hot,)] * 20 + [(100,), (-5,)], "doc_id bigint"), files).toPandas()
    of_hot = placed[placed["doc_id"] == hot]["start"][:20]
    assert sorted(few[few["doc_id"] == hot]["start"]) == list(of_hot) and (few["doc_id"] == 100).sum() == 1 and len(few) == 21


def test_tightest_bin():
    tree = TightestBin(10)
    assert tree.at_least(1) is None
    for taken in (2, 7, 10):
        tree.set(taken, True)
    assert [tree.at_least(n) for n in (1, 2, 3, 7, 8, 10)] == [2, 2, 7, 7, 10, 10]
    tree.set(10, False)
    assert tree.at_least(8) is None


def test_histogram_packs_as_one_by_one():
    rng = np.random.default_rng(1)
    for _ in range(100):
        capacity = int(rng.integers(5, 40))
        counts = {int(n): int(rng.integers(1, 9)) for n in rng.choice(np.arange(1, capacity + 1), rng.integers(1, 5), replace=False)}
        used: dict[int, int] = {}
        for run in pack_histogram(counts, capacity):
            for j in range(run.pieces):
                where = run.first_bin + j // run.per_bin
                assert used.get(where, 0) == run.offset + j % run.per_bin * run.length
                used[where] = used.get(where, 0) + run.length
        wanted = best_fit_decreasing([length for length, n in counts.items() for _ in range(n)], capacity)
        assert sorted(capacity - n for n in used.values()) == sorted(wanted)


def test_packed_query_is_gapless_and_whole(spark, small_dir):
    texts = {row["doc_id"]: row["text"] for row in spark.read.parquet(f"{small_dir}/documents.parquet").collect()}
    got = op10_best_fit(spark, small_dir).toPandas()
    for _, rows in got.sort_values("offset").groupby("sequence_id"):
        assert list(rows["offset"]) == [0, *rows["length"].cumsum()[:-1]] and rows["length"].sum() <= 1024
    for doc_id, rows in got.sort_values("piece").groupby("doc_id"):
        ids = whole(BYTE, texts[doc_id], END_ID)
        assert list(rows["start"]) == [0, *rows["length"].cumsum()[:-1]] and rows["length"].sum() == len(ids) and (rows["length"][1:] == 1024).all()
        for row in rows.itertuples():
            assert row.ids_crc32 == zlib.crc32(ids[row.start : row.start + row.length].tobytes())
    assert len(best_fit_decreasing(list(got["length"]), 1024)) == got["sequence_id"].nunique()


def test_packing_odd_rows(spark):
    docs = spark.createDataFrame([(*row, "clash") for row in ROWS], SCHEMA)
    packed = best_fit_pack(token_pieces(docs, BYTE, END_ID))
    joined = sequences(packed).agg({"n_tokens": "sum"}).first()[0]
    assert joined == sum(len(whole(BYTE, text, END_ID)) for _, text in ROWS)
    assert best_fit_pack(token_pieces(docs.limit(0), BYTE, END_ID)).count() == 0
    lengths = spark.createDataFrame([(1, 0), (2, None), (3, 2000), (4, 5)], "doc_id bigint, length bigint")
    assert {row["doc_id"]: row["offset"] for row in best_fit_pack(lengths).collect()} == {1: None, 2: None, 3: None, 4: 0}
