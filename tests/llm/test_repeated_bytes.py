import hashlib
import tracemalloc

import numpy as np
import pytest

from weirwalk.llm import repeated_bytes as rb
from weirwalk.llm.repeated_bytes import Shards, later_windows, merged, op12_merged_transforms, repeated_bytes, without_repeated_bytes


def cut(rows, window=100):
    """key → (n_bytes, removed runs, kept bytes), window by window over the documents in order."""
    seen, out = set(), {}
    for key, text in sorted(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - window + 1):
            if data[i : i + window] in seen:
                gone[i : i + window] = b"\1" * window
            seen.add(data[i : i + window])
        runs = [(i, j) for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]) for j in [gone.find(0, i) if gone.find(0, i) >= 0 else len(gone)]]
        out[key] = (len(data), runs, bytes(b for b, g in zip(data, gone) if not g))
    return out


def digests(rows):
    return {k: (n, sum(b - a for a, b in runs), len(runs), hashlib.sha256(kept).hexdigest()) for k, (n, runs, kept) in cut(rows).items()}


def got(frame):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in frame.collect()}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_against_brute_force(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text").collect()]
    found = got(op12_merged_transforms(spark, f"/root/testdata/{sf}"))
    assert found == digests(rows) and sum(removed > 0 for _, removed, _, _ in found.values()) > 5


def texts(seed, n=60):
    """Few letters, long runs, zero bytes, passages with different surroundings, copies."""
    random = np.random.default_rng(seed)
    passages = ["".join(random.choice(list("ab\0é "), random.integers(60, 260))) for _ in range(4)] + ["a" * 150, "\0" * 130, "xy" * 90]
    out = []
    for i in range(n):
        parts = [random.choice(["", "é", "q", "\0\0"]) + "".join(random.choice(list("abc de\n"), random.integers(0, 90))) + passages[random.integers(len(passages))] for _ in range(random.integers(0, 4))]
        out.append((int(random.integers(-50, 50)) * 100 + i, "".join(parts) if i % 9 else None))
    return out + [(9000 + i, out[5][1]) for i in range(3)]


@pytest.mark.parametrize("seed", range(3))
def test_odd_texts_against_brute_force(spark, seed, monkeypatch):
    if seed:
        # Small chunks, shards and groups; in one run leaders go window by window.
        for name, value in (("CHUNK", 300), ("SHARD_BYTES", 400), ("GROUP_BYTES", 20000), ("MOST_STRETCHES", 3 if seed == 2 else 1 << 14)):
            monkeypatch.setattr(rb, name, value)
    rows = texts(seed)
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, row int").repartition(5)
    assert got(repeated_bytes(docs)) == digests(rows)
    kept = {r["doc_id"]: (list(zip(r["lows"], r["highs"])), bytes(r["kept"])) for r in without_repeated_bytes(docs).collect()}
    assert kept == {k: (runs, left) for k, (_, runs, left) in cut(rows).items()}


@pytest.mark.parametrize("shard_bytes", [1, 300, 1 << 20])
def test_merged_transforms_are_the_sorted_suffixes(shard_bytes):
    random = np.random.default_rng(4)
    pieces = [bytes(random.choice([0, 97, 98], random.integers(100, 168)).astype(np.uint8)) for _ in range(12)]
    pieces += [pieces[0][:60] + b"c" * 60, b"ab" * 70, b"ab" * 60 + pieces[1][:20]]
    shards = Shards(pieces, shard_bytes)
    suffixes, common = merged(shards)
    assert sorted(suffixes) == list(range(len(suffixes)))

    def first(s):
        return pieces[shards.piece[s]][shards.local[s] : shards.local[s] + 100]

    # With zero bytes, an end may be told from a zero or not: both orders are the same to whole windows.
    whole = [(i, first(s)) for i, s in enumerate(suffixes) if len(first(s)) == 100]
    assert [w for _, w in whole] == sorted(w for _, w in whole)
    for (i, a), (j, b) in zip(whole, whole[1:]):
        least = min(common[i + 1 : j + 1])
        agree = next((k for k in range(100) if a[k] != b[k]), 100) // 20
        assert least <= agree and (least == 5) == (a == b)


def test_later_windows():
    shared = bytes(range(33, 153))
    key, start = later_windows([b"x" + shared, shared + b"y", b"z" * 100], np.array([7, 3, 1]), np.array([10, 50, 0]))
    assert sorted(zip(key.tolist(), start.tolist())) == [(7, 11 + i) for i in range(21)]


def test_repeated_and_null_keys_and_empty_tables(spark):
    text = "The same text, again and again. " * 5
    rows = [(2, text), (2, text), (None, text), (1, "other " * 3), (3, None), (4, "")]
    found = repeated_bytes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    twos = sorted(r["n_removed"] for r in found if r["doc_id"] == 2)
    # The text repeats itself: the first 132 bytes of the first row stay.
    assert twos == [len(text) - 32, len(text)] and [r["n_removed"] for r in found if r["doc_id"] is None] == [len(text)]
    assert len(found) == 6
    assert repeated_bytes(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_one_passage_in_most_documents(spark):
    """A hot leader: the same line with other neighbours in 3,000 documents."""
    line = "This very common line stands in most of the documents of the whole table, whatever is before or behind."
    rows = [(i, f"{i * 7919 % 3000:04d}" + (line if i % 3 else "rest") + f"{i * 104729 % 3000:04d} end") for i in range(3000)]
    assert got(repeated_bytes(spark.createDataFrame(rows, "doc_id bigint, text string"))) == digests(rows)


def test_a_group_is_merged_in_little_memory():
    """Some 90 bytes for each byte of a group's stretches; it was over 160."""
    random = np.random.default_rng(6)
    pieces = [bytes(random.integers(0, 30, random.integers(100, 169)).astype(np.uint8)) for _ in range(4000)]
    tracemalloc.start()
    later_windows(pieces, np.arange(len(pieces)), np.zeros(len(pieces), np.int64))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 110 * sum(map(len, pieces))
