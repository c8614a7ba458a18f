import random

import numpy as np

from weirwalk.llm.components import components
from weirwalk.llm.near_dedup import band_keys, estimates, near_duplicates, op7_hyperminhash, sketch, without_near_duplicates

from .brute import near_components


def as_dict(df):
    return {row["doc_id"]: (row["n_shingles"], row["component_id"]) for row in df.collect()}


def test_query_against_all_pairs(spark, small_dir):
    rows = [(row["doc_id"], row["text"]) for row in spark.read.parquet(f"{small_dir}/documents.parquet").collect()]
    assert as_dict(op7_hyperminhash(spark, small_dir)) == near_components(rows, 2)


def test_chains_copies_and_odd_rows(spark):
    rng = random.Random(3)
    word = lambda: rng.choice("abcdefghij") + str(rng.randint(0, 400))
    base = [word() for _ in range(100)]
    rows = []
    for i in range(40):
        rows.append((i, " ".join(base)))
        for _ in range(4):
            base[rng.randrange(100)] = word()
    rows += [(100, None), (101, ""), (102, " \n"), (103, "one"), (104, "ONE"), (105, "x y z"), (106, "x y z x y z x"), (107, "a a a a a"), (108, "É é"), (109, "é é")]
    docs = spark.createDataFrame([(*row, "clash") for row in rows], "doc_id bigint, text string, kept string")
    assert as_dict(near_duplicates(docs, 2)) == near_components(rows, 2)
    more = docs.unionByName(docs.limit(3)).unionByName(spark.createDataFrame([(None, "x y z", None)], docs.schema))
    left = without_near_duplicates(more, 2)
    wanted = {i for i, (_, root) in near_components(rows, 2).items() if i == root}
    got = [row["doc_id"] for row in left.collect()]
    assert left.columns == docs.columns and sorted(i for i in got if i is not None) == sorted(wanted) and got.count(None) == 1
    assert near_duplicates(docs.limit(0), 2).count() == 0


def test_copies_that_differ_among_themselves(spark):
    """Copies of one text, each with changes of its own: linked to it or not, but hardly to each other."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = [(500, " ".join(base))]
    for i in range(60):
        copy = list(base)
        for at in rng.sample(range(120), rng.choice((4, 8, 14))):
            copy[at] = f"x{rng.randint(0, 10**6)}"
        rows.append((i, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert as_dict(near_duplicates(docs, 2)) == near_components(rows, 2)


def test_estimates_and_bands():
    rng = np.random.default_rng(0)
    for n in (50, 500, 20000):
        universe = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2))
        cut = len(universe) // 10
        pairs = [(universe[:-cut], universe[cut:])]
        true = (len(universe) - 2 * cut) / len(universe)
        for a, b in pairs:
            guess, slack = estimates(sketch(a)[None], sketch(b)[None], np.array([len(a)]))
            assert abs(guess[0] - true) < slack[0]
            assert (band_keys(sketch(a)[None]) == band_keys(sketch(b)[None])).any()


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1060)]
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {row["node"]: row["component"] for row in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert all(got[i] == find(i) for i in got) and {i for a, b in links if a != b for i in (a, b)} == set(got)


def test_repeated_keys_lose_no_text_that_resembles_no_other(spark):
    one, two = ("a b c d e f g h", "q r s t u v w x")
    rows = [(3, two, 0), (5, one, 1), (5, two, 2), (5, two, 3), (None, two, 4), (6, None, 5), (6, "", 6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n int")
    left = without_near_duplicates(docs, 5)
    assert left.columns == docs.columns
    assert sorted(r["n"] for r in left.collect()) == [0, 1, 4, 5, 6]
