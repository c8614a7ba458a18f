from collections import Counter

import numpy as np

from weirwalk.llm import masked_likelihood as ml

from .test_models import odd


def test_scores_against_counts_of_all_words_and_pairs(spark, small_dir, monkeypatch):
    # So few words are broadcast that most counts come from the distributed table.
    monkeypatch.setattr(ml, "VOCABULARY", 120)
    monkeypatch.setattr(ml, "GROUP_BITS", 3)
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text")
    model = ml.fit(docs)
    texts = {row["doc_id"]: ml.words_of(row["text"]) for row in docs.collect()}
    n, pairs = Counter(w for t in texts.values() for w in t), Counter()
    n[None] = sum(1 for t in texts.values() if t)
    for t in texts.values():
        edged = [None, *t, None]
        pairs.update(zip(edged, edged[1:]) if t else [])
    log_p, at = model.log_p.reshape(ml.WINDOWS, ml.CLASSES), {}
    for word in n:
        if word is not None and not 0 <= model.classes.ranks.get(word, -1) < ml.OWN_CLASS:
            at.setdefault(int(model.classes.codes([word]).target[0]), []).append(n[word])
    got = {row["doc_id"]: row for row in ml.op2_masked_likelihood(spark, small_dir).collect()}
    assert set(got) == set(texts)

    def score(t, strength):
        codes = model.classes.codes(t)
        edged, total = [None, *t, None], 0.0
        for i, window in enumerate(ml.windows(codes.near, codes.far)):
            left, word, right = edged[i : i + 3]
            target, within = int(codes.target[i]), 1.0
            if target >= ml.OWN_CLASS:
                # All words of the class, without the masked place; new words as much as words that stand once.
                new = at[target].count(1) + 1
                within = (n[word] - 1 + new / (len(at[target]) + 1)) / (sum(at[target]) - 1 + new)
            gone = Counter([(left, word), (word, right)])
            firsts, seconds = Counter(a for a, _ in gone.elements()), Counter(b for _, b in gone.elements())
            p = np.exp(float(log_p[window, target])) * within
            p = (pairs[left, word] - gone[left, word] + strength * p) / (n[left] - firsts[left] + strength)
            total += np.log((pairs[word, right] - gone[word, right] + strength * p) / (n[right] - seconds[right] + strength))
        return total

    # One strength for all documents: that of the first one.
    first = next(doc_id for doc_id in texts if len(texts[doc_id]) > 50)
    strength = min(ml.STRENGTHS, key=lambda s: abs(score(texts[first], s) - got[first]["log_likelihood"]))
    sums = {s: 0.0 for s in ml.STRENGTHS}
    for doc_id, t in list(texts.items())[:100]:
        each = {s: score(t, s) if t else 0.0 for s in ml.STRENGTHS}
        assert got[doc_id]["n_words"] == len(t) and abs(got[doc_id]["log_likelihood"] - each[strength]) < 1e-3 * max(1, abs(each[strength]))
        sums = {s: sums[s] + each[s] for s in sums}
    assert strength == max(sums, key=sums.get)


def test_the_masked_place_is_taken_out_of_both_pairs(spark):
    """In "a a a" the word in the middle is in two equal pairs: nothing is left of them."""
    docs = spark.createDataFrame([(1, "a a a"), (2, "b c")], "doc_id bigint, text string")
    model = ml.fit(docs)
    log_p = model.log_p.reshape(ml.WINDOWS, ml.CLASSES)
    got = {row["doc_id"]: row["log_likelihood"] for row in ml.score_corpus(docs).collect()}[1]
    codes, wanted = model.classes.codes([b"a"] * 3), []
    for s in ml.STRENGTHS:
        total = 0.0
        # (pairs before, of how many, pairs behind, of how many) without the masked place; two texts have edges.
        for window, (b, nb, h, nh) in zip(ml.windows(codes.near, codes.far), [(0, 1, 1, 1), (0, 1, 0, 1), (1, 1, 0, 1)], strict=True):
            p = (b + s * np.exp(float(log_p[window, codes.target[0]]))) / (nb + s)
            total += np.log((h + s * p) / (nh + s))
        wanted.append(total)
    assert min(abs(got - x) for x in wanted) < 1e-4, (got, wanted)


def test_the_network_carries_the_score(spark, monkeypatch):
    """Against class frequencies in the network's place, which leave a model of neighbouring pairs: likelier, and other ranks."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    model = ml.fit(docs)
    whole = {row["doc_id"]: row for row in ml.score_corpus(docs, columns=["doc_id"]).collect() if row["n_words"]}
    total = ml.window_counts(docs, model.classes).sum(axis=0) + 1
    flat = np.tile(np.log(total / total.sum()), (ml.WINDOWS, 1))
    monkeypatch.setattr(ml.Network, "train", lambda *_: [])
    monkeypatch.setattr(ml.Network, "log_probabilities", lambda _: flat)
    plain = {row["doc_id"]: row for row in ml.score_corpus(docs, columns=["doc_id"]).collect() if row["n_words"]}
    scores = [np.array([x[doc_id]["word_log_likelihood"] for doc_id in sorted(whole)]) for x in (whole, plain)]
    sums = [sum(row["log_likelihood"] for row in x.values()) for x in (whole, plain)]
    ranks = [np.argsort(np.argsort(x)) for x in scores]
    told = (sums, [x.mean() for x in scores], np.corrcoef(ranks)[0, 1])
    # Measured: 0.33 a word likelier, ranks correlate at 0.956.
    assert sums[0] > sums[1] + 0.25 * sum(row["n_words"] for row in whole.values()) and np.corrcoef(ranks)[0, 1] < 0.97, told


def test_spellings_are_exact_in_any_order():
    rng = np.random.default_rng(2)
    words = [bytes(rng.integers(97, 123, rng.integers(1, 30)).astype(np.uint8)) for _ in range(3000)] + [b"x" * 5000, "é".encode() * 700]
    spelling = ml.learn_spelling(words, np.arange(len(words), 0, -1.0))
    got = spelling.of(words)
    each = [spelling.weights[ml.byte_pairs([w])[0]].astype(np.int64).sum(axis=0).argmax() for w in words]
    assert got.tolist() == each and len(spelling.of([])) == 0
    assert len(set(got.tolist())) > 10 and np.array_equal(got[::-1], spelling.of(words[::-1])) and [int(spelling.of([w])[0]) for w in words[-300:]] == got[-300:].tolist()


def test_big_texts_and_other_columns(spark, monkeypatch):
    """A text that is a group of its own scores as it does in a group."""
    rows = [(i, f"some words w{i} " * (1 + 60 * (i % 3)), i) for i in range(12)] + [(50, None, 0), (51, "", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_words bigint").coalesce(2)
    one = {row["doc_id"]: row for row in ml.score_corpus(docs).collect()}
    monkeypatch.setattr(ml, "BIG_TEXT", 200)
    two = {row["doc_id"]: row for row in ml.score_corpus(docs).collect()}
    assert set(one) == set(two) == {row[0] for row in rows} and all(abs(one[i]["log_likelihood"] - two[i]["log_likelihood"]) < 1e-6 for i in one)
    assert one[2]["n_words"] == 3 * 121 and one[50]["n_words"] == 0 and one[50]["word_log_likelihood"] is None


def test_rare_words_and_content_neighbours_count(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ml, "VOCABULARY", 100)
    common = [f"c{i:03d}" for i in range(100)]
    rows = [(i, " ".join(common * 3)) for i in range(8)]
    # zzaaaa stands in three documents, zzbbbb in one; qqxxxx stands behind qqyyyy in three, and once behind another rare word.
    rows += [(10, "zzaaaa"), (11, "zzaaaa c001"), (12, "zzaaaa c002"), (13, "zzbbbb"), (20, "qqyyyy qqxxxx"), (21, "qqyyyy qqxxxx c003"), (22, "qqyyyy qqxxxx c004"), (23, "qqzzzz qqxxxx")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    score = {row["doc_id"]: row["log_likelihood"] for row in ml.op2_masked_likelihood(spark, str(tmp_path)).collect()}
    assert score[10] > score[13] + 0.5 and score[20] > score[23] + 0.5


def test_corpus_scores_of_odd_rows(spark):
    got = ml.score_corpus(odd(spark)).collect()
    assert [row["n_words"] for row in got if row["doc_id"] in (1, 2, 3)] == [0, 0, 0] and len(got) == 6 and all(np.isfinite(row["log_likelihood"]) for row in got)
    assert {row["score"] for row in got} == {0.5}
    assert ml.score_corpus(odd(spark).limit(0)).count() == 0
