import collections

import corpus_pipeline
from weirwalk.llm.common import stored, table
from weirwalk.llm.queries import ORACLE_SQL, QUERIES

from checks.compare import spark_rows, sql_rows

from .brute import near_components, words


def test_queries_match_their_sql(spark, small_dir, small_sql):
    for name, sql in ORACLE_SQL.items():
        result = QUERIES[name](spark, small_dir)
        names, wanted = sql_rows(small_sql, sql)
        assert sorted(result.columns) == names and spark_rows(result) == wanted, name


def test_each_stage_on_what_the_one_before_kept(spark, small_dir):
    docs = table(spark, small_dir, "documents")
    seen = [{row["doc_id"]: row["text"] for row in docs.collect()}]
    counts = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(stage(spark, docs, small_dir))
        assert after.columns == docs.columns, name
        docs = after
        rows = docs.collect()
        seen.append({row["doc_id"]: row["text"] for row in rows})
        counts.append(collections.Counter(row["doc_id"] for row in rows))
    raw, ruled, single, clean, mixed = seen
    assert set(ruled) <= set(raw) and all(len(words(text)) >= 50 for text in ruled.values())
    roots = near_components(list(ruled.items()), 5)
    assert set(single) == {i for i, (_, root) in roots.items() if root == i}
    assert set(clean) == set(single) and all("token = \"[SECRET]\"" in text for i, text in clean.items() if 'token = "' in single[i])
    assert set(mixed) <= set(clean) and max(counts[-1].values()) <= 3
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, small_dir).toPandas()
    assert set(packed["doc_id"]) == set(mixed) and packed.groupby("sequence_id")["length"].sum().max() <= 1024
