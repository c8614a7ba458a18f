"""Quality rules on repetition inside a text, by a suffix array of its words.

The suffixes of a text, sorted, with the longest common prefix (LCP) of neighbours: an LCP interval is a set of suffixes that share a
prefix, and its prefix is a repeated substring. The longest prefix that a suffix shares with any other is the larger of its two neighbouring
LCPs; where it is no mere continuation of the one a word earlier, a maximal repeat starts. The union of all such spans is the text's
repeated part.

Suffix arrays are built by prefix doubling in numpy, many documents at a time: each document has symbols of its own, so suffixes of two
documents share nothing. Only suffixes that are not told apart yet take part in the next doubling.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weirwalk.llm.common import table

SYMBOLS = "#*$%&|<>"
FEWEST_WORDS = 50
#: Words of the window for base rules, and how much of a text (in hundredths) its repeats may cover.
WINDOW, MOST_WINDOWS = 3, 50
#: A repeated substring counts from so many words on; repeats may cover this share of the words, and none may be longer.
REPEAT_WORDS, MOST_COVERED, MOST_LONGEST = 10, 0.3, 100
#: Documents are taken together up to about so many words; a longer text is taken alone.
_TOGETHER = 1 << 17


def shared_prefixes(symbols: np.ndarray) -> np.ndarray:
    """For each suffix, the length of the longest prefix that it shares with another one. The last symbol must be unique."""
    n = len(symbols)
    # A rank is the number of smaller suffixes by the first h symbols, so ranks of suffixes told apart stay as they are.
    order = np.argsort(symbols, kind="stable")
    firsts = np.flatnonzero(np.r_[True, np.diff(symbols[order]) != 0])
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(firsts, np.diff(np.r_[firsts, n]))
    by_length, h = [rank], 1
    while True:
        sizes = np.bincount(rank, minlength=n)
        active = np.flatnonzero(sizes[rank] > 1)
        if not len(active):
            break
        # Unique last symbols end a common prefix before the end, so rank[active + h] exists.
        first, second = rank[active], rank[active + h]
        by = np.lexsort((second, first))
        a, b = first[by], second[by]
        new_group = np.r_[True, a[1:] != a[:-1]]
        new_part = new_group | np.r_[True, b[1:] != b[:-1]]
        at = np.arange(len(by))
        group_start = np.maximum.accumulate(np.where(new_group, at, 0))
        part_start = np.maximum.accumulate(np.where(new_part, at, 0))
        rank = rank.copy()
        rank[active[by]] = a + part_start - group_start
        by_length.append(rank)
        h *= 2
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    # LCP of neighbours: from the longest step down, go on as long as ranks by so many symbols agree.
    left, right = suffixes[:-1], suffixes[1:]
    common = np.zeros(n - 1, np.int64)
    pairs = np.flatnonzero(by_length[0][left] == by_length[0][right])
    a, b = left[pairs].copy(), right[pairs].copy()
    for level in range(len(by_length) - 1, -1, -1):
        same = by_length[level][np.minimum(a, n - 1)] == by_length[level][np.minimum(b, n - 1)]
        a[same] += 1 << level
        b[same] += 1 << level
    common[pairs] = a - left[pairs]
    longest = np.zeros(n, np.int64)
    longest[suffixes[:-1]] = common
    longest[suffixes[1:]] = np.maximum(longest[suffixes[1:]], common)
    return longest


def _covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    edges = np.bincount(starts, minlength=n + 1) - np.bincount(starts + lengths, minlength=n + 1)
    return np.cumsum(edges)[:n] > 0


class Repeats(NamedTuple):
    """Of one document: words covered by repeated windows and by long repeats, the longest repeat, and maximal repeats as (start, length)."""

    windows: int
    covered: int
    longest: int
    spans: list[tuple[int, int]]


def repeats(documents: list[list[bytes]], window: int = WINDOW, at_least: int = REPEAT_WORDS) -> list[Repeats]:
    """The repeats inside each of some documents, given as lists of words. Occurrences may overlap."""
    sizes = np.array([len(words) for words in documents])
    codes, known = pd.factorize(np.array([word for words in documents for word in words], object))
    ends = np.cumsum(sizes + 1) - 1
    symbols = np.empty(int(ends[-1]) + 1, np.int64)
    inside = np.ones(len(symbols), bool)
    inside[ends] = False
    # Words of two documents are never the same symbol, and neither are two ends.
    step = len(known) + 1
    symbols[inside], symbols[ends] = codes + np.repeat(np.arange(len(documents)), sizes) * step, np.arange(1, len(documents) + 1) * step - 1
    longest = shared_prefixes(symbols)
    n = len(symbols)
    starts = np.flatnonzero(longest >= window)
    in_window = _covered(starts, np.full(len(starts), window), n)
    starts = np.flatnonzero(longest >= at_least)
    in_repeat = _covered(starts, longest[starts], n)
    maximal = starts[(starts == 0) | (longest[starts - 1] != longest[starts] + 1)]
    out, first = [], 0
    total_window, total_repeat = np.r_[0, np.cumsum(in_window)], np.r_[0, np.cumsum(in_repeat)]
    for end in ends:
        a, b = np.searchsorted(maximal, (first, end))
        spans = [(int(i - first), int(longest[i])) for i in maximal[a:b]]
        out.append(Repeats(int(total_window[end] - total_window[first]), int(total_repeat[end] - total_repeat[first]), int(longest[first : end + 1].max()), spans))
        first = end + 1
    return out


_SCHEMA = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, covered_words bigint, "
    "longest_repeat bigint, n_maximal_repeats bigint"
)


def _counts(text: str, words: list[bytes], found: Repeats) -> tuple[int, ...]:
    lines = [line for line in text.split("\n") if line.encode().split()]
    return (
        len(words),
        len(text) - sum(map(text.count, " \t\n\r\x0b\x0c")),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        found.windows,
        found.covered,
        found.longest,
        len(found.spans),
    )


def repetition_rules(docs: DataFrame, text: str = "text", at_least: int = REPEAT_WORDS, most_covered: float = MOST_COVERED, most_longest: int = MOST_LONGEST) -> DataFrame:
    """All columns of `docs` with counts, base_failed and kept.

    Words are runs without ASCII white space, over the whole text, whatever its length. base_failed: under 50 words, or windows of three words that stand more than
    once cover over half of the words. kept: not base_failed, repeats of at_least or more words cover at most `most_covered` of the words, and none
    is longer than `most_longest` words. Null and empty texts have no words, so they fail; repeated rows are judged each on its own; an empty
    table gives an empty result. Columns of `docs` with the names that are added are replaced.
    """
    added = [part.split()[0] for part in _SCHEMA.split(", ")] + ["base_failed", "kept"]
    clean = docs.drop(*added)
    place = clean.columns.index(text)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [value or "" for value in batch.column(place).to_pylist()]
            rows: list[tuple[int, ...]] = []
            together: list[tuple[str, list[bytes]]] = []
            n = 0
            for i, value in enumerate(texts):
                together.append((value, value.encode().split()))
                n += len(together[-1][1])
                if n >= _TOGETHER or i + 1 == len(texts):
                    rows += [_counts(*one, found) for one, found in zip(together, repeats([words for _, words in together], WINDOW, at_least), strict=True)]
                    together, n = [], 0
            made = [pa.array(column, pa.int64()) for column in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * 8
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, *added[:-2]])

    counted = clean.mapInArrow(judge, StructType(clean.schema.fields + StructType.fromDDL(_SCHEMA).fields))
    failed = (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > MOST_WINDOWS * F.col("n_words"))
    fine = (F.col("covered_words") <= F.lit(most_covered) * F.col("n_words")) & (F.col("longest_repeat") <= most_longest)
    return counted.withColumn("base_failed", failed).withColumn("kept", ~failed & fine)


def op8_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = repetition_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rules.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "base_failed", "kept")


def op8_sql() -> str:
    """A word lies in a repeat of k or more words just if it lies in a window of k words that stands twice; the longest repeat is over k words just if
    some window of k + 1 words does."""
    over = MOST_LONGEST + 1
    return rf"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), places AS (
  SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM docs
), windows AS (
  SELECT doc_id, i, len(words) AS n,
         CASE WHEN i + 2 <= len(words) THEN array_to_string(words[i : i + 2], ' ') END AS w3,
         CASE WHEN i + {REPEAT_WORDS - 1} <= len(words) THEN md5(array_to_string(words[i : i + {REPEAT_WORDS - 1}], ' ')) END AS w10,
         CASE WHEN i + {over - 1} <= len(words) THEN md5(array_to_string(words[i : i + {over - 1}], ' ')) END AS wlong
  FROM places
), counted AS (
  SELECT doc_id, i,
         CAST(w3 IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, w3) > 1 AS INT) AS r3,
         CAST(w10 IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, w10) > 1 AS INT) AS r10,
         CAST(wlong IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, wlong) > 1 AS INT) AS rlong
  FROM windows
), covered AS (
  SELECT doc_id, max(r3) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS c3,
         max(r10) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {REPEAT_WORDS - 1} PRECEDING AND CURRENT ROW) AS c10, rlong
  FROM counted
), sums AS (
  SELECT doc_id, CAST(sum(c3) AS BIGINT) AS n_repeat_words, CAST(sum(c10) AS BIGINT) AS covered_words, max(rlong) AS too_long FROM covered GROUP BY doc_id
), lines AS (
  SELECT doc_id, CAST(count(*) - count(DISTINCT line) AS BIGINT) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), facts AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(covered_words, 0) AS covered_words,
         coalesce(too_long, 0) AS too_long
  FROM docs LEFT JOIN sums USING (doc_id) LEFT JOIN lines USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, covered_words,
       n_words < {FEWEST_WORDS} OR 100 * n_repeat_words > {MOST_WINDOWS} * n_words AS base_failed,
       NOT (n_words < {FEWEST_WORDS} OR 100 * n_repeat_words > {MOST_WINDOWS} * n_words)
         AND covered_words <= {MOST_COVERED}::DOUBLE * n_words AND too_long = 0 AS kept
FROM facts
"""
