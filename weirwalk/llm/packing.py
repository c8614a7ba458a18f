"""Best-fit decreasing packing of token pieces into sequences of one capacity.

Which pieces share a sequence depends on lengths alone, and there are at most `capacity` lengths. So the driver packs a histogram: it goes
through the lengths from long to short and puts pieces of one length, many at a time, into the tightest open bins, which a segment tree over
the remaining capacities finds in logarithmic time. The outcome is a short list of runs ("pieces 500 to 799 of length 90 go to bins 40
onwards"); the pieces find their place in it by their rank among pieces of their length, a distributed numbering. This is exact best-fit
decreasing over all pieces, whatever their number: no task sees more than one bounded group, and the driver sees no piece.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirwalk.llm.common import groups_for, stored, table
from weirwalk.llm.sharding import SLOT_GROUP_ROWS, with_slots
from weirwalk.llm.tokens import encode_documents

CAPACITY = 1024
TOKENIZER = "byte_bpe_50k.json"
END_ID = 2


class TightestBin:
    """A segment tree over remaining capacities 0 to `capacity`: which are taken by an open bin, and the smallest that is at least a length."""

    def __init__(self, capacity: int):
        self._leaves = 1
        while self._leaves <= capacity:
            self._leaves *= 2
        self._any = [False] * (2 * self._leaves)

    def set(self, remaining: int, taken: bool) -> None:
        node = remaining + self._leaves
        self._any[node] = taken
        while node > 1:
            node //= 2
            self._any[node] = self._any[2 * node] or self._any[2 * node + 1]

    def at_least(self, length: int) -> int | None:
        node = length + self._leaves
        if node >= 2 * self._leaves:
            return None
        if self._any[node]:
            return length
        while node > 1:
            # From a left child whose sibling has a bin, go down to that sibling's smallest.
            if node % 2 == 0 and self._any[node + 1]:
                node += 1
                while node < self._leaves:
                    node = 2 * node if self._any[2 * node] else 2 * node + 1
                return node - self._leaves
            node //= 2
        return None


class Run(NamedTuple):
    """Pieces of one length, from a rank on, that fill neighbouring bins alike."""

    length: int
    first_rank: int
    pieces: int
    first_bin: int
    per_bin: int
    offset: int


def pack_histogram(counts: dict[int, int], capacity: int) -> list[Run]:
    """Best-fit decreasing over `counts[length]` pieces of each length, 1 to capacity."""
    open_bins: dict[int, list[tuple[int, int]]] = {}
    tree, runs, n_bins = TightestBin(capacity), [], 0

    def put_back(remaining: int, first: int, n: int) -> None:
        if n and remaining:
            open_bins.setdefault(remaining, []).append((first, n))
            tree.set(remaining, True)

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            remaining = tree.at_least(length)
            if remaining is None:
                # No open bin fits: as many new ones as these pieces need.
                remaining = capacity
                first, n = n_bins, -(-left // (capacity // length))
                n_bins += n
            else:
                first, n = open_bins[remaining].pop()
                if not open_bins[remaining]:
                    tree.set(remaining, False)
            # A bin that has just got a piece stays the tightest until it can't hold another, so bins fill one after another.
            per_bin = remaining // length
            full = min(n, left // per_bin)
            rest = min(left - full * per_bin, per_bin) if full < n else 0
            for bins, at, each in ((full, first, per_bin), (1 if rest else 0, first + full, rest)):
                if bins:
                    runs.append(Run(length, rank, bins * each, at, each, capacity - remaining))
                    put_back(remaining - each * length, at, bins)
                    rank, left = rank + bins * each, left - bins * each
            used = full + (1 if rest else 0)
            put_back(remaining, first + used, n - used)
    return runs


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, key: str = "doc_id") -> DataFrame:
    """(key, piece, start, length, ids): documents' ids with the end id, those over `capacity` cut so that only the first piece is shorter.

    Null and empty texts are one piece that holds the end id.
    """
    encoded = encode_documents(docs, tokenizer, end_id, key).withColumn("__n", (F.octet_length("ids") / 4).cast("long"))
    first = (F.col("__n") - 1) % capacity + 1
    cut = encoded.withColumn("piece", F.explode(F.sequence(F.lit(0), F.ceil(F.col("__n") / capacity).cast("int") - 1)))
    start = F.when(F.col("piece") == 0, F.lit(0)).otherwise(first + (F.col("piece") - 1) * capacity).cast("long")
    length = F.when(F.col("piece") == 0, first).otherwise(F.lit(capacity)).cast("long")
    return cut.select(
        key, "piece", start.alias("start"), length.alias("length"), F.substring("ids", start.cast("int") * 4 + 1, length.cast("int") * 4).alias("ids")
    )


def best_fit_pack(pieces: DataFrame, key: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """All columns of `pieces` (needs `key` and length) with sequence_id and offset.

    Pieces without a length, of length 0 or less or over the capacity get neither. Equal rows are pieces of their own; an empty table gives
    an empty result. Columns with these names in `pieces` are replaced.
    """
    kept = stored(pieces.drop("sequence_id", "offset"))
    fits = F.coalesce(F.col("length").between(1, capacity), F.lit(False))
    counts = {row["length"]: row["count"] for row in kept.filter(fits).groupBy("length").count().collect()}
    runs = sorted(pack_histogram(counts, capacity))
    schema = kept.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).schema
    if not runs:
        return kept.withColumns({"sequence_id": F.lit(None).cast("long"), "offset": F.lit(None).cast("long")})

    sizes = F.create_map(*[F.lit(x) for length, n in counts.items() for x in (int(length), groups_for(n, SLOT_GROUP_ROWS))])
    ties = [f"`{c}`" for c, kind in kept.dtypes if c not in (key, "length") and not kind.startswith(("map", "variant"))]
    ranked = with_slots(kept.filter(fits), "length", key, F.element_at(sizes, F.col("length").cast("int")), ties=ties, slot="__rank")
    # Runs as one table of numbers, in order of (length, first rank).
    plan = np.array(runs, np.int64)
    starts = plan[:, 0] << 44 | plan[:, 1]

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rank, length = batch.pop("__rank").to_numpy(np.int64), batch["length"].to_numpy(np.int64)
            run = plan[np.searchsorted(starts, length << 44 | rank, "right") - 1]
            within = rank - run[:, 1]
            batch["sequence_id"] = run[:, 3] + within // run[:, 4]
            batch["offset"] = run[:, 5] + within % run[:, 4] * length
            yield batch[schema.names]

    unplaced = kept.filter(~fits).withColumns({"sequence_id": F.lit(None).cast("long"), "offset": F.lit(None).cast("long")})
    return ranked.select(*kept.columns, "__rank").mapInPandas(place, schema).unionByName(unplaced)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, n_tokens): the packed pieces' ids in their places. A sequence holds at most `capacity` ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = packed.filter("sequence_id IS NOT NULL").groupBy("sequence_id").agg(parts.alias("parts"))
    ids = F.aggregate("parts", F.lit(b"").cast("binary"), lambda done, part: F.concat(done, part["ids"]))
    return joined.select("sequence_id", ids.alias("ids")).withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long"))


def op10_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = token_pieces(docs, public_tokenizers.path(TOKENIZER), END_ID)
    digested = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return best_fit_pack(digested).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
