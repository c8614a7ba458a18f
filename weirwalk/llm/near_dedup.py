"""Near-duplicate documents by HyperMinHash sketches, banding and exact checks.

1. A document's distinct word shingles are hashed to 64 bits. The top bits choose one of 512 buckets; of the smallest remainder in a bucket
   its register keeps the count of leading zeros and the ten bits after the leading one: 16 bits instead of 55. An empty bucket
   takes the register of the filled bucket that comes first in a fixed random order of its own, so registers agree with probability J
   for small sets too.
2. Documents with equal sets are one class, represented by its smallest id. Only representatives go on.
3. Bands of eight registers are candidates' keys. At J = 0.8 all 64 bands differ with probability 8e-6, at 0.85 with 2e-9.
4. Within the documents of one band key, each is compared with one centre only (a star): as many pairs as documents. Registers that
   agree give an estimate of J, corrected for registers that agree by chance; pairs clearly under the limit (six standard
   deviations) end here. The others are checked on their full sets.
5. Links give components. Documents of one centre that are in different components after that are compared with each other too, blocks of
   bounded size against blocks, on full sets; these pairs are never written out, only the links among them. So no link between
   documents that share a band key is lost.

Links never leave Spark, and no group is collected: a band key's group takes part in a window (a count) and joins.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weirwalk.llm.common import stored, table
from weirwalk.llm.components import components

REGISTERS, MANTISSA_BITS, BAND_REGISTERS = 512, 10, 8
BANDS = REGISTERS // BAND_REGISTERS
#: Linked from so many hundredths of the union on.
LEAST_SHARED = 80
#: Standard deviations by which an estimate may fall short before a pair is given up.
DEVIATIONS = 6.0
#: Documents of one centre that meet as a block, and shingles that are counted at once.
BLOCK_ROWS, _COLUMNS = 192, 8192
_BUCKET_BITS = REGISTERS.bit_length() - 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_hashes(text: str | None, words_each: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles: all runs of `words_each` words, A-Z in lower case; all words at once if there are fewer."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.array([xxhash.xxh64_intdigest(word) for word in words], np.uint64)
    each = min(words_each, len(words))
    n = len(words) - each + 1
    shingles = np.full(n, each, np.uint64)
    for i in range(each):
        shingles = _mixed(shingles * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n])
    return np.unique(shingles)


@lru_cache(maxsize=1)
def _orders() -> np.ndarray:
    """Each bucket's order of all buckets, as random numbers."""
    return _mixed(np.arange(1, REGISTERS * REGISTERS + 1, dtype=np.uint64)).astype(np.uint32).reshape(REGISTERS, REGISTERS)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """512 registers of 16 bits of a set that isn't empty, given as sorted hashes."""
    buckets = (shingles >> np.uint64(64 - _BUCKET_BITS)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1]])
    rest = shingles[first] << np.uint64(_BUCKET_BITS)
    # The exponent of a float is the place of the leading one; 53 bits are enough for ten after it.
    zeros = np.minimum(64 - np.frexp((rest | np.uint64(1)).astype(np.float64))[1], 63)
    zeros = np.maximum(zeros, 0)
    after = (rest << (zeros + 1).astype(np.uint64)) >> np.uint64(64 - MANTISSA_BITS)
    values = (zeros.astype(np.uint64) << np.uint64(MANTISSA_BITS) | after).astype(np.uint16)
    filled = buckets[first]
    registers = np.empty(REGISTERS, np.uint16)
    registers[filled] = values
    if len(filled) < REGISTERS:
        empty = np.setdiff1d(np.arange(REGISTERS), filled, assume_unique=True)
        registers[empty] = values[_orders()[empty][:, filled].argmin(axis=1)]
    return registers


def band_keys(registers: np.ndarray) -> np.ndarray:
    """(sketches, 512) registers → (sketches, 64) keys, which hold the band's number."""
    parts = np.ascontiguousarray(registers).view(np.uint64).reshape(len(registers), BANDS, -1)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2])
    for i in range(parts.shape[2]):
        keys = _mixed(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return keys.view(np.int64)


def estimates(a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimates for pairs of sketches, and how far they may be off. sizes: the smaller set of each pair.

    Registers of different minima agree if their leading zeros do, which the sketches' own shares of each count tell, and then their ten bits.
    """
    agree = (a == b).mean(axis=1)
    shares = [np.stack([(x >> MANTISSA_BITS == z).mean(axis=1) for z in range(64)], axis=1) for x in (a, b)]
    chance = (shares[0] * shares[1]).sum(axis=1) / 2**MANTISSA_BITS
    independent = REGISTERS * -np.expm1(-sizes / REGISTERS)
    limit = LEAST_SHARED / 100
    return (agree - chance) / (1 - chance), DEVIATIONS * np.sqrt(limit * (1 - limit) * (1 / REGISTERS + 1 / independent))


def _sketched(docs: DataFrame, key: str, text: str, words_each: int) -> DataFrame:
    """(id, n, print, sketch): print tells sets apart (128 bits)."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, prints, sketches = [], [], []
            for value in batch.column(1):
                shingles = shingle_hashes(value.as_py(), words_each)
                sizes.append(len(shingles))
                prints.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                sketches.append(sketch(shingles).tobytes() if len(shingles) else None)
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "print", "sketch"])

    rows = docs.select(F.col(key).cast("long"), text).filter(F.col(key).isNotNull())
    return rows.mapInArrow(make, "id bigint, n bigint, print binary, sketch binary")


def _banded(classes: DataFrame) -> DataFrame:
    """(band, id, n) for each class and band."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, len(batch), 512):
                part = batch.slice(first, 512)
                keys = band_keys(np.frombuffer(b"".join(part.column(2).to_pylist()), np.uint16).reshape(len(part), REGISTERS))
                ids, n = (np.repeat(part.column(i).to_numpy(), BANDS) for i in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(ids), pa.array(n)], names=["band", "id", "n"])

    return classes.select("id", "n", "sketch").mapInArrow(make, "band bigint, id bigint, n bigint")


def _compared(pairs: DataFrame, classes: DataFrame, texts: DataFrame, words_each: int) -> DataFrame:
    """(a, b) → (a, b, j, slack, linked): j is exact and slack 0, or j is an estimate that is off by slack at most and clearly under the limit."""
    one = classes.select("id", "n", "sketch")
    sketched = pairs.hint("merge").join(one.toDF("a", "n_a", "sketch_a"), "a").join(one.toDF("b", "n_b", "sketch_b").hint("merge"), "b")

    def guess(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, len(batch), 512):
                part = batch.slice(first, 512)
                a, b = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint16).reshape(len(part), REGISTERS) for c in ("sketch_a", "sketch_b"))
                n_a, n_b = (part.column(c).to_numpy() for c in ("n_a", "n_b"))
                j, slack = estimates(a, b, np.minimum(n_a, n_b))
                small, large = np.minimum(n_a, n_b), np.maximum(n_a, n_b)
                maybe = (j + slack >= LEAST_SHARED / 100) & (100 * small >= LEAST_SHARED * large)
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(j), pa.array(slack), pa.array(maybe)], names=["a", "b", "j", "slack", "maybe"])

    guessed = stored(sketched.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(guess, "a bigint, b bigint, j double, slack double, maybe boolean"))
    maybe = guessed.filter("maybe").select("a", "b")
    with_texts = maybe.hint("merge").join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b").hint("merge"), "b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = lru_cache(maxsize=64)(lambda value: shingle_hashes(value, words_each))
        for batch in batches:
            j, linked = [], []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = hashes(x), hashes(y)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                union = len(x) + len(y) - shared
                j.append(shared / union)
                linked.append(100 * shared >= LEAST_SHARED * union)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(j, pa.float64()), pa.array(linked, pa.bool_())], names=["a", "b", "j", "linked"])

    checked = with_texts.select("a", "b", "text_a", "text_b").mapInArrow(check, "a bigint, b bigint, j double, linked boolean")
    checked = checked.select("a", "b", "j", F.lit(0.0).alias("slack"), "linked")
    return stored(guessed.filter("NOT maybe").select("a", "b", "j", "slack", F.lit(False).alias("linked")).unionByName(checked))


def _open_links(spokes: DataFrame, found: DataFrame, texts: DataFrame, words_each: int) -> DataFrame:
    """Links (a, b) between documents that hang on the same centre but are in different components so far.

    Documents of a centre are dealt into blocks of bounded size, and each pair of blocks meets in one group, where common shingles of all
    pairs are counted on full sets. Only links come out, never the pairs.
    """
    members = spokes.select(F.col("a").alias("centre"), F.col("b").alias("id"), "j", "slack")
    members = members.join(found.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    split = members.groupBy("centre").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n")).filter("low < high")
    members = members.join(split.select("centre", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks")), "centre")
    members = members.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    members = stored(members.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("other", "blocks"))

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["block", "id"], ignore_index=True)
        sets = [shingle_hashes(value, words_each) for value in rows["text"]]
        sizes = np.array([len(x) for x in sets])
        known, at = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(len(sets)), sizes)
        shared = np.zeros((len(sets), len(sets)), np.float32)
        # Common counts as products of 0/1 matrices, some thousand shingles at a time.
        order = np.argsort(at, kind="stable")
        owner, at = owner[order], at[order]
        for start in range(0, len(known), _COLUMNS):
            part = slice(*np.searchsorted(at, (start, start + _COLUMNS)))
            has = np.zeros((len(sets), _COLUMNS), np.float32)
            has[owner[part], at[part] - start] = 1
            shared += has @ has.T
        union = sizes[:, None] + sizes[None, :] - shared
        x, y = np.nonzero(np.triu(100 * shared >= LEAST_SHARED * union, 1))
        ids, component, block = (rows[c].to_numpy() for c in ("id", "component", "block"))
        new = (component[x] != component[y]) & ((block[x] != block[y]) | (rows["low"].iloc[0] == rows["high"].iloc[0]))
        return pd.DataFrame({"a": ids[x[new]], "b": ids[y[new]]})

    return members.hint("merge").join(texts, "id").groupBy("centre", "low", "high").applyInPandas(count, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, words_each: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id, kept) for every row of `docs`.

    Documents are linked if their sets of distinct `words_each`-word shingles share 80 of 100 parts of their union or more; component_id is the
    smallest key that links lead to, kept says whether that is the row's own. Null and empty texts and such without words have no
    shingles and no links. Rows with the same key are one document. Rows with a null key have no component and are kept. An
    empty table gives an empty result. The key is an integer; other columns of `docs` are ignored.
    """
    sketched = stored(_sketched(docs, key, text, words_each))
    # Copies meet by the set's print; the map side leaves one row of each.
    classes = stored(sketched.filter("n > 0").groupBy("print").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("sketch").alias("sketch")))
    group = Window.partitionBy("band")
    banded = stored(_banded(classes).withColumn("size", F.count("*").over(group)).filter("size > 1"))
    # The centre of a band key is the document that meets the most others; copies with changes meet their origin more often than each other.
    met = banded.groupBy("id").agg((F.sum("size") - F.count("*")).alias("met"))
    best = banded.join(met, "id").groupBy("band").agg(F.max(F.struct("met", (-F.col("id")).alias("rank"))).alias("best"))
    stars = banded.join(best.select("band", (-F.col("best.rank")).alias("centre")), "band")
    spokes = stored(stars.filter("id <> centre").select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct())
    # The texts of all that share a band key, shuffled once; these ids grow with the data, so they are merged in and not broadcast.
    ends = spokes.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    texts = stored(texts.join(ends.hint("merge"), "id", "left_semi"))
    first = _compared(spokes, classes, texts, words_each)
    found = stored(components(first.filter("linked")))
    rest = stored(_open_links(first, found, texts, words_each))
    if not rest.isEmpty():
        found = stored(components(rest.unionByName(found.select(F.col("node").alias("a"), F.col("component").alias("b")))))

    labels = classes.select("print", F.col("id").alias("class")).join(found.withColumnRenamed("node", "class"), "class", "left")
    labels = labels.select("print", F.coalesce("component", "class").alias("component"))
    key_type = docs.schema[key].dataType
    rows = sketched.select("id", "n", "print").join(labels, "print", "left").withColumn("component", F.coalesce("component", "id"))
    labelled = rows.select(
        F.col("id").cast(key_type).alias(key), F.col("n").alias("n_shingles"), F.col("component").cast(key_type).alias("component_id"), (F.col("id") == F.col("component")).alias("kept")
    )
    unknown = {"n_shingles": F.lit(None).cast("long"), "component_id": F.lit(None).cast(key_type), "kept": F.lit(True)}
    return labelled.unionByName(docs.filter(F.col(key).isNull()).select(key).withColumns(unknown))


def without_near_duplicates(docs: DataFrame, words_each: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with one document of each component, the one with the smallest key. Rows with null keys stay.

    Where keys repeat, rows are judged and dropped one by one: a row goes only if a linked one with a smaller key, or the same key, stays.
    """
    known = docs.filter(F.col(key).isNotNull())
    if known.groupBy(key).count().filter("count > 1").isEmpty():
        dropped = near_duplicates(docs, words_each, key, text).filter("NOT kept").select(key)
        return docs.join(dropped.hint("merge"), key, "left_anti").select(docs.columns)
    # Numbers in the order of the keys, written once: a rerun may cut the ranges elsewhere.
    order = [F.col(key), F.xxhash64(text)]
    rows = stored(known.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__row", F.monotonically_increasing_id()))
    dropped = near_duplicates(rows.select("__row", text), words_each, "__row", text).filter("NOT kept").select("__row")
    kept = rows.join(dropped.hint("merge"), "__row", "left_anti").select(docs.columns)
    return kept.unionByName(docs.filter(F.col(key).isNull()))


def op7_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), words_each=2)
