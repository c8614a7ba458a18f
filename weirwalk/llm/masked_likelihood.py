"""Scores of whole texts by masked pseudo-likelihood: each word is predicted from the words on both sides of it.

P(word | both sides) = P(class | window), from a neural network, times P(word | class), from counts.

1. Words (A-Z in lower case) are counted over all documents. Frequent ones are classes of their own; all others, seen or not, fall into classes by their
   spelling: pairs of neighbouring bytes are hashed, weighted by rarity, and clustered over the most frequent words. The counts of these words are broadcast;
   those of all other words, and of all pairs of neighbours, stay in a distributed table that grows with the corpus.
2. Each word's window is two words to the left and two to the right: frequent words and groups of spellings for the nearer ones, coarser groups for the others.
   How often each class stands in each window is counted over all words of all documents; that table, not a sample, is what the network learns from.
3. The network adds up an embedding for each of the four places, applies tanh and predicts the class by softmax. numpy trains it on the
   driver, by full passes over the table.
4. P(class | window) times P(word | class) is the prior of a word. The counts of the word behind its left neighbour, then before its right one, sharpen it:
   P1 = (c(left, word) + s * prior) / (n(left) + s), P = (c(word, right) + s * P1) / (n(right) + s), each a distribution over all words. The strength s
   is the one of `STRENGTHS` under which the corpus is likeliest, every word masked in turn: where neighbours tell little, the network decides.
5. What the masked place adds to the counts of words and pairs is taken out; so a pair that stands nowhere else tells nothing. The weights of the network and
   of the spellings have seen it: they are too few to hold single places.
6. Groups of rows ask for the counts of their own words and pairs, as sorted keys dealt to ranges of keys; each range adds up and answers with counts in the
   order asked, and every document sums over its words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType

from weirwalk.llm.common import stored, table

VOCABULARY = 32768
#: Words that are classes of their own, as what is predicted and as near neighbours.
OWN_CLASS, OWN_NEAR = 96, 24
#: Classes of spelling of the other words: as what is predicted, as near neighbours, and two places away.
SPELLINGS, NEAR_SPELLINGS, FAR_SPELLINGS = 64, 15, 3
CLASSES, NEAR, FAR = OWN_CLASS + SPELLINGS, OWN_NEAR + NEAR_SPELLINGS + 1, FAR_SPELLINGS + 1
WINDOWS = FAR * NEAR * NEAR * FAR
#: Hashed pairs of bytes: 2 to this power; clustering rounds.
PAIR_BITS, ROUNDS = 9, 12
HIDDEN, PASSES = 32, 80
#: How many counted neighbours weigh as much as the prior: those to choose from.
STRENGTHS = (4.0, 64.0, 1024.0, 16384.0, 262144.0)
#: Rows that ask for counts together: 2 to this power.
GROUP_BITS = 10
#: A text of more bytes asks alone.
BIG_TEXT = 1 << 16
#: Words of the corpus for each range of keys; a range is added up at once.
RANGE_WORDS = 1 << 20
#: Stands for a text's edge; no word holds a space.
_EDGE = b" "
_LEFT_FACTOR, _RIGHT_FACTOR = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_FLUSH_WORDS, _BLOCK_CHARS = 200_000, 1 << 22
#: Longer words are spelled one by one; others together, so many at once. Weights of spellings are whole numbers of this part.
_LONG_WORD, _BLOCK_WORDS, _PART = 1024, 4096, 4096


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n) over all documents; tasks add up before they send."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for value in batch.column(0):
                found.update(words_of(value.as_py()))
                if len(found) > _FLUSH_WORDS:
                    yield out()
                    found.clear()
        yield out()

    return docs.select(text).mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def byte_pairs(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashed pairs of neighbouring bytes of all words, with a blank at both ends, and where each word's begin."""
    data = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint32)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    return (data[:-1] * np.uint32(0x9E3779B1) + data[1:] * np.uint32(0x85EBCA6B)) >> np.uint32(32 - PAIR_BITS), np.append(0, ends[:-1])


class Spelling(NamedTuple):
    """Weights of hashed pairs for each class of spelling, whole numbers, so that sums are the same in any order; the classes' groups as neighbours."""

    weights: np.ndarray
    near: np.ndarray
    far: np.ndarray

    def of(self, words: list[bytes]) -> np.ndarray:
        sizes, out = np.fromiter(map(len, words), np.int64, len(words)), np.zeros(len(words), np.int64)
        for i in np.flatnonzero(sizes > _LONG_WORD).tolist():
            out[i] = (np.bincount(byte_pairs([words[i]])[0], minlength=1 << PAIR_BITS) @ self.weights.astype(np.int64)).argmax()
        # By falling length, so that those with one more pair are the first ones of a block.
        short = np.flatnonzero(sizes <= _LONG_WORD)
        short = short[np.argsort(-sizes[short], kind="stable")]
        for first in range(0, len(short), _BLOCK_WORDS):
            part = short[first : first + _BLOCK_WORDS]
            pairs, starts = byte_pairs([words[i] for i in part.tolist()])
            total = np.zeros((len(part), SPELLINGS), np.int32)
            for k, n in enumerate(np.cumsum(np.bincount(sizes[part])[::-1])[::-1].tolist()):
                # n words have k bytes or more, and so a pair number k.
                total[:n] += self.weights.take(pairs[starts[:n] + k], axis=0)
            out[part] = total.argmax(axis=1)
        return out


def clusters(rows: np.ndarray, weights: np.ndarray, k: int) -> np.ndarray:
    """k unit centres of unit vectors, by cosine; the first ones are spread over the order of the rows."""
    centres = rows[np.linspace(0, len(rows) - 1, k).astype(np.int64)]
    for _ in range(ROUNDS):
        at = (rows @ centres.T).argmax(axis=1)
        sums = ((at == np.arange(k)[:, None]) * weights).astype(np.float32) @ rows
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 0, sums / np.maximum(norms, 1e-9), centres)
    return centres


def learn_spelling(words: list[bytes], counts: np.ndarray) -> Spelling:
    """From the most frequent words and their counts, in descending order."""
    if not words:
        return Spelling(np.zeros((1 << PAIR_BITS, SPELLINGS), np.int32), np.zeros(SPELLINGS, np.int64), np.zeros(SPELLINGS, np.int64))
    pairs, starts = byte_pairs(words)
    rows = np.zeros((len(words), 1 << PAIR_BITS), np.float32)
    np.add.at(rows, (np.repeat(np.arange(len(words)), np.diff(np.append(starts, len(pairs)))), pairs), 1)
    rarity = np.log((len(words) + 1) / ((rows > 0).sum(axis=0) + 0.5)).astype(np.float32)
    rows *= rarity
    rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)
    centres = clusters(rows, np.sqrt(counts), SPELLINGS)
    weights = np.rint(rarity[:, None] * centres.T * _PART).astype(np.int32)
    mass = np.bincount((rows @ centres.T).argmax(axis=1), counts, SPELLINGS)
    order = np.argsort(-mass, kind="stable")
    near, far = [(centres @ clusters(centres[order], mass[order], k).T).argmax(axis=1) for k in (NEAR_SPELLINGS, FAR_SPELLINGS)]
    return Spelling(weights, near, far)


class Codes(NamedTuple):
    """Of each word: its rank (-1 outside the broadcast words), its class, and what it is as a near and as a far neighbour (0: a text's edge)."""

    rank: np.ndarray
    target: np.ndarray
    near: np.ndarray
    far: np.ndarray


class Classes(NamedTuple):
    """The broadcast words' ranks, their spellings and counts; of each class, over all words: the sum of counts, the words, and those that stand once."""

    ranks: dict[bytes, int]
    spelling: Spelling
    spelled: np.ndarray
    counts: np.ndarray
    in_class: np.ndarray
    types: np.ndarray
    once: np.ndarray

    def codes(self, words: list[bytes]) -> Codes:
        rank = np.fromiter(map(self.ranks.get, words, [-1] * len(words)), np.int64, len(words))
        outside = np.flatnonzero(rank < 0)
        spelled = np.append(self.spelled, 0)[rank]
        spelled[outside] = self.spelling.of([words[i] for i in outside.tolist()])
        own = lambda n: (rank >= 0) & (rank < n)
        near = np.where(own(OWN_NEAR), rank, OWN_NEAR + self.spelling.near[spelled])
        return Codes(rank, np.where(own(OWN_CLASS), rank, OWN_CLASS + spelled), near + 1, self.spelling.far[spelled] + 1)

    def within(self, codes: Codes, n: np.ndarray | None = None, masked: int = 0) -> np.ndarray:
        """P(word | class) from counts `n` (those of the broadcast words, if none), `masked` of them taken out. New words have as much as words that stand once."""
        n = np.append(self.counts, 0)[codes.rank] if n is None else n
        at, new = codes.target, self.once[codes.target] + 1
        return np.where(at < OWN_CLASS, 1.0, (n - masked + new / (self.types[at] + 1)) / (self.in_class[at] - masked + new))


def windows(near: np.ndarray, far: np.ndarray) -> np.ndarray:
    """The number of the window of each place in a row of words. Outside it are edges; texts in one row have two edges between them."""
    n, one, two = len(near), np.pad(near, 1), np.pad(far, 2)
    return ((two[:n] * NEAR + one[:n]) * NEAR + one[2:]) * FAR + two[4:]


def learn_classes(counts: DataFrame) -> Classes:
    """From all word counts: the VOCABULARY most frequent words, their clusters of spelling, and sums over all words by class."""
    top = counts.orderBy(F.desc("n"), "word").limit(VOCABULARY).toPandas()
    words, n = [bytes(word) for word in top["word"]], top["n"].to_numpy(np.float64)
    spelling, none = learn_spelling(words, n), np.zeros(CLASSES)
    classes = Classes({word: rank for rank, word in enumerate(words)}, spelling, spelling.of(words), n, none, none, none)
    shared = counts.sparkSession.sparkContext.broadcast(classes)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, CLASSES), np.int64)
        for batch in batches:
            n, at = batch.column("n").to_numpy(), shared.value.codes(batch.column("word").to_pylist()).target
            for row, values in zip(total, (n, n > 0, n == 1), strict=True):
                row += np.bincount(at, values, CLASSES).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES)), *map(pa.array, total)], names=["class", "n", "types", "once"])

    sums = counts.select("word", "n").mapInArrow(add_up, "class bigint, n bigint, types bigint, once bigint").groupBy("class").agg(*[F.sum(name).alias(name) for name in ("n", "types", "once")]).toPandas()
    found = np.zeros((3, CLASSES))
    found[:, sums["class"].to_numpy(np.int64)] = sums[["n", "types", "once"]].to_numpy(np.float64).T
    return classes._replace(in_class=found[0], types=found[1], once=found[2])


class Numbered(NamedTuple):
    """Texts with words: for each its number and how many words; the distinct words (the edge first), and all texts' numbers of them with edges."""

    texts: list[tuple[int, int]]
    distinct: list[bytes]
    places: np.ndarray

    def codes(self, classes: Classes) -> Codes:
        codes = classes.codes(self.distinct)
        codes.near[0] = codes.far[0] = 0
        return codes

    def keys(self) -> np.ndarray:
        """64-bit keys of the distinct words."""
        return np.fromiter(map(xxhash.xxh3_64_intdigest, self.distinct), np.uint64, len(self.distinct))

    def pairs(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys of all neighbours in `places`, and which are within a text."""
        at = keys[self.places]
        return at[:-1] * _LEFT_FACTOR + at[1:] * _RIGHT_FACTOR, (self.places[:-1] > 0) | (self.places[1:] > 0)

    def sums(self, values: np.ndarray, count: int) -> np.ndarray:
        """Of `count` texts, the sums of their words' values, which come in the order of the words."""
        out, sizes = np.zeros(count), np.array([size for _, size in self.texts], np.int64)
        if len(sizes):
            out[[number for number, _ in self.texts]] = np.add.reduceat(values, np.cumsum(sizes) - sizes)
        return out

    def sizes(self, count: int) -> np.ndarray:
        out = np.zeros(count, np.int64)
        for number, size in self.texts:
            out[number] = size
        return out


def numbered(values: list[str | None]) -> Numbered:
    seen: dict[bytes, int] = {_EDGE: 0}
    texts, places = [], []
    for number, value in enumerate(values):
        if words := words_of(value):
            texts.append((number, len(words)))
            places += [0, *[seen.setdefault(word, len(seen)) for word in words], 0]
    return Numbered(texts, list(seen), np.array(places, np.int64))


def blocks(column: pa.Array) -> Iterator[list[str | None]]:
    """The texts of a column, some at a time."""
    waiting, size = [], 0
    for value in column:
        waiting.append(value.as_py())
        size += len(waiting[-1] or "")
        if size > _BLOCK_CHARS:
            yield waiting
            waiting, size = [], 0
    yield waiting


def window_counts(docs: DataFrame, classes: Classes, text: str = "text") -> np.ndarray:
    """How often each class stands in each window, over all words of all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(classes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(WINDOWS * CLASSES, np.int64)
        for batch in batches:
            for values in blocks(batch.column(0)):
                part = numbered(values)
                if part.texts:
                    codes, at = part.codes(shared.value), part.places
                    cells = windows(codes.near[at], codes.far[at]) * CLASSES + codes.target[at]
                    total += np.bincount(cells[at > 0], minlength=len(total))
        cells = np.flatnonzero(total)
        for first in range(0, len(cells), 1 << 16):
            part = cells[first : first + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], names=["cell", "n"])

    cells = docs.select(text).mapInArrow(count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(WINDOWS * CLASSES)
    out[cells["cell"].to_numpy(np.int64)] = cells["n"]
    return out.reshape(WINDOWS, CLASSES)


class Network:
    """Embeddings for the four places of a window, added up, tanh, and a softmax over classes."""

    def __init__(self, seed: int = 3, kind: type = np.float32):
        rng = np.random.default_rng(seed)
        self.sizes = (FAR, NEAR, NEAR, FAR)
        weights = [rng.normal(0, 0.3, (size, HIDDEN)) for size in self.sizes] + [np.zeros(HIDDEN), rng.normal(0, 0.3, (HIDDEN, CLASSES)), np.zeros(CLASSES)]
        self.weights = [weight.astype(kind) for weight in weights]

    def _forward(self, places: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
        *embeddings, bias, out, out_bias = self.weights
        hidden = np.tanh(sum(embedding[at] for embedding, at in zip(embeddings, places, strict=True)) + bias)
        logits = hidden @ out + out_bias
        logits -= logits.max(axis=1, keepdims=True)
        logits -= np.log(np.exp(logits).sum(axis=1, keepdims=True))
        return hidden, logits

    def log_probabilities(self) -> np.ndarray:
        """log P(class | window) for every window, (WINDOWS, CLASSES)."""
        return self._forward(np.unravel_index(np.arange(WINDOWS), self.sizes))[1]

    def gradients(self, counts: np.ndarray, at: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """The mean loss per counted word, and its gradients, from the counts of the windows with the numbers `at`."""
        total, places = max(counts.sum(dtype=np.float64), 1.0), np.unravel_index(at, self.sizes)
        hidden, log_p = self._forward(places)
        loss = -(counts * log_p).sum(dtype=np.float64) / total
        d_logits = (np.exp(log_p) * counts.sum(axis=1, keepdims=True) - counts) / self.weights[0].dtype.type(total)
        d_hidden = (d_logits @ self.weights[5].T) * (1 - hidden**2)
        # Sums by the class at each place, as products with 0/1 matrices.
        each = [(np.arange(size)[:, None] == place).astype(d_hidden.dtype) @ d_hidden for size, place in zip(self.sizes, places, strict=True)]
        return loss, [*each, d_hidden.sum(axis=0), hidden.T @ d_logits, d_logits.sum(axis=0)]

    def train(self, counts: np.ndarray, passes: int = PASSES, rate: float = 0.1) -> list[float]:
        """Adam over the whole table; the losses on the way."""
        kind = self.weights[0].dtype
        self.weights[6] = np.log((counts.sum(axis=0) + 1) / (counts.sum() + CLASSES)).astype(kind)
        at = np.flatnonzero(counts.any(axis=1))
        counts = counts[at].astype(kind)
        first, second, losses = [np.zeros_like(w) for w in self.weights], [np.zeros_like(w) for w in self.weights], []
        for step in range(1, passes + 1):
            loss, gradients = self.gradients(counts, at)
            losses.append(loss)
            now = rate * (1 - (step - 1) / passes) ** 0.5
            for weight, g, m, v in zip(self.weights, gradients, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                weight -= now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
        return losses


class MaskedModel(NamedTuple):
    classes: Classes
    log_p: np.ndarray


def fit(docs: DataFrame, text: str = "text") -> MaskedModel:
    classes = learn_classes(stored(word_counts(docs, text)))
    network = Network()
    network.train(window_counts(docs, classes, text))
    return MaskedModel(classes, network.log_probabilities().astype(np.float32).ravel())


def score_documents(docs: DataFrame, model: MaskedModel, text: str = "text") -> DataFrame:
    """All columns of `docs` with n_words, log_likelihood (summed over the words) and word_log_likelihood (its mean).

    For texts outside the corpus: the network and the broadcast words only, without neighbours' counts.
    Null and empty texts and such without words have a sum of 0 and no mean. Words that the model has not seen have the
    probability of a rare word of their length. Repeated rows score alike; an empty table gives an empty result. Columns of `docs`
    with these names are replaced.
    """
    clean = docs.drop("n_words", "log_likelihood", "word_log_likelihood")
    place = clean.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, log_p = shared.value
        for batch in batches:
            sizes, sums = [], []
            for values in blocks(batch.column(place)):
                part = numbered(values)
                codes, at = part.codes(classes), part.places
                each = log_p[windows(codes.near[at], codes.far[at]) * CLASSES + codes.target[at]] + np.log(classes.within(codes))[at]
                sizes.append(part.sizes(len(values)))
                sums.append(part.sums(each[at > 0], len(values)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(sizes)), pa.array(np.concatenate(sums))], names=[*batch.schema.names, "n_words", "log_likelihood"])

    schema = clean.withColumns({"n_words": F.lit(0).cast("long"), "log_likelihood": F.lit(0.0)}).schema
    scored = clean.mapInArrow(score, schema)
    return scored.withColumn("word_log_likelihood", F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words")))


def asked_keys(part: Numbered, ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """The keys of all pairs and of the words that are not broadcast, ascending, and how often each is here."""
    own = part.keys()
    pairs, inside = part.pairs(own)
    keys, n = np.unique(pairs[inside], return_counts=True)
    outside = np.fromiter((word not in ranks for word in part.distinct), bool, len(part.distinct))
    of_words = np.bincount(part.places, minlength=len(outside))
    of_words[0] = len(part.texts)
    keys, n = np.append(keys, own[outside]), np.append(n, of_words[outside])
    order = np.argsort(keys, kind="stable")
    return keys[order], n[order]


def _planes(values: np.ndarray) -> bytes:
    """Numbers byte by byte, so that the bytes that are mostly 0 lie together for the shuffle's compression."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()


def _numbers(planes: bytes, kind: type) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view(kind).ravel()


def neighbour_counts(rows: DataFrame, classes: Classes, text: str) -> DataFrame:
    """(group, range, mark, counts): to each group of rows, the counts over all rows of its keys (`asked_keys`) in the range, and the sum of these keys."""
    shared = rows.sparkSession.sparkContext.broadcast(classes.ranks)
    ranges = max(32, int(classes.in_class.sum() // RANGE_WORDS))
    edges = np.array([(i << 64) // ranges for i in range(1, ranges)], np.uint64)

    def rows_of(group: int, texts: list[str | None]) -> Iterator[pa.RecordBatch]:
        part = numbered(texts)
        if not part.texts:
            return
        keys, n = asked_keys(part, shared.value)
        bounds = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
        filled = [(i, a, b) for i, (a, b) in enumerate(zip(bounds, bounds[1:])) if a < b]
        blobs = [[_planes(np.diff(keys[a:b], prepend=np.uint64(0))), _planes(n[a:b].astype(np.int64))] for _, a, b in filled]
        arrays = [pa.array([group] * len(filled), pa.int64()), pa.array([i for i, _, _ in filled], pa.int64()), *[pa.array(x, pa.binary()) for x in zip(*blobs)]]
        yield pa.RecordBatch.from_arrays(arrays, names=["group", "range", "keys", "n"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come in order, and a group is never in two tasks; it may be in two batches. A big text (below 0) is a group of its own.
        now, waiting = -1, []
        for batch in batches:
            for group, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if group < 0:
                    yield from rows_of(group, [value.as_py()])
                    continue
                if group != now:
                    yield from rows_of(now, waiting)
                    now, waiting = group, []
                waiting.append(value.as_py())
        yield from rows_of(now, waiting)

    def add_up(given: pa.Table) -> pa.Table:
        keys = [np.cumsum(_numbers(x, np.uint64), dtype=np.uint64) for x in given.column("keys").to_pylist()]
        _, place = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(place, np.concatenate([_numbers(x, np.int64) for x in given.column("n").to_pylist()])).astype(np.int64)[place]
        ends = np.cumsum([len(x) for x in keys])
        counts = [_planes(total[end - len(x) : end]) for x, end in zip(keys, ends, strict=True)]
        marks = np.array([x.sum(dtype=np.uint64) for x in keys], np.uint64).view(np.int64)
        return pa.Table.from_arrays([given.column("group"), given.column("range"), pa.array(marks), pa.array(counts, pa.binary())], names=["group", "range", "mark", "counts"])

    asked = rows.select("__group", text).mapInArrow(ask, "group bigint, range bigint, keys binary, n binary")
    return asked.groupBy("range").applyInArrow(add_up, "group bigint, range bigint, mark bigint, counts binary")


def score_corpus(docs: DataFrame, text: str = "text", columns: list[str] | None = None) -> DataFrame:
    """All `columns` of `docs` (every one, if not named) with n_words, log_likelihood and word_log_likelihood (as score_documents), learnt from the same rows,
    every word masked in turn.

    `docs` is read twice and has to give its rows in the same order, as a scan of files does; other orders fail. The scores under all strengths are stored
    with the columns, and those of the strength under which all documents together are likeliest (the smaller one, if two are) are returned.
    """
    made = ("n_words", "log_likelihood", "word_log_likelihood")
    clean = docs.drop(*made)
    columns = [name for name in (columns or clean.columns) if name not in made]
    row = F.col("__row")
    rows = clean.withColumn("__row", F.monotonically_increasing_id())
    rows = rows.withColumn("__group", F.when(F.octet_length(text) > BIG_TEXT, -1 - row).otherwise(F.shiftright(row, GROUP_BITS))).drop("__row")
    model = fit(clean, text)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(given: pa.Table, answers: pa.Table) -> pa.Table:
        classes, log_p = shared.value
        values = given.column(text).to_pylist()
        part, sums = numbered(values), np.zeros((len(values), len(STRENGTHS)))
        if part.texts:
            asked, _ = asked_keys(part, classes.ranks)
            answer = answers.sort_by("range")
            found = np.concatenate([_numbers(x, np.int64) for x in answer.column("counts").to_pylist()] or [np.zeros(0, np.int64)])
            if len(found) != len(asked) or answer.column("mark").to_numpy().sum() != asked.sum(dtype=np.uint64).view(np.int64):
                raise ValueError("the rows to score were read in another order than those counted; store them first")
            known = lambda keys: found[np.minimum(np.searchsorted(asked, keys), len(asked) - 1)]
            codes, keys, at = part.codes(classes), part.keys(), part.places
            inside = np.flatnonzero(at > 0)
            word, left, right = at[inside], at[inside - 1], at[inside + 1]
            n = np.where(codes.rank >= 0, np.append(classes.counts, 0)[codes.rank], known(keys))
            window = windows(codes.near[at], codes.far[at])[inside]
            prior = np.exp(log_p[window * CLASSES + codes.target[word]].astype(np.float64)) * classes.within(codes, n, 1)[word]
            # The masked place is in two pairs, which may be equal, and its own neighbour's count may hold it.
            pairs, twice = known(part.pairs(keys)[0]), (left == word) & (word == right)
            before, behind = pairs[inside - 1] - 1 - twice, pairs[inside] - 1 - twice
            n_left, n_right = n[left] - 1 - (left == word), n[right] - 1 - (right == word)
            for i, strength in enumerate(STRENGTHS):
                p = (before + strength * prior) / (n_left + strength)
                sums[:, i] = part.sums(np.log((behind + strength * p) / (n_right + strength)), len(values))
        made = [pa.array(part.sizes(len(values))), pa.array(list(sums), pa.list_(pa.field("element", pa.float64())))]
        return pa.Table.from_arrays([*given.select(columns).columns, *made], names=[*columns, "n_words", "__sums"])

    schema = clean.select(columns).schema.add("n_words", LongType()).add("__sums", ArrayType(DoubleType()))
    scored = stored(rows.groupBy("__group").cogroup(neighbour_counts(rows, model.classes, text).groupBy("group")).applyInArrow(score, schema))
    total = scored.agg(*[F.sum(F.get("__sums", F.lit(i))) for i in range(len(STRENGTHS))]).first()
    best = int(np.argmax([value or 0.0 for value in total]))
    scored = scored.select(*columns, "n_words", F.get("__sums", F.lit(best)).alias("log_likelihood"))
    return scored.withColumn("word_log_likelihood", F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words")))


def op2_masked_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_corpus(docs, columns=["doc_id"]).select("doc_id", "n_words", "log_likelihood", "word_log_likelihood")
