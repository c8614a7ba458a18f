"""Byte strings that occur more than once in the corpus, by merging Burrows-Wheeler transforms of shards.

1. Every window of 100 bytes is led by one of its 69 runs of 32 bytes: the one with the smallest hash, the last of equal ones. Equal windows
   have equal leaders, so only windows with equal leaders need to meet. The windows of one leader are neighbours, and one stretch of text
   (100 to 168 bytes) holds them all. Stretches meet by their leaders' hashes, in sorted order, and a leader that occurs once is left.
2. Stretches that are equal as a whole (by a 64-bit print) need no further look: all but the first are repeated. Most are told apart before the
   shuffle, where only the first of a task's equal stretches is dealt by its leader: a passage that stands everywhere leaves a task once.
3. Stretches that share a leader and differ are dealt to groups of bounded size. In a group they form shards. Each shard gets its suffix
   order and its Burrows-Wheeler transform: the symbol before each suffix, where a symbol is the rank of 20 bytes. The transforms are merged by
   refining their interleave, as Holt and McMillan do: an order of the shards' numbers by the first k symbols becomes the one by k + 1 symbols in one
   stable counting sort by the symbols that the transforms hold. Suffixes are never compared or sorted again. The round in which two neighbours part
   is their common prefix; those that have not parted after five rounds share 100 bytes: a repeated interval.
4. A leader with more different stretches than one group may hold (a line that stands in a great many documents) has its windows counted one by
   one, by prints of 128 bits, combined on the map side.
5. The spans of a document, from all of these, are joined to its text.

A window is repeated if an equal one starts in a document with a smaller key or earlier in its own. Judged is always the input.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirwalk.llm.common import groups_for, stored, table

#: Bytes of a window, of a leading run, and of a symbol of the transforms.
WINDOW, LEADER, SYMBOL = 100, 32, 20
_RUNS = WINDOW - LEADER + 1
#: Text that is hashed at once, that a shard holds, and that a group of shards holds, in bytes.
CHUNK, SHARD_BYTES, GROUP_BYTES = 1 << 20, 1 << 16, 3 << 20
#: More different stretches than this go window by window.
MOST_STRETCHES = 1 << 14
_BYTES = np.random.default_rng(12).integers(0, 2**64, 256, np.uint64, endpoint=False)
_STEPS = tuple((1 << i, np.uint64(0x9E3779B97F4A7C15 + 2 * i * 0xBF58476D)) for i in range(LEADER.bit_length() - 1))


def _run_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of 32 bytes."""
    h = _BYTES[data]
    for step, factor in _STEPS:
        h = h[:-step] * factor + h[step:]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def _leaders(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window: its leader's hash and place."""
    least = _run_hashes(data)
    place = np.arange(len(least), dtype=np.int32)
    span = 1
    while span < _RUNS:
        step = min(span, _RUNS - span)
        left, right = least[:-step], least[step:]
        place = np.where(right <= left, place[step:], place[:-step])
        least = np.minimum(left, right)
        span += step
    return least, place


def stretches(texts: list[tuple[int, np.ndarray]]) -> tuple[np.ndarray, ...]:
    """(leader, print, text number, start, length) of the stretches of some texts, given with their numbers, each in parts of bounded size."""
    found: list[tuple[np.ndarray, ...]] = []
    waiting: list[tuple[int, int, np.ndarray]] = []
    size = 0

    def hash_waiting() -> None:
        data = np.concatenate([part for _, _, part in waiting])
        lengths = np.array([len(part) for _, _, part in waiting])
        ends = np.cumsum(lengths)
        if len(data) < WINDOW:
            return
        least, place = _leaders(data)
        at = np.flatnonzero(np.arange(WINDOW, len(data) + 1) <= np.repeat(ends, lengths)[: len(least)])
        if not len(at):
            return
        first = np.flatnonzero(np.r_[True, (place[at[1:]] != place[at[:-1]])])
        low, high = at[first], at[np.r_[first[1:], len(at)] - 1]
        whole = memoryview(data.tobytes())
        prints = [xxhash.xxh3_64_intdigest(whole[a:b]) for a, b in zip(low.tolist(), (high + WINDOW).tolist(), strict=True)]
        part = np.searchsorted(ends, low, "right")
        numbers, offsets = np.array([n for n, _, _ in waiting], np.int64), np.array([o for _, o, _ in waiting], np.int64)
        start = low - (ends - lengths)[part] + offsets[part]
        found.append((least[low], np.array(prints, np.uint64), numbers[part], start, high - low + WINDOW))

    for number, data in texts:
        for first in range(0, max(0, len(data) - WINDOW + 1), CHUNK):
            part = data[first : first + CHUNK + WINDOW - 1]
            waiting.append((number, first, part))
            size += len(part)
            if size >= CHUNK:
                hash_waiting()
                waiting, size = [], 0
    if waiting:
        hash_waiting()
    kinds = (np.uint64, np.uint64, np.int64, np.int64, np.int64)
    return tuple(np.concatenate([x[i] for x in found]) if found else np.empty(0, kind) for i, kind in enumerate(kinds))


def _ranks(values: np.ndarray) -> tuple[np.ndarray, int]:
    """The place of each value among the different ones, and their number; a group's places fit 32 bits."""
    order = np.argsort(values)
    inside = values[order]
    new = np.empty(len(values), bool)
    new[:1] = True
    np.not_equal(inside[1:], inside[:-1], out=new[1:])
    del inside
    rank = np.empty(len(values), np.int32)
    rank[order] = np.cumsum(new, dtype=np.int32) - 1
    return rank, int(new.sum())


def _counting_sort(symbols: np.ndarray) -> np.ndarray:
    """The stable order of symbols, by counting 16 bits at a time."""
    order = np.argsort((symbols & 0xFFFF).astype(np.uint16), kind="stable")
    if len(symbols) and symbols.max() > 0xFFFF:
        high = (symbols >> 16).astype(np.uint16)
        order = order[np.argsort(high[order], kind="stable")]
    return order


class Shards:
    """Stretches in shards: their symbols, and each shard's suffix order and transform, one shard after another.

    Behind each stretch stand SYMBOL ends, which are smaller than all bytes.
    """

    def __init__(self, pieces: list[bytes], shard_bytes: int = SHARD_BYTES):
        # Only what stays is held for the whole group, in 32 bits where that is enough; keys are made shard by shard.
        lengths = np.array([len(p) for p in pieces], np.int32)
        sizes = lengths + np.int32(SYMBOL)
        data = np.frombuffer(b"".join(p + bytes(SYMBOL) for p in pieces) + bytes(SYMBOL), np.uint8)
        starts = np.cumsum(sizes, dtype=np.int32) - sizes
        n = int(sizes.sum())
        self.piece = np.repeat(np.arange(len(pieces), dtype=np.int32), sizes)
        self.local = np.arange(n, dtype=np.int32) - np.repeat(starts, sizes)
        self.left = lengths[self.piece] - self.local
        shard = _ranks(starts // shard_bytes)[0].astype(np.uint16)[self.piece]
        five = np.zeros(len(data) - 4, np.int64)
        for i in range(5):
            five <<= 8
            five |= data[i : len(data) - 4 + i]
        rank, many = _ranks(five)
        del five
        for span in (5, 10):
            pairs = rank[:-span].astype(np.int64)
            pairs *= many
            pairs += rank[span:]
            rank, many = _ranks(pairs)
            del pairs
        # 0 is an end; every suffix of a stretch starts with a symbol from 1 on.
        self.symbols = np.where(self.left > 0, rank[:n] + np.int32(1), np.int32(0))
        del rank
        cuts = np.r_[0, np.flatnonzero(np.diff(shard)) + 1, n]
        self.suffixes = np.empty(n, np.int32)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            self.suffixes[a:b] = a + self._order(a, b, many + 2)
        self.numbers = shard
        self.transform = np.where(self.local[self.suffixes] >= SYMBOL, self.symbols[np.maximum(self.suffixes - np.int32(SYMBOL), 0)], np.int32(-1))
        self.ends = shard[self.left <= 0]

    def _order(self, a: int, b: int, base: int) -> np.ndarray:
        """The order of a shard's suffixes by their next 100 bytes."""
        at, n = np.arange(a, b), len(self.symbols)
        ahead = [np.where(self.left[a:b] > SYMBOL * i, self.symbols[np.minimum(at + SYMBOL * i, n - 1)], 0).astype(np.int64) for i in range(WINDOW // SYMBOL)]
        keys = [ahead[i] * base + ahead[i + 1] for i in range(0, len(ahead) - 1, 2)] + ahead[len(ahead) - len(ahead) % 2 :]
        return np.lexsort(keys[::-1])


def merged(shards: Shards, rounds: int = WINDOW // SYMBOL) -> tuple[np.ndarray, np.ndarray]:
    """The interleave of the shards' suffix orders by so many symbols: for each place the suffix, and the symbols that it shares with the
    one before (`rounds` for all that were looked at).

    `interleave` holds shard numbers only. At each place the shard's next entry is read; its symbol leads the suffix that starts a symbol earlier.
    """
    n = len(shards.transform)
    interleave = shards.numbers.copy()
    block = np.zeros(n, np.int32)
    common = np.full(n, rounds, np.int32)
    common[:1] = 0

    def entries() -> np.ndarray:
        at = np.empty(n, np.int32)
        at[np.argsort(interleave, kind="stable")] = np.arange(n, dtype=np.int32)
        return at

    for done in range(rounds):
        symbols = shards.transform[entries()]
        leads = np.flatnonzero(symbols >= 0).astype(np.int32)
        order = leads[_counting_sort(symbols[leads])]
        del leads
        led, inside = symbols[order], block[order]
        # Ends come first; they are one block.
        m = len(shards.ends)
        new = np.zeros(n, bool)
        new[:1], new[m : m + 1] = True, True
        new[m + 1 :] = (led[1:] != led[:-1]) | (inside[1:] != inside[:-1])
        del symbols, led, inside
        interleave = np.concatenate([shards.ends, interleave[order]])
        del order
        common[new & (common == rounds)] = done
        block = np.cumsum(new, dtype=np.int32)
    return shards.suffixes[entries()], common


def later_windows(pieces: list[bytes], key: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, start) of the windows of some stretches that an equal window of theirs comes before."""
    shards = Shards(pieces)
    suffixes, common = merged(shards)
    interval = np.cumsum(common < WINDOW // SYMBOL)
    whole = shards.left[suffixes] >= WINDOW
    suffixes, interval = suffixes[whole], interval[whole]
    many = np.flatnonzero(np.bincount(interval)[interval] > 1)
    suffixes, interval = suffixes[many], interval[many]
    piece = shards.piece[suffixes]
    keys, starts = key[piece], start[piece] + shards.local[suffixes]
    order = np.lexsort((starts, keys, interval))
    later = order[np.r_[False, interval[order][1:] == interval[order][:-1]]] if len(order) else order
    return keys[later], starts[later]


def _united(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of spans that overlap or touch."""
    if not len(low):
        return low, high
    order = np.argsort(low, kind="stable")
    low, reach = low[order], np.maximum.accumulate(high[order])
    first = np.flatnonzero(np.r_[True, low[1:] > reach[:-1]])
    return low[first], reach[np.r_[first[1:] - 1, len(low) - 1]]


def _bytes_of(column: pa.Array) -> list[np.ndarray]:
    empty = np.empty(0, np.uint8)
    return [np.frombuffer(value.as_buffer(), np.uint8) if value.is_valid and len(value.as_buffer()) else empty for value in column]


def _found(docs: DataFrame) -> DataFrame:
    """(leader, print, row, start, length, dealt) of all stretches. `dealt` is the leader, or any number where a smaller equal stretch was found beside it:
    such a stretch is repeated (`again`) and needs no other to say so."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, len(batch), 1024):
                part = batch.slice(first, 1024)
                leader, prints, row, start, length = stretches(list(zip(part.column(0).to_pylist(), _bytes_of(part.column(1)), strict=True)))
                order = np.lexsort((start, row, prints, leader))
                again = np.zeros(len(order), bool)
                if len(order):
                    again[order[1:]] = (leader[order][1:] == leader[order][:-1]) & (prints[order][1:] == prints[order][:-1])
                dealt = np.where(again, row * 1000003 + start, leader.view(np.int64))
                columns = [pa.array(leader.view(np.int64)), pa.array(prints.view(np.int64)), pa.array(row), pa.array(start), pa.array(length.astype(np.int16)), pa.array(again), pa.array(dealt)]
                yield pa.RecordBatch.from_arrays(columns, names=["leader", "print", "row", "start", "length", "again", "dealt"])

    return docs.select("row", "text").mapInArrow(find, "leader bigint, print bigint, row bigint, start bigint, length smallint, again boolean, dealt bigint")


def _sifted(found: DataFrame) -> DataFrame:
    """Of the stretches in order of (leader, print, row, start): all but the first of each print (`open` false: repeated as a whole), and the first
    one where the leader has other prints too (`open` true). A group is read past, never held."""

    def told(rows: pa.RecordBatch, is_open: bool) -> pa.RecordBatch:
        columns = [rows.column(i) for i in (0, 2, 3, 4)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(np.full(len(rows), is_open))], names=["leader", "row", "start", "length", "open"])

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int, int] | None = None
        held: pa.RecordBatch | None = None
        for whole in batches:
            again = whole.filter(whole.column(5))
            if len(again):
                yield told(again, False)
            batch = whole.filter(pc.invert(whole.column(5)))
            if not len(batch):
                continue
            leader, prints = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            same_leader = np.r_[last is not None and last[0] == leader[0], leader[1:] == leader[:-1]]
            same_print = same_leader & np.r_[last is not None and last[1] == prints[0], prints[1:] == prints[:-1]]
            group = np.cumsum(~same_leader)
            varied = np.zeros(group[-1] + 1, bool)
            varied[group[same_leader & ~same_print]] = True
            out = []
            starts = np.flatnonzero(~same_leader)
            if held is not None:
                # The first stretch of a leader whose stretches were all equal up to this batch.
                if same_leader[0] and varied[0]:
                    out.append((held, True))
                if not same_leader[0] or varied[0] or len(starts):
                    held = None
            opened = (~same_leader & varied[group]) | (same_leader & ~same_print)
            out += [(batch.filter(pa.array(opened)), True), (batch.filter(pa.array(same_print)), False)]
            if len(starts) and not varied[group[-1]]:
                held = batch.slice(int(starts[-1]), 1)
            last = (int(leader[-1]), int(prints[-1]))
            yield from (told(rows, is_open) for rows, is_open in out if len(rows))

    order = ("leader", "print", "row", "start")
    dealt = found.repartition("dealt").drop("dealt")
    return dealt.sortWithinPartitions(*order).mapInArrow(sift, "leader bigint, row bigint, start bigint, length smallint, open boolean")


def _with_bytes(opened: DataFrame, docs: DataFrame) -> DataFrame:
    """(leader, row, start, many, piece): the open stretches with their bytes."""
    places = opened.groupBy("row").agg(F.collect_list(F.struct("leader", "start", "length", "many")).alias("places"))
    joined = docs.select("row", "text").join(places.hint("merge"), "row").select("row", "text", "places")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, len(batch), 256):
                part = batch.slice(first, 256)
                flat, counts = part.column(2).flatten(), part.column(2).value_lengths().to_numpy()
                start, length = flat.field(1).to_numpy(), flat.field(2).to_numpy()
                texts, of_text = _bytes_of(part.column(1)), np.repeat(np.arange(len(part)), counts)
                pieces = [texts[t][a : a + n].tobytes() for t, a, n in zip(of_text.tolist(), start.tolist(), length.tolist(), strict=True)]
                columns = [flat.field(0), part.column(0).take(pa.array(of_text)), flat.field(1), flat.field(3), pa.array(pieces, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["leader", "row", "start", "many", "piece"])

    return joined.mapInArrow(cut, "leader bigint, row bigint, start bigint, many boolean, piece binary")


def _spans_by_merging(pieces: DataFrame, groups: int) -> DataFrame:
    def merge(rows: pa.Table) -> pa.Table:
        key, start = later_windows(rows.column("piece").to_pylist(), rows.column("row").to_numpy(), rows.column("start").to_numpy())
        order = np.lexsort((start, key))
        key, start = key[order], start[order]
        first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (start[1:] > start[:-1] + WINDOW)]) if len(key) else np.empty(0, np.int64)
        last = np.r_[first[1:] - 1, len(key) - 1] if len(key) else first
        return pa.table({"row": pa.array(key[first]), "low": pa.array(start[first]), "high": pa.array(start[last] + WINDOW)})

    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("leader"), F.lit(groups)))
    return dealt.groupBy("group").applyInArrow(merge, "row bigint, low bigint, high bigint")


def _spans_by_window(pieces: DataFrame) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, len(batch), 256):
                part = batch.slice(first, 256)
                texts = part.column(2).to_pylist()
                counts = np.array([len(t) - WINDOW + 1 for t in texts])
                prints = [xxhash.xxh3_128_digest(t[i : i + WINDOW]) for t in texts for i in range(len(t) - WINDOW + 1)]
                within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                start = np.repeat(part.column(1).to_numpy(), counts) + within
                yield pa.RecordBatch.from_arrays([pa.array(prints, pa.binary()), pa.array(np.repeat(part.column(0).to_numpy(), counts)), pa.array(start)], names=["print", "row", "start"])

    windows = stored(pieces.select("row", "start", "piece").mapInArrow(cut, "print binary, row bigint, start bigint"))
    firsts = windows.groupBy("print").agg(F.min(F.struct("row", "start")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    later = windows.join(firsts.select("print", "first").hint("merge"), "print").filter("row > first.row OR start > first.start")
    return later.select("row", F.col("start").alias("low"), (F.col("start") + WINDOW).alias("high"))


def _numbered(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(row, key, text): `row` stands in the order of the keys. Unique keys are their own numbers."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    if rows.filter("key IS NULL").isEmpty() and rows.groupBy("key").count().filter("count > 1").isEmpty():
        return rows.withColumn("row", F.col("key").cast("long"))
    order = [F.col("key").asc_nulls_last(), F.xxhash64("text")]
    # Numbers rise with the range and in it; written once, because a rerun may cut the ranges elsewhere.
    return stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("row", F.monotonically_increasing_id()))


_KINDS = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}


def _cut(docs: DataFrame, key: str, text: str, made: str, of_text: Callable[[np.ndarray, np.ndarray, np.ndarray], tuple]) -> DataFrame:
    """(key, what `of_text` says of a text's bytes and the low and high ends of its repeated runs) for every row."""
    rows = _numbered(docs, key, text)
    sifted = stored(_sifted(_found(rows)))
    opened = sifted.filter("open").select("leader", "row", "start", "length")
    spans = sifted.filter("NOT open").select("row", F.col("start").alias("low"), (F.col("start") + F.col("length")).alias("high"))
    size = opened.agg(F.sum(F.col("length") + SYMBOL)).first()[0]
    if size:
        many = opened.groupBy("leader").count().filter(F.col("count") > MOST_STRETCHES).select("leader", F.lit(True).alias("many"))
        marked = opened.join(many.hint("merge"), "leader", "left").withColumn("many", F.coalesce("many", F.lit(False)))
        pieces = stored(_with_bytes(marked, rows))
        spans = spans.unionByName(stored(_spans_by_merging(pieces.filter("NOT many"), groups_for(size, GROUP_BYTES))))
        if not many.isEmpty():
            spans = spans.unionByName(stored(_spans_by_window(pieces.filter("many"))))
    names, kinds = zip(*[(c.split()[0], _KINDS[c.split()[1]]) for c in made.split(", ")], strict=True)
    by_row = spans.groupBy("row").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    joined = rows.join(by_row.hint("merge"), "row", "left").select("key", "text", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, len(batch), 256):
                part = batch.slice(first, 256)
                lists, rows_of = part.column(2), []
                for data, held in zip(_bytes_of(part.column(1)), lists, strict=True):
                    low, high = (held.values.field(i).to_numpy() for i in (0, 1)) if held.is_valid else (np.empty(0, np.int64),) * 2
                    rows_of.append(of_text(data, *_united(low, high)))
                columns = [pa.array(c, kind) for c, kind in zip(zip(*rows_of, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=[key, *names])

    return joined.mapInArrow(cut, f"`{key}` {docs.schema[key].dataType.simpleString()}, {made}")


def _kept(data: np.ndarray, low: np.ndarray, high: np.ndarray) -> bytes:
    keep = np.ones(len(data), bool)
    for a, b in zip(low.tolist(), high.tolist(), strict=True):
        keep[a:b] = False
    return data[keep].tobytes()


def repeated_bytes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256) for every row of `docs`: its UTF-8 bytes, those that a window of 100 bytes covers which also starts
    earlier, their maximal runs, and the digest of the rest.

    Null and empty texts have no bytes; texts under 100 bytes lose none. Rows with the same key stand one after another in a fixed order, null keys
    last. An empty table gives an empty result; other columns are ignored. The key is a whole number.
    """

    def digest(data: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple:
        return len(data), int((high - low).sum()), len(low), hashlib.sha256(_kept(data, low, high)).hexdigest()

    return _cut(docs, key, text, "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string", digest)


def without_repeated_bytes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, kept, lows, highs): the bytes that stay, which need not be whole characters at the cuts, and the runs that went."""
    return _cut(docs, key, text, "kept binary, lows array<bigint>, highs array<bigint>", lambda data, low, high: (_kept(data, low, high), low.tolist(), high.tolist()))


def op12_merged_transforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes(table(spark, sf_dir, "documents").select("doc_id", "text"))
