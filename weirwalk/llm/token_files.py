"""Token ids in raw binary shards with a minimal perfect hash index.

Layout of a folder, on any file system that pyarrow opens:

* ``tokens-NNNNN.bin``: the ids of the shard's documents one after another, unsigned little-endian, 2 bytes each (4 if the vocabulary
  needs them). Shards and the documents in them ascend by key (null keys first).
* ``index-NNNNN.bin``: an index over the documents whose keys hash there: a minimal perfect hash function from key to slot, and for
  each slot the key's fingerprint and the document's shard, place, length and global start.

A lookup hashes the key, opens one index file, computes one slot, compares one fingerprint and reads one range: constant time, and an
absent key is told by its fingerprint but for a chance of 2^-32.

Files are written under a name of their own and then renamed, so a repeated or a lost task leaves whole files with the same content.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator
from contextlib import ExitStack, contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weirwalk.llm.common import groups_for, stored, table, work_dir
from weirwalk.llm.tokens import encode_documents, wordwise

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
SHARD_ROWS = 4096
INDEX_ROWS = 8192
#: Ids of a shard among which repeated keys are numbered together.
PART_IDS = 1 << 20
#: Bits per key in each level of the hash function's bit arrays.
_GAMMA = 2
_MOST_READ = 8 << 20


def _open(root: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(root)


@contextmanager
def _writing(root: str, name: str) -> Iterator[pa.NativeFile]:
    where, path = _open(root)
    where.create_dir(path, recursive=True)
    own = f"{path}/.{name}.{uuid.uuid4().hex}"
    with where.open_output_stream(own) as out:
        yield out
    where.move(own, f"{path}/{name}")


def _mixed(h: np.ndarray, level: int) -> np.ndarray:
    """A 64-bit mix of hashes, another one for each level."""
    x = h + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """A minimal perfect hash function over distinct 64-bit hashes: n of them go to 0 to n - 1.

    Level by level, keys fall on a bit array; those that fall alone set their bit, the others go on to the next, smaller level. A key's
    slot is the number of bits before its own.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self._before = np.cumsum([0, *(int(x.sum()) for x in levels)])
        self._ranks = [np.cumsum(x) - x for x in levels]

    @classmethod
    def build(cls, hashes: np.ndarray) -> PerfectHash:
        if len(np.unique(hashes)) != len(hashes):
            raise ValueError("two keys share a 64-bit hash")
        levels: list[np.ndarray] = []
        while len(hashes):
            size = np.uint64(_GAMMA * len(hashes))
            at = (_mixed(hashes, len(levels)) % size).astype(np.int64)
            alone = np.bincount(at, minlength=int(size)) == 1
            levels.append(alone)
            hashes = hashes[~alone[at]]
        return cls(levels)

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """-1 where no level has the key's bit; other keys that were not built in get any slot."""
        out, left = np.full(len(hashes), -1, np.int64), np.arange(len(hashes))
        for level, bits in enumerate(self.levels):
            at = (_mixed(hashes[left], level) % np.uint64(len(bits))).astype(np.int64)
            found = bits[at]
            out[left[found]] = self._before[level] + self._ranks[level][at[found]]
            left = left[~found]
        return out


def _place(rows: DataFrame, key: str, buckets: int) -> DataFrame:
    """Adds the hash, fingerprint and index bucket of (key, occurrence)."""
    return rows.withColumns(
        {
            "__hash": F.xxhash64(F.lit("place"), key, "__occurrence"),
            "__print": F.xxhash64(F.lit("print"), key, "__occurrence").bitwiseAND(0xFFFFFFFF),
            "__bucket": F.pmod(F.xxhash64(F.lit("bucket"), key, "__occurrence"), F.lit(buckets)).cast("int"),
        }
    )


def _occurrences(rows: DataFrame, key: str, part: Column, order: Column) -> DataFrame:
    """Repeated keys are told apart by their number, from 0, in the order of `part` and of `order` within it.

    `rows` have to come alike when read again. A key's rows are numbered part by part, each from the running count of the parts before, so that
    a key of very many rows is not numbered by one task.
    """
    repeated = rows.groupBy(key).count().filter("count > 1").limit(1).count()
    if not repeated:
        return rows.withColumn("__occurrence", F.lit(0).cast("long"))
    parted = rows.withColumn("__part", part)
    before = Window.partitionBy(key).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counted = parted.groupBy(key, "__part").agg(F.count("*").alias("__n"))
    offsets = counted.select(F.col(key).alias("__key"), F.col("__part").alias("__of"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    numbered = parted.withColumn("__row", F.row_number().over(Window.partitionBy(key, "__part").orderBy(order)))
    joined = numbered.join(offsets, F.col(key).eqNullSafe(F.col("__key")) & (F.col("__part") == F.col("__of")))
    return joined.withColumn("__occurrence", F.col("__before") + F.col("__row") - 1).drop("__part", "__row", "__key", "__of", "__before")


def write_token_files(docs: DataFrame, root: str, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text") -> dict[str, object]:
    """Writes the files for all rows of `docs` and returns what a reader needs to know: root, id width and the number of index files.

    `key` is a number. Rows with the same key are kept one after another and numbered as occurrences of it; null keys are keys too;
    null or empty texts hold the end id alone; an empty table gives no files.
    """
    keys = docs.select(key)
    n_rows = keys.count()
    n_shards = groups_for(n_rows, SHARD_ROWS)
    at = F.percentile_approx(key, [i / n_shards for i in range(1, n_shards)] or [0.5], 10 * n_shards + 1000)
    cuts = np.unique(np.asarray(keys.agg(at).first()[0] or [], np.int64)) if n_shards > 1 else np.empty(0, np.int64)
    width = 2 if wordwise(tokenizer).n_ids <= 1 << 16 else 4
    key_type = docs.schema[key].dataType.simpleString()

    def narrow(batch: pa.RecordBatch) -> pa.RecordBatch:
        known = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
        shard = np.where(batch.column(0).is_null().to_numpy(zero_copy_only=False), 0, np.searchsorted(cuts, known, "left"))
        ids = [np.frombuffer(x, "<u4").astype(f"<u{width}").tobytes() for x in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary()), pa.array(shard, pa.int32())], names=[key, "ids", "shard"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with ExitStack() as files:
            shard, out, done = None, None, 0
            for batch in batches:
                starts, lengths = [], []
                for number, ids in zip(batch.column(2).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    if number != shard:
                        files.pop_all().close()
                        shard, out, done = number, files.enter_context(_writing(root, f"tokens-{number:05d}.bin")), 0
                    out.write(ids)
                    starts.append(done)
                    lengths.append(len(ids) // width)
                    done += lengths[-1]
                columns = [batch.column(0), batch.column(2), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=[key, "shard", "at", "n_tokens"])

    encoded = encode_documents(docs, tokenizer, end_id, key, text, narrow, f"`{key}` {key_type}, ids binary, shard int")
    dealt = encoded.repartitionById(n_shards, F.col("shard"))
    ordered = dealt.sortWithinPartitions(F.col("shard"), F.col(key).asc_nulls_first(), F.xxhash64("ids"))
    written = stored(ordered.mapInArrow(write, f"`{key}` {key_type}, shard int, at bigint, n_tokens bigint"))

    totals = written.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    bases = totals.select("shard", F.coalesce(F.sum("total").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    buckets = groups_for(n_rows, INDEX_ROWS)
    started = written.join(F.broadcast(bases), "shard").withColumn("start", F.col("base") + F.col("at"))
    # A key lies in one shard, so its documents are told apart by their places there.
    entries = _place(_occurrences(started, key, F.floor(F.col("at") / PART_IDS), F.col("at")), key, buckets)

    def index(rows: pd.DataFrame) -> pd.DataFrame:
        hashes = rows["__hash"].to_numpy(np.int64).view(np.uint64)
        hashed = PerfectHash.build(hashes)
        order = np.argsort(hashed.slots(hashes))
        columns = {name: rows[column].to_numpy(np.int64)[order] for name, column in _COLUMNS.items()}
        levels = {f"level{i:03d}": np.packbits(bits) for i, bits in enumerate(hashed.levels)}
        out = io.BytesIO()
        np.savez(out, sizes=np.array([len(bits) for bits in hashed.levels]), **columns, **levels)
        with _writing(root, f"index-{rows['__bucket'].iloc[0]:05d}.bin") as file:
            file.write(out.getvalue())
        return pd.DataFrame({"bucket": [rows["__bucket"].iloc[0]], "keys": [len(rows)]})

    indexed = entries.select("__hash", "__print", "__bucket", "shard", "at", "n_tokens", "start").groupBy("__bucket").applyInPandas(index, "bucket int, keys bigint")
    stored(indexed)
    return {"root": root, "width": width, "buckets": buckets}


#: Columns of an index file, and where their values come from.
_COLUMNS = {"print": "__print", "shard": "shard", "at": "at", "n_tokens": "n_tokens", "start": "start"}


def read_token_files(keys: DataFrame, files: dict[str, object], key: str = "doc_id") -> DataFrame:
    """(key, start, ids) of the keys that the files hold; start counts the ids of all documents before, ids are unsigned 32-bit.

    A key that stands twice in `keys` asks for its first and second occurrence. Absent keys give no row.
    """
    root, width, buckets = str(files["root"]), int(files["width"]), int(files["buckets"])
    key_type = keys.schema[key].dataType.simpleString()
    # Written once: which rows of a key are which is then settled, whatever is read again.
    asked_for = stored(keys.select(key, F.spark_partition_id().alias("asked_in")))
    asked = _place(_occurrences(asked_for, key, F.col("asked_in"), F.lit(0)), key, buckets)

    def look_up(rows: pd.DataFrame) -> pd.DataFrame:
        where, path = _open(root)
        try:
            with where.open_input_file(f"{path}/index-{rows['__bucket'].iloc[0]:05d}.bin") as f:
                index = np.load(io.BytesIO(f.read()))
        except FileNotFoundError:
            return pd.DataFrame({key: [], "shard": [], "at": [], "n_tokens": [], "start": []})
        levels = [np.unpackbits(index[f"level{i:03d}"], count=int(size)).astype(bool) for i, size in enumerate(index["sizes"])]
        slots = PerfectHash(levels).slots(rows["__hash"].to_numpy(np.int64).view(np.uint64))
        found = (slots >= 0) & (index["print"][slots] == rows["__print"].to_numpy())
        return pd.DataFrame({key: rows[key][found].array} | {name: index[name][slots[found]] for name in ("shard", "at", "n_tokens", "start")})

    found = asked.groupBy("__bucket").applyInPandas(look_up, f"`{key}` {key_type}, shard int, at bigint, n_tokens bigint, start bigint")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, path = _open(root)
        for batch in batches:
            shard, at, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
            ids: list[bytes] = []
            first = 0
            while first < len(shard):
                # Documents that lie side by side are read at once.
                last = first + 1
                while last < len(shard) and shard[last] == shard[first] and at[last] == at[last - 1] + n[last - 1] and (at[last] + n[last] - at[first]) * width <= _MOST_READ:
                    last += 1
                with where.open_input_file(f"{path}/tokens-{shard[first]:05d}.bin") as f:
                    raw = f.read_at(int(at[last - 1] + n[last - 1] - at[first]) * width, int(at[first]) * width)
                values = np.frombuffer(raw, f"<u{width}").astype("<u4")
                ids += [values[a : a + k].tobytes() for a, k in zip(at[first:last] - at[first], n[first:last], strict=True)]
                first = last
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(4), pa.array(ids, pa.binary())], names=[key, "start", "ids"])

    # Documents of one shard file are read by one task, in the file's order.
    by_file = found.repartition("shard").sortWithinPartitions("shard", "at")
    return by_file.mapInArrow(read, f"`{key}` {key_type}, start bigint, ids binary")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    files = write_token_files(docs, work_dir(spark), public_tokenizers.path(TOKENIZER), END_ID)
    back = read_token_files(docs.select("doc_id"), files)
    return back.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
