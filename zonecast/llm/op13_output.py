"""Operator 13: token ids in binary shards with a minimal perfect hash index over document keys.

Documents are dealt by range of doc_id and sorted; each task encodes its texts and writes shard files below a folder, one
after another, each closed at ``shard_bytes`` of ids. A shard (all numbers little-endian) is

    header   magic, id width, levels, documents, keys, ids                 (one fixed struct)
    levels   size in bits of each hash level                               u64 each
    bits     the levels' bits, 64 to a word, level after level             u64 each
    ranks    set bits before each word                                     u64 each
    slots    fingerprint, first document, number of documents of a key     u32 each, in three runs
    offsets  of each document's ids, and the end                           u64, documents + 1
    keys     doc_id of each document; a null flag of each                  i64, then u8
    payload  the ids of all documents, nothing between                     u16 or u32

The index is a minimal perfect hash in levels: at each level the keys that are alone at their hashed bit set that bit, the others go on to
the next one; a key's slot is the rank of its bit. So a key costs about two hashed probes, at whatever size. The slot's
fingerprint turns away a key that is not in the shard without a look at anything else; the document's stored key decides.

A task writes under a name of its attempt and renames: a file under its final name is whole, and a task that runs again writes the
same bytes. The manifest, one row per shard, has the ids before each shard and the range of its keys.

Defined results: a null or empty text has the end id alone; rows that repeat a doc_id are documents of their own, all found under
the key, in the order of their texts' hashes (they may fill several shards); a null doc_id sorts first and is no key; only
doc_id and text are read, so extra columns cannot clash; an empty table gives no shard and no row.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonecast.llm import words as W
from zonecast.llm.frames import staged
from zonecast.llm.segments import WordTokenizer, text_ranges

MAGIC = b"ZCIDS01\n"
HEADER = struct.Struct("<8sIIQQQ")
SHARD_BYTES = 16 << 20
BATCH_CHARS = 1 << 20
GAMMA = 1.6
MAX_LEVELS = 200
FINGERPRINT_SEED = np.uint64(0xA24BAED4963EE407)
MANIFEST = "shard string, n_docs bigint, n_ids bigint, first_key bigint, last_key bigint"


# ---------------------------------------------------------------- minimal perfect hash

def _positions(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    return W.mix64(keys.view(np.uint64) ^ seed) % np.uint64(size)


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (W.mix64(keys.view(np.uint64) + FINGERPRINT_SEED) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """Slots 0 to n - 1 of n different int64 keys."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, ranks: np.ndarray):
        self.sizes, self.bits, self.ranks = sizes, bits, ranks
        self.first_word = np.concatenate([[0], np.cumsum(sizes // 64)]).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        rest, sizes, bits = np.ascontiguousarray(keys, np.int64), [], []
        while len(rest):
            if len(sizes) == MAX_LEVELS:
                raise ValueError("keys of a perfect hash must differ")
            size = -(-max(64, int(GAMMA * len(rest))) // 64) * 64
            at = _positions(rest, len(sizes), size)
            held = np.bincount(at.astype(np.int64), minlength=size)
            bits.append(np.packbits(held == 1, bitorder="little").view("<u8"))
            sizes.append(size)
            rest = rest[held[at.astype(np.int64)] != 1]
        words = np.concatenate(bits) if bits else np.zeros(0, "<u8")
        counts = np.bitwise_count(words).astype(np.uint64)
        return cls(np.array(sizes, np.uint64), words, np.cumsum(counts, dtype=np.uint64) - counts)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 or any slot for a key that is not among them."""
        keys = np.ascontiguousarray(keys, np.int64)
        out, todo = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, size in enumerate(self.sizes.tolist()):
            if not len(todo):
                break
            at = _positions(keys[todo], level, size)
            word, bit = self.first_word[level] + (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            found = self.bits[word]
            hit = (found >> bit) & np.uint64(1) == 1
            below = found & ((np.uint64(1) << bit) - np.uint64(1))
            out[todo[hit]] = (self.ranks[word] + np.bitwise_count(below))[hit].astype(np.int64)
            todo = todo[~hit]
        return out


# ---------------------------------------------------------------- one shard

def build_shard(keys: np.ndarray, nulls: np.ndarray, payloads: list[bytes], width: int) -> bytes:
    """File content for documents sorted by key, nulls first."""
    lengths = np.array([len(p) // width for p in payloads], np.uint64)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype("<u8")
    named = np.flatnonzero(~nulls)
    distinct, first, copies = np.unique(keys[named], return_index=True, return_counts=True)
    index = PerfectHash.build(distinct)
    slot = index.slots(distinct)
    slots = np.zeros((3, len(distinct)), "<u4")
    for row, values in enumerate((fingerprints(distinct), named[first] if len(named) else first, copies)):
        slots[row, slot] = values
    head = HEADER.pack(MAGIC, width, len(index.sizes), len(keys), len(distinct), int(offsets[-1]))
    return b"".join([head, index.sizes.astype("<u8").tobytes(), index.bits.astype("<u8").tobytes(), index.ranks.astype("<u8").tobytes(),
                     slots.tobytes(), offsets.tobytes(), keys.astype("<i8").tobytes(), nulls.astype(np.uint8).tobytes(), *payloads])


class Shard:
    """A shard behind ``read(start, size)``, which may be a slice of bytes or a ranged read of a file."""

    def __init__(self, read):
        self.read = read
        magic, self.width, levels, self.n_docs, self.n_keys, self.n_ids = HEADER.unpack(read(0, HEADER.size))
        if magic != MAGIC:
            raise ValueError("no shard of token ids")
        self.at = HEADER.size
        sizes = self._run("<u8", levels)
        words = int(sizes.sum()) // 64
        self.index = PerfectHash(sizes, self._run("<u8", words), self._run("<u8", words))
        self.fingerprint, self.first, self.copies = (self._run("<u4", self.n_keys) for _ in range(3))
        self.offsets_at = self.at
        self.keys_at = self.offsets_at + 8 * (self.n_docs + 1)
        self.nulls_at = self.keys_at + 8 * self.n_docs
        self.payload_at = self.nulls_at + self.n_docs

    def _run(self, dtype: str, n: int) -> np.ndarray:
        size = np.dtype(dtype).itemsize * n
        self.at += size
        return np.frombuffer(self.read(self.at - size, size), dtype)

    def _value(self, dtype: str, at: int, i: int, n: int = 1) -> np.ndarray:
        size = np.dtype(dtype).itemsize
        return np.frombuffer(self.read(at + i * size, n * size), dtype)

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """doc_id and null flag of every document."""
        return self._value("<i8", self.keys_at, 0, self.n_docs), self._value("u1", self.nulls_at, 0, self.n_docs).astype(bool)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first document, documents) of each key; 0 documents if it is not in the shard."""
        keys = np.ascontiguousarray(keys, np.int64)
        if not self.n_keys:
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        slot = self.index.slots(keys)
        there = (slot >= 0) & (self.fingerprint[slot] == fingerprints(keys))
        first = np.where(there, self.first[slot], 0).astype(np.int64)
        for i in np.flatnonzero(there):
            there[i] = self._value("<i8", self.keys_at, int(first[i]))[0] == keys[i]
        return first, np.where(there, self.copies[slot], 0).astype(np.int64)

    def span(self, doc: int) -> tuple[int, int]:
        """First id and number of ids of a document within the shard."""
        start, end = (int(v) for v in self._value("<u8", self.offsets_at, doc, 2))
        return start, end - start

    def ids(self, start: int, n: int) -> np.ndarray:
        return np.frombuffer(self.read(self.payload_at + start * self.width, n * self.width), f"<u{self.width}").astype("<u4")


def from_bytes(content: bytes | memoryview) -> Shard:
    view = memoryview(content)
    return Shard(lambda start, size: view[start:start + size])


# ---------------------------------------------------------------- files in the shared folder

def _filesystem(folder: str):
    """(pyarrow file system, path) of a folder named by URI or path."""
    from pyarrow import fs

    if "://" not in folder:
        folder = folder.removeprefix("file:")
        return fs.LocalFileSystem(), folder
    return fs.FileSystem.from_uri(folder)


def _write(folder: str, name: str, content: bytes) -> None:
    files, root = _filesystem(folder)
    attempt = f"{root}/_attempt-{uuid.uuid4().hex}"
    with files.open_output_stream(attempt) as out:
        out.write(content)
    files.move(attempt, f"{root}/{name}")


def _close(folder: str, name: str, keys: list[int | None], payloads: list[bytes], width: int) -> tuple:
    nulls = np.array([k is None for k in keys])
    ids = np.array([0 if k is None else k for k in keys], np.int64)
    _write(folder, name, build_shard(ids, nulls, payloads, width))
    named = ids[~nulls]
    ends = (int(named[0]), int(named[-1])) if len(named) else (None, None)
    return (name, len(keys), sum(map(len, payloads)) // width, *ends)


_loaded: dict[str, WordTokenizer] = {}


def _tokenizer(path: str) -> WordTokenizer:
    """Loaded once per Python worker."""
    if path not in _loaded:
        _loaded.clear()
        _loaded[path] = WordTokenizer(path)
    return _loaded[path]


def _writer(folder: str, model: str, end_id: int, shard_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, part = _tokenizer(model), TaskContext.get().partitionId()
        end = end_id.to_bytes(tokenizer.width, "little")
        keys, payloads, size, rows = [], [], 0, []

        def close():
            rows.append(_close(folder, f"shard-{part:07d}-{len(rows):05d}.ids", keys, payloads, tokenizer.width))
            keys.clear()
            payloads.clear()

        for batch in batches:
            texts, named = batch.column(1).to_pylist(), batch.column(0).to_pylist()
            for start, stop in text_ranges(texts, BATCH_CHARS):
                for key, ids in zip(named[start:stop], tokenizer.ids(texts[start:stop]), strict=True):
                    payloads.append(ids + end)
                    keys.append(key)
                    size += len(payloads[-1])
                    if size >= shard_bytes:
                        close()
                        size = 0
        if keys:
            close()
        columns = zip(*rows, strict=True) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.string(), *[pa.int64()] * 4), strict=True)],
                                         ["shard", "n_docs", "n_ids", "first_key", "last_key"])
    return run


def write_ids(docs: DataFrame, model: str, folder: str, end_id: int = 1, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write the shards of ``docs`` (doc_id, text) into ``folder``, which must be new, and give the manifest: shard, n_docs, n_ids,
    first_key, last_key, base (ids of all shards before). ``model`` is a ``tokenizers`` file, at the same place on every executor."""
    spark = docs.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // shard_bytes))
    # the hash and the row's place keep a repeated doc_id from filling one task; the place follows the files, so a task that runs again has it too
    dealt = (rows.withColumn("h", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
             .repartitionByRange(parts, "doc_id", "h", "row").sortWithinPartitions("doc_id", "h", "row").select("doc_id", "text"))
    written = staged(dealt.mapInArrow(_writer(folder, model, end_id, shard_bytes), MANIFEST), "ids-manifest")
    # one row per shard: the running sum is over the number of files
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return written.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _ranges(sizes: np.ndarray) -> np.ndarray:
    """0, 1, .. for each of the sizes, joined."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - sizes, sizes)


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every document of a shard, found under its key in the index."""
    for batch in batches:
        for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            shard = from_bytes(content.as_buffer())
            keys, nulls = shard.keys()
            distinct = np.unique(keys[~nulls])
            first, copies = shard.find(distinct)
            places = np.concatenate([np.flatnonzero(nulls), np.repeat(first, copies) + _ranges(copies)]).astype(np.int64)
            starts, sizes, sums = [], [], []
            for place in places.tolist():
                start, n = shard.span(place)
                starts.append(start)
                sizes.append(n)
                sums.append(zlib.crc32(shard.ids(start, n)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(places), pa.string()), pa.array(np.concatenate([keys[nulls], np.repeat(distinct, copies)]), pa.int64(),
                                                                      mask=np.arange(len(places)) < nulls.sum()),
                 pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sums, pa.int64())],
                ["shard", "doc_id", "at", "n_tokens", "ids_crc32"])


def read_back(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """One row per document of all shards: doc_id, start, n_tokens, ids_crc32, shard."""
    files = spark.read.format("binaryFile").load(folder).select(F.element_at(F.split("path", "/"), -1).alias("shard"), "content")
    rows = files.mapInArrow(_read_back, "shard string, doc_id bigint, at bigint, n_tokens bigint, ids_crc32 bigint")
    return (rows.join(manifest.select("shard", "base"), "shard")
            .select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", "shard"))


def _fetch(folder: str):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        name = rows["shard"].iloc[0]
        files, root = _filesystem(folder)
        out = []
        with files.open_input_file(f"{root}/{name}") as file:
            shard = Shard(lambda start, size: file.read_at(size, start))
            keys = rows["doc_id"].to_numpy(np.int64)
            for key, first, copies in zip(keys.tolist(), *shard.find(keys), strict=True):
                for doc in range(int(first), int(first) + int(copies)):
                    start, n = shard.span(doc)
                    out.append((key, name, start, shard.ids(start, n).tolist()))
        return pd.DataFrame(out, columns=["doc_id", "shard", "at", "ids"])
    return run


def lookup(keys: DataFrame, folder: str, manifest: DataFrame) -> DataFrame:
    """Documents of ``keys`` (doc_id): doc_id, start, ids; a key that no shard holds has no row. Only the indexes of the shards whose
    key range covers a key and the ids of the documents found are read. Routing is a range join with the manifest on blocks of
    keys' ranges, so it needs no bound on the number of shards."""
    wanted = keys.select(F.col("doc_id").cast("bigint").alias("doc_id")).where("doc_id is not null").distinct()
    ranges = manifest.where("first_key is not null")
    # a shard's range is cut at multiples of a step near the mean range, so that the join has an equality
    step = ranges.agg(F.greatest(F.lit(1), F.avg(F.col("last_key").cast("double") - F.col("first_key")).cast("bigint"))).first()[0] or 1
    cell = (F.floor(F.col("doc_id") / step)).cast("bigint")
    cells = F.sequence(F.floor(F.col("first_key") / step).cast("bigint"), F.floor(F.col("last_key") / step).cast("bigint"))
    routed = (wanted.withColumn("cell", cell)
              .join(ranges.withColumn("cell", F.explode(cells)).select("shard", "cell", "first_key", "last_key", "base"), "cell")
              .where("doc_id between first_key and last_key").select("shard", "doc_id"))
    found = routed.groupBy("shard").applyInPandas(_fetch(folder), "doc_id bigint, shard string, at bigint, ids array<bigint>")
    return found.join(manifest.select("shard", "base"), "shard").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "ids")
