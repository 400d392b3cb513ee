"""Operator 7: near-duplicate texts by b-bit MinHash.

A text's set is its distinct word shingles. 128 minima per set give 25 bands of five minima for
candidate buckets; the lowest four bits of each minimum, packed into eight longs, give a similarity
estimate by bit counts, corrected for the 1/16 of unequal minima that agree by chance. Pairs whose
estimate lies six standard deviations below the threshold are not looked at; all others are confirmed
on the full shingle sets. A pair at similarity 0.85 shares no band with probability 4e-7.

Equal sets are one class before any bucket is formed, so copies never meet in a bucket. Work per text
is a vectorised Arrow pass; buckets, classes and components are plain DataFrame jobs.

Defined results: a null or empty text, or one without words, has the empty set, n_shingles 0, and is its
own component; rows with a null doc_id are returned with null component and kept false and link with
nothing; each row of a repeated doc_id is returned with the component of its own text. Only doc_id and text are read,
so extra columns cannot clash; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.llm import words as W
from zonecast.llm.buckets import link_components
from zonecast.llm.frames import fresh, likely, quoted, staged, without

PERMUTATIONS, BANDS, ROWS, LOW_BITS = 128, 25, 5, 4
SIGMAS = 6

_rng = np.random.default_rng(20240607)
_FLIPS = _rng.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint32)[:, None]
_FACTORS = (_rng.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint32) | np.uint32(1))[:, None]

PRINTS = "doc_id bigint, text_hash bigint, n_shingles bigint, set_key binary, bands array<bigint>, sketch array<bigint>"


def minima(shingles: np.ndarray) -> np.ndarray:
    """128 minima of a non-empty set of 64-bit shingle hashes, each under its own permutation."""
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(PERMUTATIONS, np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(low), 4096):
        np.minimum(out, ((low[None, i:i + 4096] ^ _FLIPS) * _FACTORS).min(axis=1), out=out)
    return out


def pack(signatures: np.ndarray) -> np.ndarray:
    """(n, 128) minima -> (n, 8) longs that hold the lowest four bits of each."""
    low = (signatures & np.uint32((1 << LOW_BITS) - 1)).astype(np.uint64).reshape(len(signatures), 8, 16)
    shift = (np.arange(16, dtype=np.uint64) * np.uint64(LOW_BITS))[None, None, :]
    return np.bitwise_or.reduce(low << shift, axis=2)


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """(n, 128) minima -> (n, 25) bucket keys."""
    part = signatures[:, :BANDS * ROWS].astype(np.uint64).reshape(len(signatures), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * W.MIX_A, part.shape[:2]).copy()
    for i in range(ROWS):
        key = W.mix64(key * W.RADIX + part[:, :, i])
    return key


def _prints(shingle_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = W.flat(batch.column(2))
            for a, b in W.slices(offsets):
                base = offsets[a]
                text = W.Words(data[base:offsets[b]], offsets[a:b + 1] - base, W.BLANKS)
                sizes, keys, rows = [], [], []
                for s in W.shingle_sets(text, shingle_words):
                    sizes.append(len(s))
                    keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    if len(s):
                        rows.append(minima(s))
                signatures = np.array(rows, np.uint32).reshape(-1, PERMUTATIONS)
                full = np.array(sizes) > 0
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a),
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.binary()),
                    W.list_array(W.signed(band_keys(signatures).ravel()), full * BANDS, pa.int64()),
                    W.list_array(W.signed(pack(signatures).ravel()), full * 8, pa.int64()),
                ], ["doc_id", "text_hash", "n_shingles", "set_key", "bands", "sketch"])
    return run


def similarity_estimate(a: Column, b: Column) -> Column:
    """Jaccard estimate of two packed sketches: share of equal four-bit minima, less what chance adds."""
    def differing(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        d = d.bitwiseOR(F.shiftrightunsigned(d, 1))
        d = d.bitwiseOR(F.shiftrightunsigned(d, 2))
        return F.bit_count(d.bitwiseAND(F.lit(0x1111111111111111)))

    unequal = F.aggregate(F.zip_with(a, b, differing), F.lit(0), lambda s, x: s + x)
    chance = 1 / (1 << LOW_BITS)
    return (1 - unequal / float(PERMUTATIONS) - chance) / (1 - chance)


def text_sets(texts: list[bytes], shingle_words: int) -> list[np.ndarray]:
    data, offsets = W.flat(pa.array(texts, pa.binary()))
    found: list[np.ndarray] = []
    for a, b in W.slices(offsets):
        base = offsets[a]
        found += W.shingle_sets(W.Words(data[base:offsets[b]], offsets[a:b + 1] - base, W.BLANKS), shingle_words)
    return found


def similar_pairs(shingle_words: int, percent: int):
    """Exact check of neighbouring texts on their full shingle sets."""
    def linked(xs: list[bytes], ys: list[bytes]) -> np.ndarray:
        good = np.zeros(len(xs), bool)
        for at in range(0, len(xs), 256):
            pair = text_sets(xs[at:at + 256], shingle_words), text_sets(ys[at:at + 256], shingle_words)
            for i, (x, y) in enumerate(zip(*pair, strict=True), at):
                union = len(W.distinct(np.concatenate([x, y])))
                common = len(x) + len(y) - union
                good[i] = common > 0 and 100 * common >= percent * union
        return good
    return linked


def similar_matrix(shingle_words: int, percent: int, columns: int = 4096):
    """Exact check of all texts of two blocks: common shingles are counted by products of incidence matrices, a bounded
    number of columns (shingles that at least two texts have) at a time."""
    def matrix(xs: list[bytes], ys: list[bytes]) -> np.ndarray:
        sets = text_sets(xs + ys, shingle_words)
        sizes = np.array([len(s) for s in sets])
        row = np.repeat(np.arange(len(sets)), sizes)
        _, column, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = n > 1
        rank = np.cumsum(shared) - 1
        keep = shared[column]
        row, column = row[keep], rank[column[keep]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        common = np.zeros((len(xs), len(ys)), np.float32)
        for at in range(0, int(shared.sum()), columns):
            a, b = np.searchsorted(column, [at, at + columns])
            has = np.zeros((len(sets), columns), np.float32)
            has[row[a:b], column[a:b] - at] = 1
            common += has[:len(xs)] @ has[len(xs):].T
        union = sizes[:len(xs)][:, None] + sizes[len(xs):][None, :] - common
        return (common > 0) & (100 * common >= percent * union)
    return matrix


def _labelled(docs: DataFrame, shingle_words: int, percent: int) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, n_shingles, label (one value per component; null for empty sets and null
    doc_ids) and component_id."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .withColumn("text_hash", F.xxhash64("text"))
    prints = staged(docs.select("doc_id", "text_hash", "text").mapInArrow(_prints(shingle_words), PRINTS), "minhash-prints")
    named = prints.where("doc_id is not null and set_key is not null")
    # a class is one set; its node is a hash of it, and its text that of its first row
    classes = staged(named.groupBy("set_key").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("first"), F.any_value(F.struct("n_shingles", "bands", "sketch")).alias("p"))
        .select("set_key", F.xxhash64("set_key").alias("node"), "first.doc_id", "first.text_hash", "p.*"), "minhash-classes")
    rows = classes.select(F.explode("bands").alias("key"), "node")
    # the set size rides as the sketch's last entry: sizes alone exclude many pairs
    sketches = classes.select("node", F.concat("sketch", F.array("n_shingles")).alias("sketch"))

    threshold = percent / 100
    spread = (threshold * (1 - threshold) / PERMUTATIONS) ** 0.5 * 16 / 15
    least = threshold - SIGMAS * spread

    def score(a: Column, b: Column) -> Column:
        estimate = similarity_estimate(F.slice(a, 1, 8), F.slice(b, 1, 8))
        small, large = F.least(a[8], b[8]), F.greatest(a[8], b[8])
        return F.when((small * 100 >= large * percent) & (estimate >= least), estimate)

    # texts of all classes that share a bucket, fetched by one join
    crowded = rows.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high")
    wanted = staged(classes.select("node", "doc_id", "text_hash").join(
        rows.join(crowded.select("key"), "key").select("node").distinct(), "node"), "minhash-wanted")
    texts = staged(likely(docs, "doc_id", wanted.select("doc_id")).join(wanted, ["doc_id", "text_hash"])
                   .groupBy("node").agg(F.any_value(F.col("text").cast("binary")).alias("payload")), "minhash-texts")
    linked = link_components(rows, sketches, texts, score, similar_pairs(shingle_words, percent),
                             similar_matrix(shingle_words, percent))

    found = classes.join(linked, "node", "left").select("set_key", "doc_id", F.coalesce("component", "node").alias("label"))
    lowest = found.groupBy("label").agg(F.min("doc_id").alias("lowest"))
    known = found.join(lowest, "label").select("set_key", "label", "lowest")
    return (prints.select("doc_id", "text_hash", "n_shingles", "set_key").join(known, "set_key", "left")
            .select("doc_id", "text_hash", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("label")).alias("label"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("lowest", "doc_id")).alias("component_id")))


def near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept."""
    return _labelled(docs, shingle_words, percent).select(
        "doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def keep_representatives(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, with all their columns, less near-duplicates: of each component the row of the smallest doc_id
    stays (of several such rows the smallest text hash, then the smallest row). Rows of empty sets or null doc_ids stay."""
    name = fresh(docs, "row_mark")
    mark = F.xxhash64(F.col("doc_id").cast("bigint"), F.xxhash64(F.col("text").cast("string")))
    found = staged(_labelled(docs, shingle_words, percent).where("label is not null").groupBy("label", "doc_id", "text_hash").agg(
        F.count("*").alias("n")), "minhash-found")
    first = found.groupBy("label").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"))
    judged = staged(found.join(first, "label").select(
        F.xxhash64("doc_id", "text_hash").alias(name), "n",
        (F.struct("doc_id", "text_hash") == F.col("first")).alias("stays")), "minhash-judged")
    marked = docs.withColumn(name, F.when(F.col("doc_id").isNotNull(), mark))
    left = without(marked, name, judged.where("not stays or n > 1").select(name)).drop(name)
    repeated = judged.where("stays and n > 1").select(name)
    once = (likely(marked, name, repeated).join(repeated, name).groupBy(name)
            .agg(F.min(F.struct(*quoted(docs.columns))).alias("row")).select("row.*"))
    return left.unionByName(once)
