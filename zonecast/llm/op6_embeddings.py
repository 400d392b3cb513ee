"""Operator 6: near-duplicate vectors by Euclidean p-stable hashing.

Normalised vectors are projected on Gaussian directions; each of a table's k projections is shifted and cut into steps
of width w, and the k step numbers together are the bucket. Unit vectors of cosine 0.9 lie 0.447 apart and fall into one
step with probability 0.82, unrelated ones (1.41 apart) with 0.49. k grows with the logarithm of the number of vectors, so
that buckets of unrelated vectors stay small at any size, and the number of tables follows from k so that a pair at the
threshold is missed by all tables with probability below 1 % (a pair at 0.95: below 1e-5).

Buckets become components of exactly checked links as in ``buckets``, with a 128-bit sketch of signs to exclude unlikely
pairs. Links are then counted within each component by blocks: members are dealt to blocks of bounded size, each pair of
blocks is one group, and numpy multiplies two blocks at a time in double precision; only counts leave a task. So pairs that
the tables missed inside a component are found as well, and no pair is ever emitted.

Equal vectors are one class first; a class counts its copies in n_links.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components link with nothing (n_links 0,
component_id = vec_id); vectors of different length are never compared; rows with a null vec_id link with nothing and have
null component_id and kept false; rows that repeat a vec_id are vectors of their own that share the id's component. Only
vec_id and embedding are read, so extra columns cannot clash.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.llm import words as W
from zonecast.llm.buckets import link_components
from zonecast.llm.frames import staged

WIDTH = 2.0
MISS = 0.01
SKETCH_BITS = 128
BLOCK = 1024
SEED = 20240611


def _normal_cdf(x: float) -> float:
    return 0.5 * (1 + math.erf(x / math.sqrt(2)))


def collision(distance: float, width: float = WIDTH) -> float:
    """Chance that two points at a distance fall into one step of a random projection."""
    c = width / distance
    return 1 - 2 * _normal_cdf(-c) - 2 / (math.sqrt(2 * math.pi) * c) * (1 - math.exp(-c * c / 2))


def plan(n: int, cosine: float) -> tuple[int, int]:
    """(projections per table, tables) for ``n`` vectors."""
    near, far = collision(math.sqrt(2 - 2 * cosine)), collision(math.sqrt(2))
    k = max(8, math.ceil(math.log(max(n, 2)) / -math.log(far)))
    return k, math.ceil(math.log(MISS) / math.log(1 - near ** k))


def normalise(column: pa.Array) -> list[np.ndarray | None]:
    """Unit vectors in double precision; None where a vector cannot link."""
    out: list[np.ndarray | None] = []
    for value in column:
        v = None
        if value.is_valid and len(value) and not value.values.null_count:
            x = value.values.to_numpy(zero_copy_only=False).astype(np.float64)
            scale = np.abs(x).max()
            if np.isfinite(x).all() and scale > 0:
                v = x / scale
                v = v / math.sqrt(float(v @ v))
        out.append(v)
    return out


def _projections(dim: int, k: int, tables: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng([SEED, dim])
    return (rng.standard_normal((dim, k * tables)), rng.uniform(0, WIDTH, k * tables),
            rng.standard_normal((dim, SKETCH_BITS)))


def bucket_keys(x: np.ndarray, k: int, tables: int) -> np.ndarray:
    directions, shift, _ = _projections(x.shape[1], k, tables)
    steps = np.floor((x @ directions + shift) / WIDTH).astype(np.int64).view(np.uint64).reshape(len(x), tables, k)
    key = np.broadcast_to(np.arange(1, tables + 1, dtype=np.uint64) * W.MIX_A + np.uint64(x.shape[1]), steps.shape[:2]).copy()
    for i in range(k):
        key = W.mix64(key * W.RADIX + steps[:, :, i])
    return key


def signs(x: np.ndarray) -> np.ndarray:
    """Two longs of projection signs."""
    bits = (x @ _projections(x.shape[1], 1, 1)[2]) > 0
    return np.packbits(bits, axis=1).view(np.int64)


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        units = normalise(batch.column(1))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0),
             pa.array([None if v is None else hashlib.blake2b(v.tobytes(), digest_size=16).digest() for v in units], pa.binary()),
             pa.array([None if v is None else v.tobytes() for v in units], pa.binary())], ["vec_id", "class_key", "unit"])


def _hash(k: int, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(1).to_pylist()
            sizes = np.array([len(r) for r in raw])
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                for part in np.array_split(at, -(-len(at) // 2048)):
                    x = np.frombuffer(b"".join(raw[i] for i in part), np.float64).reshape(len(part), -1)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(part)),
                         W.list_array(W.signed(bucket_keys(x, k, tables).ravel()), np.full(len(part), tables), pa.int64()),
                         W.list_array(signs(x).ravel(), np.full(len(part), 2), pa.int64())], ["node", "keys", "sketch"])
    return run


def close_pairs(cosine: float):
    def linked(xs: list[bytes], ys: list[bytes]) -> np.ndarray:
        return np.array([len(x) == len(y) and float(np.frombuffer(x) @ np.frombuffer(y)) >= cosine
                         for x, y in zip(xs, ys, strict=True)], bool)
    return linked


def close_matrix(cosine: float):
    def matrix(xs: list[bytes], ys: list[bytes]) -> np.ndarray:
        out = np.zeros((len(xs), len(ys)), bool)
        nx, ny = np.array([len(x) for x in xs]), np.array([len(y) for y in ys])
        for size in np.intersect1d(nx, ny):
            i, j = np.flatnonzero(nx == size), np.flatnonzero(ny == size)
            a, b = (np.frombuffer(b"".join(v[k] for k in at)).reshape(len(at), -1) for v, at in ((xs, i), (ys, j)))
            out[np.ix_(i, j)] = a @ b.T >= cosine
        return out
    return matrix


def _block_counts(cosine: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        low, high = int(rows["low"].iloc[0]), int(rows["high"].iloc[0])
        x, y = rows[rows["block"] == low], rows[rows["block"] == high]
        a = np.frombuffer(b"".join(x["unit"])).reshape(len(x), -1)
        b = np.frombuffer(b"".join(y["unit"])).reshape(len(y), -1)
        linked = a @ b.T >= cosine
        if low == high:
            np.fill_diagonal(linked, False)
            nodes, n = x["class_id"], linked @ y["copies"].to_numpy()
        else:
            nodes = pd.concat([x["class_id"], y["class_id"]])
            n = np.concatenate([linked @ y["copies"].to_numpy(), linked.T @ x["copies"].to_numpy()])
        return pd.DataFrame({"class_id": nodes.to_numpy(), "n": n})
    return run


def near_vectors(vectors: DataFrame, cosine: float = 0.9) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding): vec_id, n_links, component_id, kept."""
    units = staged(vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"),
                                  F.col("embedding").cast("array<double>").alias("embedding"))
                   .mapInArrow(_units, "vec_id bigint, class_key binary, unit binary"), "units")
    named = units.where("vec_id is not null and class_key is not null")
    classes = staged(named.groupBy("class_key").agg(F.min("vec_id").alias("first"), F.any_value("unit").alias("unit"), F.count("*").alias("copies"))
                     # a repeated vec_id's different vectors are nodes of their own
                     .withColumn("node", F.xxhash64("class_key")), "unit-classes")
    k, tables = plan(classes.count(), cosine)
    hashed = staged(classes.select("node", "unit").mapInArrow(_hash(k, tables), "node bigint, keys array<bigint>, sketch array<bigint>"),
                    "unit-hashes")
    rows = hashed.select(F.explode("keys").alias("key"), "node").distinct()
    sketches = hashed.groupBy("node").agg(F.any_value("sketch").alias("sketch"))

    share = math.acos(cosine) / math.pi
    most = math.ceil(SKETCH_BITS * share + 6 * math.sqrt(SKETCH_BITS * share * (1 - share)))

    def score(a: Column, b: Column) -> Column:
        off = F.bit_count(a[0].bitwiseXOR(b[0])) + F.bit_count(a[1].bitwiseXOR(b[1]))
        return F.when(off <= most, -off)

    payloads = classes.select("node", F.col("unit").alias("payload"))
    linked = link_components(rows, sketches, payloads, score, close_pairs(cosine), close_matrix(cosine))

    # exact link counts inside components: blocks of classes, one group for each pair of blocks
    members = staged(classes.join(linked, "node").withColumn("class_id", F.xxhash64("class_key", "unit"))
                     .withColumn("dim", F.octet_length("unit")), "unit-members")
    blocks = members.groupBy("component", "dim").agg(F.ceil(F.count("*") / BLOCK).alias("n_blocks"))
    dealt = (members.join(blocks, ["component", "dim"])
             .withColumn("block", F.pmod(F.xxhash64("class_id"), F.col("n_blocks")))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_blocks") - 1)))
             .select("component", "dim", "class_id", "copies", "unit", "block",
                     F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")))
    counts = (dealt.groupBy("component", "dim", "low", "high").applyInPandas(_block_counts(cosine), "class_id bigint, n bigint")
              .groupBy("class_id").agg(F.sum("n").alias("others")))
    per_class = (classes.withColumn("class_id", F.xxhash64("class_key", "unit")).join(counts, "class_id", "left")
                 .select("class_key", "node", "first", "copies", F.coalesce("others", F.lit(0)).alias("others")))
    lowest = (members.groupBy("component").agg(F.min("first").alias("lowest")).join(linked, "component").select("node", "lowest"))
    return (units.select("vec_id", "class_key").withColumn("linkable", F.col("vec_id").isNotNull())
            .join(per_class, "class_key", "left").join(lowest, "node", "left")
            .select("vec_id",
                    F.when(F.col("linkable"), F.coalesce(F.col("copies") - 1 + F.col("others"), F.lit(0)))
                    .otherwise(0).cast("bigint").alias("n_links"),
                    F.when(F.col("linkable"), F.coalesce("lowest", "first", "vec_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))
