"""Operator 12: whitening of embeddings by principal components, on MLlib's distributed BlockMatrix.

Entries become integers x = floor(1024 c) + 100000, so that their sums S and the centred numerators n x - S are exact. Centred rows get
consecutive indexes and become a BlockMatrix of ``rows_per_block`` rows a block. The transposed matrix times the matrix is the scatter: its
row blocks are the inner dimension, dealt to groups of INNER blocks whose products are added, so no task sees more than its
group's blocks. The scatter (dimension squared, whatever the number of rows) is decomposed on the driver, and the block matrix
times the whitening matrix projects all rows.

Consecutive indexes come from the staged rows: a row's place in its partition plus the number of rows in the partitions before;
one number per partition is collected.

Defined results: rows whose vector is null or empty or holds null or non-finite entries (or entries too large for a long) give
nothing; so do rows whose vector has another length than most (ties: the longer), as they lie in another space; a null vec_id stays null and
rows that repeat a vec_id are rows of their own; a component without variance (one row, equal rows, fewer directions than
components) has whitened 0 and explained 0, and then identity_error is 1, as its variance is 0; deviation is null where
it exceeds a long; an empty table gives no row. Only vec_id and embedding are read, so extra columns cannot clash.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.frames import staged

SCALE, SHIFT = 1024, 100_000
ROWS_PER_BLOCK = 1024
#: row blocks whose products one task adds up
INNER = 16
#: variance below this share of the largest counts as none
FLAT = 1e-13
SCHEMA = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def integer_rows(vectors: DataFrame) -> DataFrame:
    """(vec_id, x array<bigint>) of the rows that have a vector of finite entries."""
    c = F.col("embedding").cast("array<double>")
    fits = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float(1 << 52)))
    return (vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), c.alias("embedding"))
            .where((F.size("embedding") > 0) & F.coalesce(fits, F.lit(False)))
            .select("vec_id", F.transform("embedding", lambda v: (F.floor(v * SCALE) + SHIFT).cast("bigint")).alias("x")))


def indexed(rows: DataFrame) -> DataFrame:
    """``rows`` on a staged table, with consecutive ``index`` from 0."""
    spark = rows.sparkSession
    kept = staged(rows.withColumn("place", F.monotonically_increasing_id()), "whitening-rows")
    part = F.shiftright("place", 33)
    sizes = sorted((r["part"], r["count"]) for r in kept.groupBy(part.alias("part")).count().collect())  # one row per partition
    starts = np.concatenate([[0], np.cumsum([n for _, n in sizes])])[:-1].tolist()
    before = spark.createDataFrame([(p, int(s)) for (p, _), s in zip(sizes, starts, strict=True)], "part bigint, before bigint")
    return (kept.withColumn("part", part).join(before, "part")
            .withColumn("index", F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1)).drop("part", "place", "before"))


def _matrix(rows: DataFrame, column, width: int, n: int, rows_per_block: int) -> BlockMatrix:
    """Block matrix of an array column of doubles, by ``index``."""
    frame = rows.select(F.col("index"), array_to_vector(column).alias("vector"))
    return IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(frame, "vector"), n, width).toBlockMatrix(rows_per_block, width)


def scatter(blocks: BlockMatrix) -> np.ndarray:
    """Transpose times the matrix, as a local matrix of its columns' number squared."""
    turned = blocks.transpose()
    groups = max(1, -(-blocks.numRowBlocks // INNER))
    # the split of the inner dimension keeps all blocks from meeting in one task; Python's multiply() does not pass it on
    product = turned._java_matrix_wrapper.call("multiply", blocks._java_matrix_wrapper._java_model, groups)
    return BlockMatrix(product, blocks.colsPerBlock, blocks.colsPerBlock).toLocalMatrix().toArray()


def principal(covariance: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns), the first ``k``; the largest entry of each vector is positive."""
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    most = np.abs(vectors).argmax(0)
    return np.maximum(values, 0.0), vectors * np.where(vectors[most, np.arange(vectors.shape[1])] < 0, -1.0, 1.0)


def identity_error(projected: DataFrame, k: int) -> float:
    """Largest entry of the covariance of ``w`` minus the identity; centred before multiplying."""
    w = [F.col("w")[i] for i in range(k)]
    means = projected.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(w)]).first()
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    found = projected.agg(*[F.avg((w[i] - means[i]) * (w[j] - means[j])).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whiten(vectors: DataFrame, components: int = 8, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding) with a vector and per component, at most ``components``: vec_id, component
    (from 1, by falling variance), n, deviation, whitened, explained, identity_error."""
    spark = vectors.sparkSession
    rows = integer_rows(vectors)
    size = F.size("x")
    usual = rows.groupBy(size.alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()  # one row
    if usual is None:
        return spark.createDataFrame([], SCHEMA)
    d, n, k = usual["d"], usual["count"], min(components, usual["d"])
    rows = indexed(rows.where(size == d))
    # sums by dimension: d rows; decimals, as a long may not hold the sum
    sums = {r["pos"]: r["s"] for r in rows.select(F.posexplode("x").alias("pos", "v"))
            .groupBy("pos").agg(F.sum(F.col("v").cast("decimal(20,0)")).alias("s")).collect()}
    total = F.array(*[F.lit(sums[i]).cast("decimal(38,0)") for i in range(d)])
    # n x - S, exact
    rows = staged(rows.select("vec_id", "index", F.zip_with("x", total, lambda v, s: (v.cast("decimal(19,0)") * n - s).cast("decimal(38,0)"))
                              .alias("part")), "whitening-centred")
    centred = F.transform("part", lambda v: v.cast("double") / float(n))
    blocks = _matrix(rows, centred, d, n, rows_per_block)
    covariance = scatter(blocks) / n
    values, axes = principal(covariance, k)
    trace = float(np.trace(covariance))
    kept = (values > FLAT * max(float(values[0]), 0.0)) & (values > 0)
    weights = axes * np.where(kept, 1 / np.sqrt(np.where(kept, values, 1.0)), 0.0)
    turn = BlockMatrix(spark.sparkContext.parallelize([((0, 0), Matrices.dense(d, k, weights.ravel("F").tolist()))], 1), d, k)
    product = blocks.multiply(turn).toIndexedRowMatrix()
    projected = staged(callMLlibFunc("getIndexedRows", product._java_matrix_wrapper._java_model).toDF("index", "v")
                       .select("index", vector_to_array("v").alias("w")), "whitening-projected")
    error = identity_error(projected, k)
    explained = F.array(*[F.lit(float(v / trace) if t else 0.0) for v, t in zip(values, kept, strict=True)])
    zero = F.lit(0).cast("decimal(38,0)")
    # a part beyond 2^32 has a square beyond a long
    small = ~F.exists("part", lambda v: F.abs(v) > float(1 << 32))
    deviation = F.when(small, F.aggregate("part", zero, lambda a, v: (a + v * v).cast("decimal(38,0)")))
    return (rows.withColumn("deviation", deviation.try_cast("bigint")).join(projected, "index")
            .select("vec_id", "deviation", F.posexplode("w").alias("place", "whitened"))
            .select("vec_id", (F.col("place") + 1).cast("int").alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation", "whitened",
                    explained[F.col("place")].alias("explained"), F.lit(float(error)).alias("identity_error")))
