"""Shared DataFrame helpers: table access, staged tables, connected components, clash-free columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.session import work_dir


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet below spark.checkpoint.dir and read it back: lineage is cut, the
    copy survives lost executors, and every later branch scans it with its own columns only."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files of a staged table that no later step reads."""
    jvm = spark.sparkContext._jvm
    for file in df.inputFiles()[:1]:
        folder = jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _jump(parents: DataFrame) -> DataFrame:
    """Parents of parents (a -> b), where there are any."""
    above = parents.select(F.col("a").alias("b"), F.col("b").alias("up"))
    return parents.join(above, "b", "left").select("a", F.coalesce("up", "b").alias("b"))


def forest_labels(parents: DataFrame, jumps: int = 2) -> DataFrame:
    """(node, component) of a forest of parents (a -> b, b < a), after a few pointer jumps."""
    for _ in range(jumps):
        parents = _jump(parents)
    return parents.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _relabel(edges: DataFrame, labels: DataFrame) -> DataFrame:
    la = labels.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    lb = labels.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    return (edges.join(la, "a", "left").join(lb, "b", "left")
            .select(F.coalesce("ca", "a").alias("x"), F.coalesce("cb", "b").alias("y")).where("x <> y")
            .select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct())


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b: bigint), component = smallest
    reachable node.

    Contraction: each node points to its smallest smaller neighbour (a grouped minimum), pointers jump twice, and the edges
    are rewritten to the nodes reached; what still joins two different nodes is the next round's input, on a staged table.
    The number of rounds is logarithmic, mostly one or two. No edge list, label or neighbourhood is ever collected; a hub is
    one row per map task in the minimum, and AQE's skew join splits it in the joins."""
    spark = edges.sparkSession
    start = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .where("a <> b").distinct(), "cc-edges")
    rounds, current = [], start
    while not current.isEmpty():
        if len(rounds) == max_rounds:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
        labels = staged(forest_labels(current.groupBy("a").agg(F.min("b").alias("b"))), "cc-labels")
        rounds.append(labels)
        following = staged(_relabel(current, labels), "cc-edges")
        if current is not start:
            dropped(spark, current)
        current = following
    result = start.select(F.col("a").alias("node")).unionByName(start.select(F.col("b").alias("node"))).distinct()
    result = result.withColumn("component", F.col("node"))
    for labels in rounds:
        step = labels.select(F.col("node").alias("component"), F.col("component").alias("up"))
        result = result.join(step, "component", "left").select("node", F.coalesce("up", "component").alias("component"))
    return result


ID_BUCKETS = 1 << 20


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def quoted(columns: list[str]) -> list[str]:
    return [f"`{c}`" for c in columns]


def likely(df: DataFrame, column: str, ids: DataFrame, absent: bool = False) -> DataFrame:
    """Rows of ``df`` whose ``column`` may occur in ``ids`` (one column of the same name), or with ``absent`` those where
    it surely does not. Ids are folded to ID_BUCKETS hash buckets, so what is broadcast has a fixed bound; many ids
    only make the filter weaker, an exact join has to follow."""
    name = fresh(df, "id_bucket")
    bucket = F.pmod(F.xxhash64(F.col(column)), F.lit(ID_BUCKETS))
    hit = ids.select(bucket.alias(name)).distinct()
    return (df.withColumn(name, bucket)
            .join(F.broadcast(hit), name, "left_anti" if absent else "left_semi").drop(name))


def without(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``column`` is not among ``ids`` (one column of the same name); null stays. Only rows that may be
    among them are shuffled."""
    rest = likely(df, column, ids).join(ids, column, "left_anti").select(*quoted(df.columns))
    return likely(df, column, ids, absent=True).unionByName(rest)
