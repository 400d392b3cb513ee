"""Table-level operators: scan, create-if-absent, write, keyed upsert, as-of read,
version history and retention over an append-only version table.

There is no table format here (no transaction log): a version table is a plain
Parquet table with ``commit_version`` / ``committed_at`` / ``operation`` columns, and an upsert
is a null-safe full outer join of target and source, staged in a sibling folder
and then written over the target. Writers are assumed single (no reader isolation); with
``partition_by`` only the partitions the source touches are rewritten (dynamic
partition overwrite), so the cost follows the size of the change, not the table.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None,
               fmt: str = "parquet") -> DataFrame:
    """Scan a table; a missing table is an empty frame of the given schema."""
    try:
        reader = spark.read.format(fmt)
        if schema is not None:
            reader = reader.schema(schema)
        return reader.load(path)
    except AnalysisException as exc:
        if schema is None or "PATH_NOT_FOUND" not in str(exc) and "does not exist" not in str(exc):
            raise
        return spark.createDataFrame([], schema)


def table_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def ensure_table(spark: SparkSession, path: str, schema: StructType | str,
                 partition_by: list[str] | None = None) -> None:
    """Create an empty table with this schema only if none exists (never truncates)."""
    if table_exists(spark, path):
        return
    w = spark.createDataFrame([], schema).write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_table(df: DataFrame, path: str, mode: str = "append", partition_by: list[str] | None = None) -> None:
    """Append or overwrite; overwrite of a partitioned table replaces only the partitions written."""
    if partition_by:
        # let AQE split large partition values and merge small ones: file sizes follow the
        # data, not the number of input tasks
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def assert_unique_keys(source: DataFrame, keys: list[str]) -> None:
    dup = source.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"upsert source has duplicate keys {keys}: {dup[0].asDict()}")


def _merge_on(target: DataFrame, source: DataFrame, keys: list[str], null_safe: bool) -> DataFrame:
    cols = target.columns
    src = source.withColumn("_src", F.lit(True)).alias("s")
    tgt = target.alias("t")
    eq = (lambda k: F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}"))) if null_safe else \
        (lambda k: F.col(f"t.{k}") == F.col(f"s.{k}"))
    joined = tgt.join(src, reduce(lambda a, b: a & b, [eq(k) for k in keys]), "full_outer")
    take_src = F.col("s._src").isNotNull()
    return joined.select(*[F.when(take_src, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in cols])


def merge_upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Update every column of matching keys from source, insert new keys (null-safe match).

    A full outer join on the keys: each side is read and shuffled at most once; a row takes the
    source's values when the source has the key, else the target's. Rows whose keys have no
    nulls join on plain equality, so an input already hash-partitioned on the keys (a gold
    aggregate) is not shuffled again; the rare rows with a null key part join separately with
    null-safe equality."""
    src = source.select(*target.columns)
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    plain = _merge_on(target.filter(~any_null), src.filter(~any_null), keys, null_safe=False)
    nulls = _merge_on(target.filter(any_null), src.filter(any_null), keys, null_safe=True)
    return plain.unionByName(nulls)


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def _same_partitions(target: DataFrame, source: DataFrame, partition_by: list[str]) -> DataFrame:
    """Target rows in the partitions that the source touches, the null partition among them."""
    touched = source.select(*[F.col(c).alias(f"_p{i}") for i, c in enumerate(partition_by)]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_p{i}")) for i, c in enumerate(partition_by)])
    return target.join(touched, same, "left_semi")


def upsert_table(spark: SparkSession, source: DataFrame, path: str, keys: list[str],
                 partition_by: list[str] | None = None, check_unique: bool = True, force_append: bool = False) -> None:
    """J1 on storage: create if absent, else merge and write back; with ``force_append`` the rows are appended unmerged.

    ``partition_by`` must be among ``keys``: otherwise a key that moves to another partition would leave its old row behind.
    The source is computed once, into a staging folder beside the table, and checked and merged from there; the merged
    partitions are staged as well before they replace the old ones. Both stagings are read with the source's schema (partition
    values are never inferred from folder names) and removed at the end. An error before the last step leaves the target as it
    was; the last step replaces partitions one by one and has a single writer."""
    if partition_by and not set(partition_by) <= set(keys):
        raise ValueError(f"partition columns {partition_by} must be among the keys {keys}")
    base = f"{path.rstrip('/')}.__staging-{uuid.uuid4().hex[:12]}"
    staged, merged = f"{base}-source", f"{base}-merged"
    try:
        source.write.mode("errorifexists").parquet(staged)
        incoming = spark.read.schema(source.schema).parquet(staged)
        if force_append:
            write_table(incoming, path, "append", partition_by)
            return
        if check_unique:
            assert_unique_keys(incoming, keys)
        if not table_exists(spark, path):
            write_table(incoming, path, "overwrite", partition_by)
            return
        target = spark.read.schema(source.schema).parquet(path)
        if partition_by:
            target = _same_partitions(target, incoming, partition_by)
        merge_upsert(target, incoming, keys).write.mode("errorifexists").parquet(merged)
        write_table(spark.read.schema(source.schema).parquet(merged), path, "overwrite", partition_by)
    finally:
        for folder in (staged, merged):
            delete_path(spark, folder)


def append_version(spark: SparkSession, df: DataFrame, path: str, operation: str, committed_at: str | None = None) -> int:
    """Append ``df`` to a version table as the next commit and return its number. Each row carries the commit's
    number, time and operation; the table is partitioned by commit. Single writer."""
    newest = None
    if table_exists(spark, path):
        newest = spark.read.parquet(path).agg(F.max("commit_version").alias("v")).first()["v"]
    version = 0 if newest is None else int(newest) + 1
    at = F.current_timestamp() if committed_at is None else F.lit(committed_at).cast("timestamp")
    (df.withColumns({"commit_version": F.lit(version), "committed_at": at, "operation": F.lit(operation)})
     .write.mode("append").partitionBy("commit_version").parquet(path))
    return version


def newest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the largest ``order`` tuple per key, as an aggregate (map-side combined)."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_s"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_s.{c}").alias(c) for c in df.columns])


def as_of_read(versions: DataFrame, as_of: str, keys: list[str],
               order: list[str] = ("commit_version",)) -> DataFrame:
    """The table as of ``as_of``: newest committed row per key."""
    visible = versions.filter(F.col("committed_at") <= F.lit(as_of).cast("timestamp"))
    return newest_per_key(visible, keys, list(order))


def horizon_path(path: str) -> str:
    return f"{path.rstrip('/')}.__horizon"


def retention_horizon(spark: SparkSession, path: str):
    """Newest horizon that retention has set for the version table at ``path``; None if it never ran."""
    mark = horizon_path(path)
    if not table_exists(spark, mark):
        return None
    return spark.read.schema("horizon timestamp").parquet(mark).agg(F.max("horizon")).first()[0]


def _mark_horizon(spark: SparkSession, path: str, horizon: Column) -> None:
    spark.range(1).select(horizon.alias("horizon")).write.mode("append").parquet(horizon_path(path))


def read_as_of(spark: SparkSession, path: str, as_of: str, keys: list[str], order: list[str] = ("commit_version",)) -> DataFrame:
    """S10 on storage: the version table at ``path`` as of ``as_of``. A time before the retention horizon raises ValueError, as the rows that
    were the newest then may be gone."""
    at = F.lit(as_of).cast("timestamp")
    mark = horizon_path(path)
    if table_exists(spark, mark):
        seen = spark.read.schema("horizon timestamp").parquet(mark).agg(F.max("horizon").alias("h"), (F.max("horizon") > at).alias("past")).first()
        if seen["past"]:
            raise ValueError(f"{path} cannot be read as of {as_of}: history before {seen['h']} was removed")
    return as_of_read(spark.read.parquet(path), as_of, keys, order)


def version_history(versions: DataFrame, keys: list[str], n: int = 10) -> DataFrame:
    """The n newest versions with time, operation (as its writer named it) and row metrics."""
    return (versions.groupBy("commit_version").agg(
        F.max("committed_at").alias("committed_at"),
        F.count(F.lit(1)).alias("num_rows"),
        F.countDistinct(*keys).alias("num_keys"),
        F.max("operation").alias("operation"))
        .orderBy(F.desc("commit_version")).limit(n))


def retention_filter(versions: DataFrame, as_of: str, hours: int, keys: list[str],
                     order: list[str] = ("commit_version",)) -> DataFrame:
    """Drop history older than ``hours`` before ``as_of`` but keep, per key, the newest
    row older than the horizon so the table stays readable as of the horizon."""
    horizon = F.lit(as_of).cast("timestamp") - F.make_dt_interval(hours=F.lit(hours))
    recent = versions.filter(F.col("committed_at") >= horizon)
    old = versions.filter(F.col("committed_at") < horizon)
    survivors = newest_per_key(old, keys, list(order))
    return recent.unionByName(survivors)


def apply_retention(spark: SparkSession, path: str, as_of: str, hours: int, keys: list[str],
                    order: list[str] = ("commit_version",)) -> None:
    """S12 on storage, for a table partitioned by commit_version: commits inside the horizon are not touched; of the older ones
    only the surviving rows are staged and put back, in their own partitions, and commits without survivors are removed.
    The horizon is kept beside the table (``horizon_path``), and ``read_as_of`` fails before it."""
    schema = spark.read.parquet(path).schema
    versions = spark.read.schema(schema).parquet(path)
    horizon = F.lit(as_of).cast("timestamp") - F.make_dt_interval(hours=F.lit(hours))
    old = versions.filter(F.col("committed_at") < horizon)
    _mark_horizon(spark, path, horizon)  # first: a read before the horizon fails from now on, rather than see a part of its rows
    before = {r["commit_version"] for r in old.select("commit_version").distinct().collect()}  # one value per commit
    staging = f"{path.rstrip('/')}.__staging-{uuid.uuid4().hex[:12]}"
    try:
        newest_per_key(old, keys, list(order)).write.mode("errorifexists").parquet(staging)
        kept = spark.read.schema(schema).parquet(staging)
        left = {r["commit_version"] for r in kept.select("commit_version").distinct().collect()}
        write_table(kept, path, "overwrite", ["commit_version"])
        for version in sorted(before - left):
            delete_path(spark, f"{path.rstrip('/')}/commit_version={version}")
    finally:
        delete_path(spark, staging)
