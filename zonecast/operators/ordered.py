"""Order-dependent operators without a single-partition window.

``running_totals`` computes, for every row, running sums of weight columns over
a global sort order. It range-partitions on the order key (equal keys never
straddle partitions; ranges are sampled from the data, so a hot hour or a hot
zone is split across tasks rather than landing in one), sorts within
partitions, cuts lineage with a reliable ``checkpoint`` so both passes see the
same partitions, collects one small total per *partition* (bounded by the
partition count, not the data) and adds the offsets in an Arrow-batched
``mapInArrow`` pass.

On top of it:
* ``rolling_window`` (W1, W2): count and sums over ``[ts - w, ts]`` for every event,
  as the difference of running totals at two probes; a partition key (e.g. zone)
  is simply the leading sort column, because both probes of an event lie in the
  same key block.
* ``global_position`` / ``chronological_split`` (W4): 1-based rank in (time, id)
  order and an 80/20 cut at floor(0.8 n).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.session import checkpoint_root


def _ordered(df: DataFrame, order: list[Column], partitions: int | None) -> DataFrame:
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    checkpoint_root(spark)
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    return ranged.checkpoint(eager=True)


def running_totals(df: DataFrame, order: list[Column], weights: list[str],
                   partitions: int | None = None, prefix: str = "cum_") -> tuple[DataFrame, dict[str, int]]:
    """Inclusive running sums of integer ``weights`` over the global ``order``.

    Rows with equal order keys get running sums in an arbitrary but fixed order
    among themselves. Returns the frame (with ``{prefix}{w}`` columns) and the
    grand totals.
    """
    ranged = _ordered(df, order, partitions)
    per_part = (ranged.groupBy(F.spark_partition_id().alias("_pid"))
                .agg(*[F.sum(w).alias(w) for w in weights]).collect())
    offsets: dict[int, list[int]] = {}
    acc = [0] * len(weights)
    for row in sorted(per_part, key=lambda r: r["_pid"]):
        offsets[row["_pid"]] = list(acc)
        acc = [a + int(row[w] or 0) for a, w in zip(acc, weights)]
    totals = dict(zip(weights, acc))

    out_schema = T.StructType(list(ranged.schema.fields)
                              + [T.StructField(f"{prefix}{w}", T.LongType(), True) for w in weights])

    def add_offsets(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        run = list(offsets.get(TaskContext.get().partitionId(), [0] * len(weights)))
        for batch in batches:
            # the other columns go through as they are
            columns, names = list(batch.columns), list(batch.schema.names)
            for j, w in enumerate(weights):
                cs = batch.column(w).cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False).cumsum(dtype=np.int64) + run[j]
                if len(cs):
                    run[j] = int(cs[-1])
                columns.append(pa.array(cs, pa.int64()))
                names.append(f"{prefix}{w}")
            yield pa.RecordBatch.from_arrays(columns, names)

    return ranged.mapInArrow(add_offsets, out_schema), totals


def rolling_window(df: DataFrame, id_col: str, ts_col: str, seconds: int, key_col: str | None = None,
                   sum_cols: tuple[str, ...] = (), partitions: int | None = None) -> DataFrame:
    """For every row with a time: number of rows (same key, if given) with time in
    [ts - seconds, ts] (both edges included) and the sums of ``sum_cols`` (integer
    columns, nulls as 0) over the same rows. Ids may be null or repeated: one row out per row in.

    Each event becomes three rows by one generator, so the input is read once: a data row (weight 1) and two probes of
    weight 0, a lower one at ts - seconds sorted before equal-time data rows and an upper one at ts sorted after them. The
    window is (running total at the upper probe) - (running total at the lower probe). The probes meet in one
    grouping by (id, time, key): rows that agree in these have the same window, and are given out as often as they came.
    """
    t = F.col(ts_col)
    sums = [F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")) for c in sum_cols]
    key = F.col(key_col) if key_col else F.lit(0)

    def row(time: Column, tie: int) -> Column:
        weight = [(F.lit(1 if tie == 1 else 0).cast("long")).alias("_n")]
        weight += [(s if tie == 1 else F.lit(0).cast("long")).alias(f"_s{i}") for i, s in enumerate(sums)]
        return F.struct(time.alias("_t"), F.lit(tie).alias("_tie"), *weight)

    lower = t - F.make_dt_interval(secs=F.lit(seconds))
    rows = (df.filter(t.isNotNull())
            .select(key.alias("_k"), F.col(id_col).alias("_id"), t.alias("_at"),
                    F.inline(F.array(row(lower, 0), row(t, 1), row(t, 2))))
            .withColumn("_h", F.xxhash64("_id")))
    # rows with equal (key, time, tie) may sit in any order without changing a probe's total;
    # the id hash as last sort column lets range partitioning split even a single hot instant
    weights = ["_n", *[f"_s{i}" for i in range(len(sums))]]
    totals, _ = running_totals(rows, [F.col("_k"), F.col("_t"), F.col("_tie"), F.col("_h")], weights, partitions)
    upper_at, lower_at = F.col("_tie") == 2, F.col("_tie") == 0
    windows = totals.where(F.col("_tie") != 1).groupBy("_id", "_at", "_k").agg(
        F.sum(upper_at.cast("int")).alias("_copies"),
        *[(F.max(F.when(upper_at, F.col(f"cum_{w}"))) - F.max(F.when(lower_at, F.col(f"cum_{w}")))).alias(f"w{w}") for w in weights])
    # equal probes have equal totals, so any of a group's rows tells
    out = [F.col("_id").alias(id_col), F.col("_at").alias(ts_col)]
    if key_col:
        out.append(F.col("_k").alias(key_col))
    out.append(F.col("w_n").alias("window_count"))
    out += [F.col(f"w_s{i}").alias(f"window_sum_{c}") for i, c in enumerate(sum_cols)]
    return windows.select(*out, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("_copy")).drop("_copy")


def global_position(df: DataFrame, order: list[Column], partitions: int | None = None
                    ) -> tuple[DataFrame, int]:
    """1-based position of every row in the global ``order`` (make it unique for a stable rank)."""
    ranked, totals = running_totals(df.withColumn("_one", F.lit(1)), order, ["_one"], partitions, prefix="pos")
    return ranked.withColumnRenamed("pos_one", "position").drop("_one"), totals["_one"]


def chronological_split(df: DataFrame, ts_col: str, id_col: str, train_fraction: float = 0.8,
                        partitions: int | None = None) -> DataFrame:
    """Earliest floor(fraction x n) rows (by time, then id; missing times last) are train."""
    order = [F.col(ts_col).isNull(), F.col(ts_col), F.col(id_col)]
    ranked, n = global_position(df, order, partitions)
    cut = int(n * train_fraction)
    return ranked.withColumn("split", F.when(F.col("position") <= cut, "train").otherwise("test"))
