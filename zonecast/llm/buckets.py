"""From hash buckets to exact link components, without emitting all pairs of a bucket.

Candidates come as rows (key, node): nodes that share a key are to be compared. In each bucket every
node is first paired with one pivot only (a different pivot in each bucket: the smallest node id under
the bucket's own bit flip); the likeliest pair of each node is verified first, and pairs whose ends are already
connected need no check. What stays open are pairs of a bucket whose ends lie in different components.
In small buckets a join on the key whose condition holds the sketch test finds the likely ones, and they are verified too;
the members of larger buckets are dealt to blocks of bounded size, and each pair of blocks is compared as a
matrix in one task, which gives out a spanning forest of the links it found and no pairs.
Each pair of a bucket is thus verified, excluded by the sketch test or known to lie within one component: the components
are those of all links.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.llm.frames import components, forest_labels, staged

#: (sketch, sketch) -> likelihood of a link, null if it is out of the question.
Score = Callable[[Column, Column], Column]
#: (payloads, payloads) -> which neighbouring pairs are links.
Pairs = Callable[[list[bytes], list[bytes]], np.ndarray]
#: (payloads, payloads) -> matrix of links.
Matrix = Callable[[list[bytes], list[bytes]], np.ndarray]

SMALL_BUCKET = 16
BLOCK = 256


def _open_pairs(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs (a, b) whose ends lie in different components."""
    la = labels.select(F.col("node").alias("a"), F.col("component").alias("label_a"))
    lb = labels.select(F.col("node").alias("b"), F.col("component").alias("label_b"))
    return (pairs.join(la, "a", "left").join(lb, "b", "left")
            .where(F.coalesce("label_a", "a") != F.coalesce("label_b", "b")).select("a", "b"))


def _verified(pairs: DataFrame, payloads: DataFrame, linked: Pairs) -> DataFrame:
    """The pairs (a, b) that are links."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = pa.array(linked(batch.column(2).to_pylist(), batch.column(3).to_pylist()), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(good) for i in (0, 1)], ["a", "b"])

    one = payloads.select(F.col("node").alias("a"), F.col("payload").alias("payload_a"))
    two = payloads.select(F.col("node").alias("b"), F.col("payload").alias("payload_b"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "payload_a", "payload_b")
    return both.mapInArrow(run, "a bigint, b bigint")


def _groups(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.Table]:
    """Runs of rows that agree in the first ``width`` (integer) columns of sorted batches."""
    held: list[pa.RecordBatch] = []
    before = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(i).to_numpy() for i in range(width)])
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        if held and (keys[:, 0] != before).any():
            yield pa.Table.from_batches(held)
            held = []
        edges = [0, *cuts.tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if a:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
        before = keys[:, -1]
    if held:
        yield pa.Table.from_batches(held)


def forest(linked: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what the links of a matrix connect, at most one per row and column."""
    label = {}

    def root(x: int) -> int:
        while label.get(x, x) != x:
            label[x] = label.get(label[x], label[x])
            x = label[x]
        return x

    edges = []
    for i, j in zip(*np.nonzero(linked), strict=True):
        a, b = int(rows[i]), int(columns[j])
        ra, rb = root(a), root(b)
        if ra != rb:
            label[ra] = rb
            edges.append((a, b))
    return edges


def _block_links(matrix: Matrix):
    """Links between members of two blocks that carry different labels."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, 3):
            low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
            block, node, label = (group.column(c).to_numpy() for c in ("block", "node", "label"))
            payload = group.column("payload").to_pylist()
            x, y = np.flatnonzero(block == low), np.flatnonzero(block == high)
            open_pairs = label[x][:, None] != label[y][None, :]
            if open_pairs.any():
                linked = matrix([payload[i] for i in x], [payload[i] for i in y]) & open_pairs
                edges = forest(linked, node[x], node[y])
                yield pa.RecordBatch.from_arrays([pa.array([e[i] for e in edges], pa.int64()) for i in (0, 1)], ["a", "b"])
    return run


def link_components(rows: DataFrame, sketches: DataFrame, payloads: DataFrame, score: Score, linked: Pairs, matrix: Matrix) -> DataFrame:
    """(node, component) of every node that has a link; component = smallest node reachable.

    rows: (key: bigint, node: bigint); sketches: (node, sketch: array<bigint>) and payloads: (node, payload: binary), one
    row per node; ``linked`` and ``matrix`` decide exactly, on payloads."""
    pivots = (rows.groupBy("key").agg(F.min(F.col("node").bitwiseXOR(F.col("key"))).alias("low"), F.count("*").alias("n"))
              .where("n > 1").select("key", F.col("low").bitwiseXOR(F.col("key")).alias("pivot"), "n"))
    shared = staged(rows.join(pivots, "key").select("key", "node", "pivot", "n"), "bucket-rows")

    sa = sketches.select(F.col("node").alias("a"), F.col("sketch").alias("sketch_a"))
    sb = sketches.select(F.col("node").alias("b"), F.col("sketch").alias("sketch_b"))
    stars = staged(shared.where("node <> pivot")
                   .select(F.greatest("node", "pivot").alias("a"), F.least("node", "pivot").alias("b")).distinct()
                   .join(sa, "a").join(sb, "b")
                   .select("a", "b", score(F.col("sketch_a"), F.col("sketch_b")).alias("score"))
                   .where("score is not null"), "bucket-stars")

    # first the likeliest pair of each node, then those that still join two components
    best = stars.groupBy("a").agg(F.max_by("b", "score").alias("b"))
    links = staged(_verified(best, payloads, linked), "bucket-links")
    rest = _open_pairs(stars.select("a", "b"), forest_labels(links)).join(best, ["a", "b"], "left_anti")
    links = links.unionByName(staged(_verified(rest, payloads, linked), "bucket-links"))
    labels = staged(components(links), "bucket-labels")

    labelled = (shared.where("n > 2").join(labels, "node", "left")
                .select("key", "node", "pivot", "n", F.coalesce("component", "node").alias("label")))
    mixed = (labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"))
             .where("low <> high").select("key"))
    # the pivot's own pairs have been scored above
    inside = staged(labelled.where("node <> pivot").join(mixed, "key").select("key", "node", "n", "label"), "bucket-mixed")

    few = inside.where(F.col("n") <= SMALL_BUCKET).join(sketches, "node").select("key", "node", "label", "sketch")
    x, y = few.alias("x"), few.alias("y")
    likely = (x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.label") < F.col("y.label"))
                     & score(F.col("x.sketch"), F.col("y.sketch")).isNotNull())
              .select(F.greatest("x.node", "y.node").alias("a"), F.least("x.node", "y.node").alias("b")).distinct()
              .join(stars, ["a", "b"], "left_anti"))
    found = _verified(likely, payloads, linked)

    blocks = F.ceil(F.col("n") / F.lit(BLOCK)).cast("bigint")
    dealt = (inside.where(F.col("n") > SMALL_BUCKET).join(payloads, "node").withColumn("blocks", blocks)
             .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
             .select("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                     "block", "node", "label", "payload"))
    more = (dealt.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
            .mapInArrow(_block_links(matrix), "a bigint, b bigint"))
    crossing = staged(found.unionByName(more), "bucket-crossing")
    if crossing.isEmpty():
        return labels
    joined = labels.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(crossing)
    return staged(components(joined), "bucket-labels")
