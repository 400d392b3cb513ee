"""Operator 10: variable-capacity best-fit packing of documents into training sequences.

A document's length is its number of words plus one end mark; a document longer than the largest permitted sequence is cut
into full pieces and a rest. Pieces are packed in shards of bounded size, longest first: a piece goes into the open
sequence with the least room that still takes it, else a new one is opened. The permitted lengths are optimised jointly: at each
opening, every length that takes the piece is filled in thought with the longest pieces still to place, and the one of least cost per
token is opened (a sequence costs the smallest permitted length that holds its contents plus a fixed overhead; ties go to
the smaller length). So one plan mixes lengths as the pieces that are left demand. The plans that open one least length
throughout are made too, and the plan of least total cost is taken; every sequence is then downsized to its contents.

Only (doc_id, length) leaves the scan. Lengths are written once, and each piece is dealt to a shard by its row's place in that
table and its number, so repeated or null doc_ids and the pieces of one giant document spread like any others; the number of shards follows
the number of pieces, and a shard is one bounded group. The loss against one global packing is at most one partly filled set of
sequences per shard.

Defined results: a null or empty text, or one without words, is returned with null sequence_id and no tokens; each row of a
repeated doc_id is packed; only doc_id and text are read, so extra columns cannot clash; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm import words as W
from zonecast.llm.frames import staged

CAPACITIES = (512, 1024, 2048, 4096)
OVERHEAD = 16
SHARD_ROWS = 20_000

PACKED = ("sequence_id bigint, capacity bigint, start bigint, doc_id string, piece bigint, first_token bigint, n_tokens bigint")


class Opener:
    """Length of each new sequence by its cost against the pieces still to place (``sizes`` in any order)."""

    def __init__(self, sizes: list[int], capacities: tuple[int, ...], overhead: int):
        left = Counter(sizes)
        self.capacities, self.overhead = capacities, overhead
        self.sizes = sorted(left)
        self.left = [left[s] for s in self.sizes]

    def placed(self, size: int) -> None:
        self.left[bisect_left(self.sizes, size)] -= 1

    def filled(self, room: int) -> int:
        """Tokens of the longest pieces left that go into ``room``, longest first."""
        got, at = 0, len(self.sizes)
        while (at := bisect_right(self.sizes, room - got, 0, at) - 1) >= 0:
            got += min(self.left[at], (room - got) // self.sizes[at]) * self.sizes[at]
        return got

    def __call__(self, size: int) -> int:
        """``size``: the piece that opens, already counted as placed."""
        best = None
        for c in self.capacities[bisect_left(self.capacities, size):]:
            tokens = size + self.filled(c - size)
            cost = (self.capacities[bisect_left(self.capacities, tokens)] + self.overhead) / tokens
            if best is None or cost < best[0]:
                best = cost, c
        return best[1]


def best_fit(sizes: list[int], capacities: tuple[int, ...], opening: int | Opener) -> tuple[list[int], list[int]]:
    """Sequence of each piece (sizes in descending order) and the filled length of each sequence; a new one has the length that the
    opener names, or the least permitted length that is at least ``opening`` and takes the piece."""
    choose = opening if isinstance(opening, Opener) else None
    rooms: list[tuple[int, int]] = []  # (room left, sequence) of open sequences, sorted
    place, filled = [], []
    for size in sizes:
        if choose is not None:
            choose.placed(size)
        at = bisect_left(rooms, (size, -1))
        if at < len(rooms):
            room, sequence = rooms.pop(at)
        else:
            room = choose(size) if choose is not None else capacities[bisect_left(capacities, max(size, opening))]
            sequence = len(filled)
            filled.append(0)
        place.append(sequence)
        filled[sequence] += size
        if room > size:
            insort(rooms, (room - size, sequence))
    return place, filled


def downsized(filled: list[int], capacities: tuple[int, ...]) -> list[int]:
    return [capacities[bisect_left(capacities, f)] for f in filled]


def pack(sizes: list[int], capacities: tuple[int, ...] = CAPACITIES, overhead: int = OVERHEAD) -> tuple[list[int], list[int]]:
    """Least-cost plan (ties: the mixed one, then the smaller opening length): sequence of each piece, final length of each sequence."""
    best = None
    for opening in (Opener(sizes, capacities, overhead), *capacities):
        place, filled = best_fit(sizes, capacities, opening)
        final = downsized(filled, capacities)
        cost = sum(final) + overhead * len(final)
        if best is None or cost < best[0]:
            best = cost, place, final
    return best[1], best[2]


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = W.flat(batch.column(1))
        for a, b in W.slices(offsets):
            base = offsets[a]
            starts, _ = W.word_bounds(data[base:offsets[b]], offsets[a:b + 1] - base, W.BLANKS)
            counts = np.diff(np.searchsorted(starts, offsets[a:b + 1] - base))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), pa.array(np.where(counts, counts + 1, 0), pa.int64())], ["doc_id", "n_tokens"])


def word_lengths(docs: DataFrame) -> DataFrame:
    """(doc_id, n_tokens): words and an end mark, 0 without words."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _lengths, "doc_id bigint, n_tokens bigint")


def _pack_shard(capacities: tuple[int, ...], overhead: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "row", "piece"], ascending=[False, True, True], ignore_index=True)
        sizes = rows["size"].tolist()
        place, final = pack(sizes, capacities, overhead)
        at = [0] * len(final)
        starts = []
        for size, sequence in zip(sizes, place, strict=True):
            starts.append(at[sequence])
            at[sequence] += size
        shard = int(rows["shard"].iloc[0])
        return pd.DataFrame({"sequence_id": [(shard << 32) | s for s in place], "capacity": [final[s] for s in place], "start": starts,
                             "doc_id": rows["doc_id"], "piece": rows["piece"], "first_token": rows["first_token"], "n_tokens": sizes})
    return run


def pack_lengths(lengths: DataFrame, capacities: tuple[int, ...] = CAPACITIES, overhead: int = OVERHEAD,
                 shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Packed pieces of (doc_id, n_tokens): sequence_id, capacity, start in the sequence, doc_id, piece, first_token, n_tokens."""
    capacities = tuple(sorted(capacities))
    largest = F.lit(capacities[-1]).cast("bigint")
    lengths = staged(lengths.select("doc_id", "n_tokens"), "lengths")
    # shards follow pieces, not rows
    total = lengths.agg(F.coalesce(F.sum(F.ceil(F.col("n_tokens") / largest)), F.lit(0)).alias("n")).first()["n"]
    shards = max(1, -(-int(total) // shard_rows))
    pieces = (lengths.withColumn("row", F.monotonically_increasing_id()).where("n_tokens > 0")
              .select(F.col("doc_id").cast("string").alias("doc_id"), "row", "n_tokens",  # pandas has no null integers
                      F.posexplode(F.sequence(F.lit(0).cast("bigint"), F.col("n_tokens") - 1, largest)).alias("piece", "first_token")))
    dealt = pieces.select("doc_id", "row", F.col("piece").cast("bigint").alias("piece"), "first_token",
                          F.least(largest, F.col("n_tokens") - F.col("first_token")).alias("size"),
                          F.pmod(F.xxhash64("row", "piece"), F.lit(shards)).alias("shard"))
    packed = dealt.groupBy("shard").applyInPandas(_pack_shard(capacities, overhead), PACKED).withColumn(
        "doc_id", F.col("doc_id").cast("bigint"))
    empty = lengths.where("n_tokens = 0").select(
        F.lit(None).cast("bigint").alias("sequence_id"), F.lit(None).cast("bigint").alias("capacity"),
        F.lit(None).cast("bigint").alias("start"), "doc_id", F.lit(0).cast("bigint").alias("piece"),
        F.lit(0).cast("bigint").alias("first_token"), "n_tokens")
    return packed.unionByName(empty)


def pack_documents(docs: DataFrame, capacities: tuple[int, ...] = CAPACITIES) -> DataFrame:
    return pack_lengths(word_lengths(docs), capacities)
