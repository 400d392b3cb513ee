"""Packing: a plain best-fit on the same pieces, and invariants."""

from __future__ import annotations

from collections import defaultdict

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from zonecast.llm import op10_packing as P

CAPS = (8, 16, 32)


def plain_best_fit(sizes, capacities, opening, overhead=3):
    """``opening``: least length throughout, or None for the length of least cost per token at each opening."""
    bins = []  # [room, contents]
    place = []
    for at, s in enumerate(sizes):
        fits = [(b[0], i) for i, b in enumerate(bins) if b[0] >= s]
        if fits:
            _, i = min(fits)
        else:
            length = min(c for c in capacities if c >= max(s, opening or 0))
            if opening is None:
                offers = []
                for c in capacities:
                    if c >= s:
                        held = s
                        for other in sizes[at + 1:]:
                            held += other if held + other <= c else 0
                        offers.append(((min(x for x in capacities if x >= held) + overhead) / held, c))
                length = min(offers)[1]
            bins.append([length, 0])
            i = len(bins) - 1
        bins[i][0] -= s
        bins[i][1] += s
        place.append(i)
    return place, [b[1] for b in bins]


@given(st.lists(st.integers(1, 32), max_size=60))
def test_best_fit_is_the_plain_one(sizes):
    sizes = sorted(sizes, reverse=True)
    assert P.best_fit(sizes, CAPS, P.Opener(sizes, CAPS, 3)) == plain_best_fit(sizes, CAPS, None)
    costs = []
    for opening in (None, *CAPS):
        if opening:
            assert P.best_fit(sizes, CAPS, opening) == plain_best_fit(sizes, CAPS, opening)
        filled = plain_best_fit(sizes, CAPS, opening)[1]
        costs.append(sum(min(c for c in CAPS if c >= f) + 3 for f in filled))
    place, final = P.pack(sizes, CAPS, overhead=3)
    assert sum(final) + 3 * len(final) == min(costs)
    load = defaultdict(int)
    for s, p in zip(sizes, place, strict=True):
        load[p] += s
    assert all(final[p] == min(c for c in CAPS if c >= n) for p, n in load.items())


def test_one_plan_mixes_lengths():
    sizes = [30, 17, 15, 8, 7, 6, 2, 2]
    _, filled = P.best_fit(sizes, CAPS, P.Opener(sizes, CAPS, 3))
    assert len(set(P.downsized(filled, CAPS))) > 1


def test_one_giant_document_is_spread(spark):
    out = P.pack_lengths(spark.createDataFrame([(1, 32 * 1000 + 5), (2, 3)], "doc_id bigint, n_tokens bigint"), CAPS, shard_rows=100)
    rows, pieces = check(out, [(1, 32 * 1000 + 5), (2, 3)])
    assert len({r.sequence_id >> 32 for r in rows}) == 11
    assert sorted(pieces[1]) == [(i * 32, 32) for i in range(1000)] + [(32000, 5)]


def check(out, lengths):
    rows = out.collect()
    packed = [r for r in rows if r.sequence_id is not None]
    assert sum(r.n_tokens for r in rows) == sum(n for _, n in lengths)
    by_sequence = defaultdict(list)
    for r in packed:
        by_sequence[r.sequence_id].append(r)
    for members in by_sequence.values():
        members.sort(key=lambda r: r.start)
        at = 0
        for r in members:
            assert r.start == at
            at += r.n_tokens
        assert {r.capacity for r in members} == {min(c for c in CAPS if c >= at)}
    pieces = defaultdict(list)
    for r in packed:
        pieces[r.doc_id].append((r.first_token, r.n_tokens))
    return rows, pieces


def test_every_token_is_packed_once(spark, words):
    lengths = [(i, 1 + words.pick(70)) for i in range(400)] + [(1000, 0), (1001, 500)]
    out = P.pack_lengths(spark.createDataFrame(lengths, "doc_id bigint, n_tokens bigint"), CAPS, shard_rows=100)
    rows, pieces = check(out, lengths)
    for doc_id, n in lengths:
        at = 0
        for first, size in sorted(pieces[doc_id]):
            assert first == at
            at += size
        assert at == n
    assert len({r.sequence_id >> 32 for r in rows if r.sequence_id is not None}) > 1
    waste = sum({r.sequence_id: r.capacity for r in rows if r.sequence_id is not None}.values()) / sum(n for _, n in lengths)
    assert waste < 1.1


def test_repeats_nulls_empty_texts_and_large_ids(spark, docs):
    big = (1 << 60) + 1
    df = docs([(1, "a b"), (1, "a b"), (None, "c"), (None, "c"), (2, ""), (3, None), (4, " \n"), (big, "d e")]).withColumn("row", F.lit(1))
    out = sorted([(r.doc_id, r.n_tokens, r.sequence_id is None) for r in P.pack_documents(df).collect()], key=str)
    assert out == sorted([(1, 3, False), (1, 3, False), (None, 2, False), (None, 2, False), (2, 0, True), (3, 0, True), (4, 0, True),
                          (big, 3, False)], key=str)
    assert P.pack_documents(docs([])).count() == 0


def test_hot_document_id_is_spread(spark):
    lengths = spark.range(3000).select(F.lit(7).cast("bigint").alias("doc_id"), F.lit(5).cast("bigint").alias("n_tokens"))
    shards = {r.sequence_id >> 32 for r in P.pack_lengths(lengths, CAPS, shard_rows=300).collect()}
    assert len(shards) == 10
