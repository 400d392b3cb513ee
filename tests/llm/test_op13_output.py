"""Binary shards of token ids against the library, and their index against plain dictionaries."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from zonecast.llm import op13_output as O
from zonecast.llm import segments as S
from zonecast.session import work_dir

PATH = public_tokenizers.path("word_bpe_49k.json")
words_model = S.WordTokenizer(PATH)
SIGNS = [" ", "a", "The", "don't", "\n", "\t", "é", "É", "<|endoftext|>", "<", "|>", "日", "123", "'s", "\x1c", " ", "İ", "́", "🙂", "'", "\x00", "ǅ", "ÿ×", "÷", "¼", "Äpfel,", "µ"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(SIGNS), max_size=25))
def test_ids_equal_the_library(parts):
    text = "".join(parts)
    want = words_model.model.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(words_model.ids([text])[0], "<u2").tolist() == want


def test_a_full_table_is_emptied(words):
    small = S.WordTokenizer(PATH, entries=20)
    texts = [words.text(50) for _ in range(5)]
    want = [e.ids for e in small.model.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(small.ids([t])[0], "<u2").tolist() for t in texts] == want


def test_a_tokenizer_with_blanks_in_its_matches_is_read_text_by_text():
    other = S.WordTokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    assert not other.by_segment
    assert np.frombuffer(other.ids(["a  b"])[0], "<u2").tolist() == other.model.encode("a  b").ids


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(-(1 << 63), (1 << 63) - 1), max_size=400))
def test_perfect_hash_is_minimal_and_perfect(keys):
    keys = np.array(sorted(keys), np.int64)
    slots = O.PerfectHash.build(keys).slots(keys)
    assert sorted(slots.tolist()) == list(range(len(keys)))


def test_perfect_hash_of_many_keys_stays_small_and_shallow():
    keys = np.arange(200_000, dtype=np.int64)
    index = O.PerfectHash.build(keys)
    assert len(np.unique(index.slots(keys))) == len(keys)
    assert len(index.sizes) < 40
    assert index.sizes.sum() < 5 * len(keys)


def test_equal_keys_are_refused():
    with pytest.raises(ValueError, match="must differ"):
        O.PerfectHash.build(np.array([3, 3], np.int64))


def test_shard_gives_keys_and_turns_others_away():
    keys = np.array([0, 0, 5, 7, 7, 7, 1 << 62], np.int64)
    nulls = np.array([True, True, False, False, False, False, False])
    payloads = [np.arange(i, dtype="<u2").tobytes() for i in range(7)]
    shard = O.from_bytes(O.build_shard(keys, nulls, payloads, 2))
    first, copies = shard.find(np.array([5, 7, 1 << 62, 0, 6, -7]))
    assert copies.tolist() == [1, 3, 1, 0, 0, 0]
    assert first[:3].tolist() == [2, 3, 6]
    assert shard.ids(*shard.span(6)).tolist() == list(range(6))
    assert not O.from_bytes(O.build_shard(keys[:1], nulls[:1], payloads[:1], 2)).find(np.array([0, 1]))[1].any()
    random_keys = np.array(random.Random(1).sample(range(10**9, 10**12), 20_000))
    assert not shard.find(random_keys)[1].any()


def expected(rows):
    """doc_id -> [(n, crc)] and the ids' total."""
    out, total = {}, 0
    for doc_id, text in rows:
        ids = [*words_model.model.encode(text or "", add_special_tokens=False).ids, 1]
        out.setdefault(doc_id, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        total += len(ids)
    return out, total


def written(spark, frame, **options):
    folder = work_dir(spark, "test-ids")
    return folder, O.write_ids(frame, PATH, folder, **options)


def test_round_trip_over_many_shards(spark, docs, words):
    rows = [(None, "no key"), (None, None), (7, ""), (7, "same"), (7, "same"), (-3, "A  b\n"), (8, words.text(4000)), (9, "x<|endoftext|>y")]
    rows += [(100 + i, words.text(i % 40)) for i in range(300)]
    folder, manifest = written(spark, docs(rows).repartition(4), shard_bytes=3000)
    assert manifest.count() > 5
    found = sorted(O.read_back(spark, folder, manifest).collect(), key=lambda r: r.start)
    want, total = expected(rows)
    got = {}
    place = 0
    for r in found:
        assert r.start == place
        place += r.n_tokens
        got.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_crc32))
    assert place == total
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    order = [r.doc_id for r in found]
    assert order == sorted(order, key=lambda k: (k is not None, k))


def test_keyed_access(spark, docs, words):
    rows = [(i * 3, words.text(5 + i % 7)) for i in range(200)] + [(12, "again")]
    folder, manifest = written(spark, docs(rows), shard_bytes=1500)
    asked = docs([(k, None) for k in (0, 12, 12, 13, 597, 10**9, None)])
    got = O.lookup(asked, folder, manifest).collect()
    starts = {(r.doc_id, r.start): r.n_tokens for r in O.read_back(spark, folder, manifest).collect()}
    assert sorted(r.doc_id for r in got) == [0, 12, 12, 597]
    for r in got:
        assert starts[r.doc_id, r.start] == len(r.ids)
        assert r.ids[-1] == 1
    assert [*words_model.model.encode("again", add_special_tokens=False).ids, 1] in [r.ids for r in got]


def test_empty_table_and_clashing_columns(spark, docs):
    folder, manifest = written(spark, docs([]))
    assert O.read_back(spark, folder, manifest).count() == 0
    wide = docs([(1, "a")]).withColumn("start", F.lit("x")).withColumn("h", F.lit(None)).withColumn("row", F.lit(1)).withColumn("shard", F.lit(0))
    folder, manifest = written(spark, wide)
    assert [(r.doc_id, r.start, r.n_tokens) for r in O.read_back(spark, folder, manifest).collect()] == [(1, 0, 2)]


def test_an_attempt_that_did_not_finish_is_not_read(spark, docs):
    folder, manifest = written(spark, docs([(1, "a b")]))
    files, root = O._filesystem(folder)
    with files.open_output_stream(f"{root}/_attempt-lost") as out:
        out.write(b"half a fi")
    assert O.read_back(spark, folder, manifest).count() == 1
