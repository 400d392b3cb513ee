"""Alignment against the libraries and a plain walk over bytes."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from zonecast.llm import op11_alignment as O
from zonecast.llm.segments import SIGNS

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
library_a = Tokenizer.from_file(A)
library_a.encode_special_tokens = True
library_b = sentencepiece.SentencePieceProcessor(model_file=B)
signs = {chr(sign): byte for byte, sign in SIGNS.items()}
tokens_a, tokens_b = O.byte_level(A), O.pieces(B)
digests = O.Digests(60_000)


def bytes_a(i):
    return bytes(signs[c] for c in library_a.id_to_token(i))


def bytes_b(i):
    piece = library_b.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if library_b.is_byte(i) else piece.replace("▁", " ").encode()


def plain(text):
    """(ids a, ids b, links, groups text) or None."""
    if not text:
        return None
    a, b = library_a.encode(" " + text, add_special_tokens=False).ids, library_b.encode(text)
    parts = [bytes_a(i) for i in a], [bytes_b(i) for i in b]
    if not all(b"".join(p) == (" " + text).encode() for p in parts):
        return None
    spans = []
    for side in parts:
        at, found = 0, []
        for p in side:
            found.append((at, at + len(p)))
            at += len(p)
        spans.append(found)
    links = [(i, j) for i, (s, e) in enumerate(spans[0]) for j, (t, f) in enumerate(spans[1]) if s < f and t < e]
    cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
    groups, low = [], 0
    for cut in cuts:
        groups.append("|".join(",".join(str(i) for i, (s, e) in zip(ids, side) if low <= s and e <= cut) for ids, side in zip((a, b), spans)))
        low = cut
    return a, b, links, groups


def expected(rows):
    found = [(doc_id, plain(text)) for doc_id, text in rows]
    counts = Counter((f[0][i], f[1][j]) for _, f in found if f for i, j in f[2])
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for doc_id, f in found:
        if f is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, links, groups = f
        each = [counts[a[i], b[j]] for i, j in links]
        out.append((doc_id, len(a), len(b), len(groups), len(links), sum(n == best[b[j]] for n, (_, j) in zip(each, links)), sum(each),
                    hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return sorted(out, key=str)


def actual(frame):
    return sorted([(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)
                   for r in O.align(frame, A, B).collect()], key=str)


PARTS = [" ", "  ", "a", "The", "n't", "\n", "\n\n", "\t", "é", "<|endoftext|>", "</s>", "日", "123", "▁", "\x00", "🙂", " ", "\x1c", "'s", "ing", "ß", "\r", "É", "ÿ×", "÷", "¼", "Äpfel,"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=14), min_size=1, max_size=4))
def test_tokens_equal_the_libraries(parts):
    texts = ["".join(p) for p in parts]
    for text, a, b in zip(texts, tokens_a.ids(texts), tokens_b.ids(texts), strict=True):
        want = plain(text)
        if want is None:
            assert a is None or b is None or not text
        else:
            assert (a.tolist(), b.tolist()) == (want[0], want[1])


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(1, 5), max_size=12), min_size=1, max_size=5), st.data(), st.integers(1, 4))
def test_merge_equals_the_overlaps(parts, data, run):
    other = []
    for sizes in parts:
        total, cut = sum(sizes), []
        while total:
            cut.append(data.draw(st.integers(1, min(total, 6))))
            total -= cut[-1]
        other.append(cut)
    first_a, first_b = (np.concatenate([[0], np.cumsum([len(p) for p in side])]) for side in (parts, other))
    end_a, end_b = (np.cumsum([s for p in side for s in p]).astype(np.int64) for side in (parts, other))
    la, lb, cut_a, cut_b = O.merge(first_a, first_b, end_a, end_b, run)
    start_a, start_b = (np.concatenate([[0], e[:-1]]) if len(e) else e for e in (end_a, end_b))
    want = {(i, j) for i in range(len(end_a)) for j in range(len(end_b)) if start_a[i] < end_b[j] and start_b[j] < end_a[i]}
    assert sorted(zip(la.tolist(), lb.tolist(), strict=True)) == sorted(want)
    assert cut_a.tolist() == [e in set(end_b.tolist()) for e in end_a.tolist()]
    assert cut_b.tolist() == [e in set(end_a.tolist()) for e in end_b.tolist()]


def test_rows(spark, docs, words):
    rows = [(1, words.text(60)), (2, "Hello  world.\n\nIt's <|endoftext|> here</s> "), (3, ""), (4, None), (5, "a▁b"), (None, "x y"), (2, "x y"), (2, "x y"),
            (6, words.text(1500)), (7, " "), (8, "\n")]
    rows += [(20 + i, words.text(i)) for i in range(30)]
    assert actual(docs(rows).repartition(3)) == expected(rows)


def test_batches_of_one_document_and_shorter_runs(spark, docs, words, monkeypatch):
    monkeypatch.setattr(O, "BATCH_CHARS", 50)  # seen by the driver alone: the rows of a task are one batch there
    texts = [words.text(n) for n in (0, 3, 40, 700)]
    for start, end in O.text_ranges(texts, 50):
        out = O.align_batch(tokens_a, tokens_b, digests, texts[start:end])
        for i, text in enumerate(texts[start:end]):
            want = plain(text)
            assert out["n_links"][i] == (len(want[2]) if want else 0)
            assert out["groups_sha256"][i] == (hashlib.sha256(";".join(want[3]).encode()).hexdigest() if want else "")


def test_no_rows_and_clashing_columns(spark, docs):
    assert actual(docs([])) == []
    assert actual(docs([(1, None)])) == [(1, 0, 0, 0, 0, 0, 0, "")]
    wide = docs([(1, "a b")]).withColumn("batch", F.lit("x")).withColumn("pairs", F.lit(None)).withColumn("links", F.lit(1))
    assert actual(wide) == expected([(1, "a b")])


def test_a_sign_that_the_vocabulary_changes_gives_no_tokens():
    assert tokens_b.ids(["a▁b", "fine"])[0] is None
    out = O.align_batch(tokens_a, tokens_b, digests, ["a▁b", "fine", None])
    assert out["n_a"].tolist()[0] == 0
    assert out["n_b"].tolist()[0] == 0
    assert out["groups_sha256"][0] == ""
    assert out["n_links"].tolist()[1] > 0
