"""Vectorised words against plain Python."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa

from zonecast.llm import words as W

TEXTS = ["", "one", "  two  words ", "Ünï cödé Ünï", "a\tb\nc\r\nd", None, "A a", "x" * 5000 + " y", "tail ", "no-break space"]


def split(texts, table):
    data, offsets = W.flat(pa.array(texts, pa.string()))
    return W.Words(data, offsets, table)


def test_blank_words_match_a_regular_expression():
    w = split(TEXTS, W.BLANKS)
    raw = w.data.tobytes()
    for i, text in enumerate(TEXTS):
        found = [raw[a:b].decode() for a, b in zip(w.starts[w.first[i]:w.first[i + 1]], w.ends[w.first[i]:w.first[i + 1]])]
        assert found == re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_alnum_words_match_a_regular_expression():
    w = split(TEXTS, W.ALNUM)
    raw = w.data.tobytes()
    for i, text in enumerate(TEXTS):
        found = [raw[a:b].decode() for a, b in zip(w.starts[w.first[i]:w.first[i + 1]], w.ends[w.first[i]:w.first[i + 1]])]
        assert found == re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")


def test_hash_depends_on_the_lower_cased_word_only():
    w = split(["Alpha beta", "xx ALPHA", "beta gamma alpha", "alph a"], W.BLANKS)
    h = w.hashes
    assert h[0] == h[3] == h[6] and h[1] == h[4]
    assert len({int(x) for x in h}) == 6  # alpha, beta, xx, gamma, alph, a


def test_long_texts_hash_as_short_ones(words):
    text = words.text(400_000)  # several segments
    assert len(text) > 2 * W.SEGMENT
    whole = split([text], W.BLANKS).hashes
    parts = text.split()
    some = split([" ".join(parts[1000:1010])], W.BLANKS).hashes
    assert (whole[1000:1010] == some).all()
    assert len(whole) == len(parts)


def test_slices_cover_all_rows_once():
    offsets = np.array([0, 5, 5, 30, 31, 90, 91])
    got = list(W.slices(offsets, 20))
    assert [a for a, _ in got] == [0] + [b for _, b in got][:-1] and got[-1][1] == 6


def test_shingle_sets():
    w = split(["a b c d", "a b", "", "a b c a b c"], W.BLANKS)
    sizes = [len(s) for s in W.shingle_sets(w, 3)]
    assert sizes == [2, 1, 0, 3]
