"""Token counts against the library, whole and in chunks."""

from __future__ import annotations

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from zonecast.llm import op3_tokens as T

MODEL = public_tokenizers.path("piece_bpe_32k.model")
machine = T.Transducer(MODEL)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "a", "the", "\n", "▁", "é", "<s>", "</s>", "日", "\t", "ing", " ", "\x00", "🙂"]), max_size=40),
       st.integers(1, 9))
def test_counts_equal_the_library(parts, chunk):
    text = "".join(parts)
    want = len(machine.model.encode(text))
    assert T.count_tokens(machine, text) == want
    assert T.count_tokens(machine, text, chunk) == want


@given(st.lists(st.sampled_from([" ", "a", "b ", " c"]), min_size=3, max_size=12))
def test_composition_is_associative(parts):
    a, b, c = ("".join(parts[i::3]) or "x" for i in range(3))
    maps = [T.chunk_map(machine, x) for x in (a, b, c)]
    left = T.compose(machine, T.compose(machine, maps[0], maps[1]), maps[2])
    right = T.compose(machine, maps[0], T.compose(machine, maps[1], maps[2]))
    assert left == right


def test_a_full_table_is_emptied_and_refilled(words):
    small = T.Transducer(MODEL, entries=50)
    small.machine.limit = 200
    text = words.text(500)
    assert T.count_tokens(small, text) == len(machine.model.encode(text))
    assert len(small.table) <= 50 and len(small.machine.states) <= 2 * 200 + 1
    unbroken = text.replace(" ", "")
    assert T.count_tokens(small, unbroken) == len(machine.model.encode(unbroken))


def test_rows(spark, docs, words):
    long = words.text(60_000)
    rows = [(1, ""), (2, None), (3, "a  b "), (None, "x y"), (3, "a  b "), (4, long), (5, "é<s>")]
    out = {(r.doc_id, r.n_bytes): r for r in T.token_counts(docs(rows), MODEL).collect()}
    for doc_id, text in rows:
        r = out[doc_id, len((text or "").encode())]
        assert r.n_tokens == len(machine.model.encode(text or ""))
        assert r.over_limit == (r.n_tokens > 4096)
    assert T.token_counts(docs(rows), MODEL).count() == len(rows)


def test_empty_table_and_extra_columns(spark, docs):
    assert T.token_counts(docs([]), MODEL).count() == 0
    from pyspark.sql import functions as F

    wide = docs([(1, "a b")]).withColumn("n_tokens", F.lit("x")).withColumn("n_bytes", F.lit(None))
    assert T.token_counts(wide, MODEL).first().n_tokens == len(machine.model.encode("a b"))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(300, machine.model.get_piece_size() - 1), min_size=1, max_size=6), st.integers(0, 20), st.sampled_from(["", "é", "日", "\n", "🙂"]))
def test_pieces_side_by_side(ids, cut, sign):
    """Joined vocabulary pieces, cut anywhere, with a sign that may have no piece: every place where a longer token takes the place of several."""
    text = "".join(machine.model.id_to_piece(i) for i in ids).replace(T.MARK, " ")
    text = text[:cut] + sign + text[cut:]
    assert T.count_tokens(machine, text) == len(machine.model.encode(text))


def test_machine_of_a_small_vocabulary():
    """Merges against a walk by hand: best score first, the left pair among equals."""
    m = T.Machine({"a": 0.0, "b": 0.0, "ab": -1.0, "aa": -2.0, "aba": -3.0, "aab": -4.0, "abab": -5.0})
    for length in range(1, 9):
        for bits in range(1 << length):
            text = "".join("ab"[bits >> i & 1] for i in range(length))
            assert m.count(text) == len(m.merged(text)), text
    assert m.merged("aaab") == ["aa", "ab"] and m.count("aaab") == 2
    assert m.count("ab日ab") == 1 + 3 + 1 and m.count("") == 0
    assert len(m.states) < 100  # finite: states do not grow with the texts


def test_a_model_that_drops_blanks_is_refused(monkeypatch):
    class Dropping:
        def get_piece_size(self):
            return 1

        def id_to_piece(self, i):
            return "▁a▁b"

    t = object.__new__(T.Transducer)
    t.model = Dropping()
    with pytest.raises(ValueError, match="spans a blank"):
        t.check()
