"""Benchmark passages against brute force."""

from __future__ import annotations

import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.llm import op9_decontaminate as D

ITEM = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def norm(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, items, window=10):
    out = []
    for doc_id, text in rows:
        words, hit, found = norm(text), set(), set()
        for item_id, body in items:
            w = norm(body)
            size = min(len(w), window)
            for i in range(len(w) - size + 1 if w else 0):
                for at in range(len(words) - size + 1):
                    if words[at:at + size] == w[i:i + size]:
                        hit.update(range(at, at + size))
                        found.add("null" if item_id is None else str(item_id))
        out.append((doc_id, len(words), len(hit), tuple(sorted(found))))
    return sorted(out, key=str)


def fixture(words):
    items = [(i, words.text(12 + words.pick(20))) for i in range(30)]
    items += [(30, "kaka lolo mimi"), (31, ""), (32, None), (33, "!!"), (None, words.text(11)), (4, items[4][1]), (34, items[5][1] + " tail"),
              (35, "ka " * 14)]
    rows = []
    for i in range(80):
        parts = [words.text(20)]
        if i % 3 == 0:
            parts.append(items[words.pick(30)][1].upper().replace(" ", ", "))
        if i % 5 == 0:
            parts.append(" ".join(items[words.pick(30)][1].split()[1:11]))
        if i % 7 == 0:
            parts.append("Kaka-LOLO\nmimi")
        if i % 11 == 0:
            parts.append(items[34][1])
        parts.append(words.text(10))
        rows.append((i, " ".join(parts)))
    rows += [(100, ""), (101, None), (102, "ka " * 30), (None, items[0][1]), (3, rows[3][1]), (103, words.text(20_000) + " " + items[2][1])]
    return rows, items


def got(df):
    return sorted([(r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in df.collect()], key=str)


def test_against_brute_force(spark, docs, words):
    rows, items = fixture(words)
    table = spark.createDataFrame(items, ITEM)
    want = brute(rows, items)
    assert got(D.find_passages(docs(rows), table)) == want
    # many small blocks give the same
    assert got(D.find_passages(docs(rows), table, block_symbols=700)) == want


def test_spans_are_places_of_the_original(spark, docs):
    text = "Ünd: Foo, BAR baz! Foo bar"
    out = D.find_passages(docs([(1, text)]), spark.createDataFrame([(1, "foo bar")], ITEM)).first()
    assert [text[s.start:s.end] for s in out.spans] == ["Foo, BAR", "Foo bar"]


def test_long_item_in_pieces(spark, docs, words):
    long = words.text(900)
    parts = long.split()
    rows = [(i, " ".join(parts[i:i + 10])) for i in range(0, 890, 7)]
    out = D.find_passages(docs(rows), spark.createDataFrame([(1, long)], ITEM), block_symbols=1000).collect()
    assert all(r.n_hit == 10 and r["items"] == ["1"] for r in out)


def test_drop_contaminated_keeps_whole_rows(spark, docs):
    df = docs([(1, "a b c"), (2, "clean"), (None, "x a b"), (None, None)]).withColumn("items", F.lit(1)).withColumn("hits", F.lit("h"))
    out = D.drop_contaminated(df, spark.createDataFrame([(1, "a b")], ITEM))
    assert out.columns == df.columns
    assert sorted([(r.doc_id, r.text, r["items"], r.hits) for r in out.collect()], key=str) == sorted(
        [(2, "clean", 1, "h"), (None, None, 1, "h")], key=str)


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], ITEM)
    assert D.find_passages(docs([]), none).count() == 0
    assert got(D.find_passages(docs([(1, "a b")]), none)) == [(1, 2, 0, ())]


def test_a_block_has_no_more_words_than_there_are_signs(monkeypatch):
    """More distinct words than code points: a block closes before it runs out, whatever size is asked for."""
    class Rows:
        def select(self, *_):
            return self

        where = select

        def toLocalIterator(self):  # noqa: N802
            for i in range(130_000):
                yield type("R", (), {"item_id": str(i), "text": " ".join(f"w{i}x{k}" for k in range(10)).encode()})()

    monkeypatch.setattr(D.F, "col", lambda *_: _Any())
    monkeypatch.setattr(D.F, "coalesce", lambda *_: _Any())
    monkeypatch.setattr(D.F, "lit", lambda *_: _Any())
    blocks = list(D.benchmark_blocks(Rows(), 10, 50_000_000))
    assert max(len({w for _, words, _ in block for w in words}) for block in blocks) <= D.BLOCK_SYMBOLS
    assert sum(len(block) for block in blocks) == 130_000
    assert ord(D._symbol(D.BLOCK_SYMBOLS + 10)) < 0x10FFFF


class _Any:
    def __getattr__(self, _):
        return lambda *a, **k: self
