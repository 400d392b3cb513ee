"""Operator 9: benchmark passages in documents, found by one Aho-Corasick automaton.

Benchmark items (questions and answers) and documents are normalised alike: ASCII letters lower-cased, words
are runs of digits, letters and non-ASCII characters. Every benchmark word becomes one symbol, so that a
window of ten words is a pattern of ten symbols; a document is turned into symbols (words unknown to
the benchmark share one) and scanned once. Matches are word positions, mapped back to offsets of the
original text for the documents that have any.

The benchmark is split into blocks of at most ``block_symbols`` pattern symbols, and only one block is
broadcast and compiled at a time: memory is bounded however large the benchmark, and each further block
is one more pass over the documents. Nothing is shuffled.

Defined results: a null or empty text has no words; an item without words has no window; an item of fewer
than ten words is one window; an item with a null item_id is named "null"; repeated items count once
by id; every document row, repeated or with a null doc_id, gives one row. Only doc_id, text and
item_id, text are read, so extra columns cannot clash.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.llm import words as W
from zonecast.llm.frames import staged

WINDOW = 10
#: pattern symbols of a block; a word is one code point of 1.1 million, and a block has no more words than symbols
BLOCK_SYMBOLS = 1_000_000

_TO_WORDS = bytes(int(W._LOWER[b]) if W.ALNUM[W._LOWER[b]] else 32 for b in range(256))
_UNKNOWN = "\x00"

FOUND = "n_words bigint, n_hit bigint, items array<string>, spans array<struct<start:bigint,end:bigint>>"
STATE = "text binary, hits binary, items array<string>"


def split_words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TO_WORDS).split()


def _symbol(rank: int) -> str:
    """Code points from 1 on, without the surrogates."""
    code = rank + 1
    return chr(code if code < 0xD800 else code + 0x800)


_compiled: dict[str, tuple] = {}


def _compile(block_id: str, block) -> tuple[dict[bytes, str], object]:
    """Symbols and automaton of one broadcast block; built once per Python worker."""
    import ahocorasick

    if block_id not in _compiled:
        _compiled.clear()
        symbols: dict[bytes, str] = {}
        names: dict[str, set[str]] = {}
        for name, words, window in block.value:
            text = "".join([symbols.setdefault(w, _symbol(len(symbols))) for w in words])
            for i in range(max(len(text) - window, 0) + 1):
                names.setdefault(text[i:i + window], set()).add(name)
        automaton = ahocorasick.Automaton()
        automaton.add_word(chr(0x10FFFF), None)  # a symbol of no word: an empty block is an automaton too
        for pattern, owners in names.items():
            automaton.add_word(pattern, (len(pattern), sorted(owners)))
        automaton.make_automaton()
        _compiled[block_id] = symbols, automaton
    return _compiled[block_id]


def _scan(block):
    block_id = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, automaton = _compile(block_id, block)
        get = symbols.get
        for batch in batches:
            hits, items = [], []
            for text, old_hits, old_items in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                line = "".join([get(w, _UNKNOWN) for w in split_words(text)])
                mark, owners = None, set(old_items)
                for end, (size, names) in automaton.iter(line):
                    if mark is None:
                        mark = np.frombuffer(old_hits or bytes(len(line)), np.uint8).copy()
                    mark[end - size + 1:end + 1] = 1
                    owners.update(names)
                hits.append(old_hits if mark is None else mark.tobytes())
                items.append(sorted(owners))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(hits, pa.binary()), pa.array(items, pa.list_(pa.string()))],
                [batch.schema.names[0], "text", "hits", "items"])
    return run


def _original_spans(text: bytes, mark: np.ndarray) -> list[tuple[int, int]]:
    """Code point ranges of the original text that the runs of hit words cover."""
    starts, ends = W.word_bounds(np.frombuffer(text, np.uint8), np.array([0, len(text)]), W.ALNUM[W._LOWER])
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mark, [0]]).astype(np.int8)))
    # code points before each byte: bytes that do not continue a character
    points = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
    return [(int(points[starts[a]]), int(points[ends[b - 1]])) for a, b in zip(edge[::2], edge[1::2], strict=True)]


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        n_words, n_hit, spans = [], [], []
        for text, hits in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if hits:
                mark = np.frombuffer(hits, np.uint8)
                n_words.append(len(mark))
                n_hit.append(int(mark.sum()))
                spans.append([{"start": a, "end": b} for a, b in _original_spans(text, mark)])
            else:
                n_words.append(len(split_words(text)))
                n_hit.append(0)
                spans.append([])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), batch.column(3),
             pa.array(spans, kind)], [batch.schema.names[0], "n_words", "n_hit", "items", "spans"])


def benchmark_blocks(items: DataFrame, window: int, block_symbols: int) -> Iterator[list]:
    """The benchmark's words, in blocks; read in a stream of partitions, never more than a block ahead."""
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"),
                        F.col("text").cast("string").cast("binary").alias("text")).where("text is not null")
    block: list[tuple[str, list[bytes], int]] = []
    size, block_symbols = 0, min(block_symbols, BLOCK_SYMBOLS)
    for row in rows.toLocalIterator():
        words = split_words(bytes(row.text))
        cost = window * max(len(words) - window + 1, 1)
        if block and size + cost > block_symbols:
            yield block
            block, size = [], 0
        # a very long item goes into several blocks, in pieces that overlap by a window less one word
        step = max(block_symbols // window, 1)
        for at in range(0, max(len(words) - window + 1, min(len(words), 1)), step):
            block.append((row.item_id, words[at:at + step + window - 1], window))
            size += min(cost, window * step)
            if size >= block_symbols:
                yield block
                block, size = [], 0
    yield block


def _found(rows: DataFrame, items: DataFrame, window: int, block_symbols: int) -> DataFrame:
    """What ``items`` hit in each row of ``rows`` (a column of any type to carry along, text)."""
    carried = rows.drop("text").schema.toDDL()
    state = rows.withColumns({"text": F.col("text").cast("string").cast("binary"), "hits": F.lit(None).cast("binary"),
                              "items": F.expr("cast(array() as array<string>)")})
    context = rows.sparkSession.sparkContext
    blocks = benchmark_blocks(items, window, block_symbols)
    block, following = next(blocks), next(blocks, None)
    while following is not None:
        state = staged(state.mapInArrow(_scan(context.broadcast(block)), f"{carried}, {STATE}"), "decontaminate")
        block, following = following, next(blocks, None)
    last = _scan(context.broadcast(block))
    return state.mapInArrow(lambda batches: _finish(last(batches)), f"{carried}, {FOUND}")


def find_passages(docs: DataFrame, items: DataFrame, window: int = WINDOW,
                  block_symbols: int = BLOCK_SYMBOLS) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, items (ids as sorted strings) and spans, the
    code point ranges [start, end) of the original text that benchmark windows cover."""
    return _found(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), items, window, block_symbols)


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW,
                      block_symbols: int = BLOCK_SYMBOLS) -> DataFrame:
    """The rows of ``docs``, with all their columns, in which no benchmark window occurs."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    return _found(rows, items, window, block_symbols).where("n_hit = 0").select("row.*")


def items_digest(items: Column) -> Column:
    return F.sha2(F.array_join(items, ","), 256)
