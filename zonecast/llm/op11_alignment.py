"""Operator 11: alignment of two tokenizers' tokens by lockstep vectorised merging.

Tokenizer A reads a blank and the text, tokenizer B the text (it puts the blank there itself); both cut the same bytes. The tokens of all
documents of a batch lie in flat arrays of byte ends. One state vector holds a pair of pointers (A, B) per run; each step emits
the pair under every pointer as a link, marks a cut where both tokens end at one byte, advances the pointer whose token ends first (both
at a cut) and drops the runs that are finished. A run is a document, or for a long one a stretch of RUN tokens of A, whose B pointer
starts at the token that covers the first byte: links of an A token all belong to its run, so the stretches of a document advance
side by side and the number of steps is bounded by the run, not by the longest text.

How often each pair of ids is linked in the corpus is one grouped sum over the batches' distinct pairs. The counts come back to
a batch by its distinct pairs as well, not by its links: the tables that are shuffled have one row per batch and pair, and the documents
keep their links as packed places in the batch's list of pairs. A batch holds at most BATCH_CHARS characters, or one document.

Defined results: a text that is null or empty, or whose tokens' bytes are not the blank and the text (signs that a vocabulary lacks or a
normaliser changes), has no tokens: zeros, and groups_sha256 is ''. Every row of ``docs`` gives one row, repeated rows and null
doc_ids included; only doc_id and text are read, so extra columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.frames import staged
from zonecast.llm.op3_tokens import MARK, segments_of
from zonecast.llm.segments import BLANK, JOINED, MIXED_RUN, SIGNS, SegmentTable, pack, text_ranges

RUN = 512
BATCH_CHARS = 1 << 20
PAIR_BITS = 32
COUNTS = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint"


# ---------------------------------------------------------------- tokens

class Tokens:
    """Ids of texts by one tokenizer, and the bytes that every id stands for."""

    def __init__(self, bytes_of: list[bytes], encode, entries: int = 300_000):
        self.bytes_of = bytes_of
        self.sizes = np.array([len(b) for b in bytes_of], np.int64)
        self.encode = encode
        self.bad: set[str] = set()
        self.table = SegmentTable(self._learn, entries)

    def _learn(self, segments: list[str]) -> list[bytes]:
        found = self.encode(segments)
        if self.bad and not self.table.table:
            self.bad.clear()  # the table was emptied
        ids = np.frombuffer(b"".join(found), "<u4")
        ends = np.concatenate([[0], np.cumsum([len(f) // 4 for f in found])])
        sizes = np.diff(np.concatenate([[0], np.cumsum(self.sizes[ids])])[ends])
        whole = sizes.sum() == sum([1 + len(s.encode()) for s in segments]) and self.covers(ids, BLANK.join(segments))
        if not whole:
            self.bad.update(s for s, f in zip(segments, found, strict=True) if not self.covers(np.frombuffer(f, "<u4"), s))
        return found

    def covers(self, ids: np.ndarray, segment: str) -> bool:
        """Do the ids stand for a blank and the segment?"""
        return b"".join([self.bytes_of[i] for i in ids.tolist()]) == BLANK.encode() + segment.encode()

    def ids(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """Ids of a blank and each text; None where the text is empty or the ids' bytes differ from it."""
        out: list[np.ndarray | None] = [None] * len(texts)
        plain = [i for i, t in enumerate(texts) if t and MARK not in t and not MIXED_RUN.search(t)]
        segments = [segments_of(texts[i]) for i in plain]
        for i, parts, ids in zip(plain, segments, self.table.ids(segments), strict=True):
            if self.bad.isdisjoint(parts):
                out[i] = np.frombuffer(ids, "<u4")
        for i in set(range(len(texts))) - set(plain):
            if texts[i]:
                ids = np.frombuffer(self.encode([texts[i]])[0], "<u4")
                out[i] = ids if self.covers(ids, texts[i]) else None
        return out


def byte_level(path: str) -> Tokens:
    """Tokenizer A. A byte-level splitter starts a new unit at every blank behind a non-blank, so segments lie between blanks."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the cores
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.encode_special_tokens = True
    signs = {chr(sign): byte for byte, sign in SIGNS.items()}
    bytes_of = [b""] * model.get_vocab_size(with_added_tokens=True)
    for token, i in model.get_vocab(with_added_tokens=True).items():
        bytes_of[i] = bytes(signs[c] for c in token)
    def encode(segments: list[str]) -> list[bytes]:
        """Segments that end in a non-blank are encoded many as one text, whose ids are parted by their bytes."""
        whole = [i for i, s in enumerate(segments) if s and not s[-1].isspace()]
        out = [b""] * len(segments)
        groups = [whole[i:i + JOINED] for i in range(0, len(whole), JOINED)]
        rest = sorted(set(range(len(segments))) - set(whole))
        texts = ["".join([BLANK + segments[i] for i in group]) for group in groups]
        for group, e in zip(groups, model.encode_batch_fast(texts, add_special_tokens=False) if texts else [], strict=True):
            ids = np.array(e.ids, "<u4")
            ends = np.concatenate([[0], np.cumsum(sizes[ids])])
            cuts = np.concatenate([[0], np.cumsum([1 + len(segments[i].encode()) for i in group])])
            at = np.searchsorted(ends, cuts)
            if at[-1] > len(ids) or not np.array_equal(ends[at], cuts):  # a byte that the vocabulary lacks
                rest += group
                continue
            raw, at = ids.tobytes(), (4 * at).tolist()
            for i, start, end in zip(group, at[:-1], at[1:], strict=True):
                out[i] = raw[start:end]
        for i, e in zip(rest, model.encode_batch_fast([BLANK + segments[i] for i in rest], add_special_tokens=False) if rest else [], strict=True):
            out[i] = pack(e.ids, 4)
        return out

    sizes = np.array([len(b) for b in bytes_of])
    return Tokens(bytes_of, encode)


def pieces(path: str) -> Tokens:
    """Tokenizer B. No piece goes on across a blank, which op3 checks when it loads the model."""
    import sentencepiece

    from zonecast.llm.op3_tokens import Transducer

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    Transducer(path).check()
    bytes_of = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        bytes_of.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(MARK, BLANK).encode())
    lone = model.encode("a" + BLANK)[len(model.encode("a")):]
    # the library gives nothing for an empty text: a blank alone is the token that it adds behind a text
    return Tokens(bytes_of, lambda segments: [pack(ids if s else lone, 4) for s, ids in zip(segments, model.encode(segments, num_threads=1), strict=True)])


_loaded: dict[tuple[str, str], tuple[Tokens, Tokens]] = {}


def _tokenizers(a: str, b: str) -> tuple[Tokens, Tokens]:
    """Loaded once per Python worker."""
    if (a, b) not in _loaded:
        _loaded.clear()
        _loaded[a, b] = byte_level(a), pieces(b)
    return _loaded[a, b]


# ---------------------------------------------------------------- lockstep merging

def _runs(first_a: np.ndarray, first_b: np.ndarray, end_a: np.ndarray, end_b: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(A pointer, B pointer, end of A) of every run. ``first_*``: place of each document's first token, and the end."""
    n_a = np.diff(first_a)
    n_runs = -(-n_a // run)
    doc = np.repeat(np.arange(len(n_a)), n_runs)
    within = np.arange(len(doc)) - np.repeat(np.cumsum(n_runs) - n_runs, n_runs)
    start = first_a[:-1][doc] + within * run
    # byte at which the run starts; ends rise over all documents, so one search finds the B token over it
    byte = np.where(start > 0, end_a[np.maximum(start - 1, 0)], 0)
    return start, np.searchsorted(end_b, byte, side="right"), np.minimum(start + run, first_a[1:][doc])


def merge(first_a: np.ndarray, first_b: np.ndarray, end_a: np.ndarray, end_b: np.ndarray,
          run: int = RUN) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(A place, B place) of all links, and whether a cut is behind each A token and behind each B token. Ends are bytes counted over
    the whole batch; A and B cover the same bytes of every document."""
    a, b, stop = _runs(first_a, first_b, end_a, end_b, run)
    cut_a, cut_b = np.zeros(len(end_a), bool), np.zeros(len(end_b), bool)
    links_a, links_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while len(a):
        links_a.append(a)
        links_b.append(b)
        at_a, at_b = end_a[a], end_b[b]
        both = at_a == at_b
        cut_a[a[both]] = True
        cut_b[b[both]] = True
        a, b = a + (at_a <= at_b), b + (at_b <= at_a)
        going = a < stop
        if not going.all():
            a, b, stop = a[going], b[going], stop[going]
    return np.concatenate(links_a), np.concatenate(links_b), cut_a, cut_b


def _decimal_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Digits of 0 to n - 1 with one place for a sign behind them, and their number."""
    width = len(str(max(n - 1, 1)))
    text = np.char.mod("%d", np.arange(n)).astype(f"S{width}")
    table = np.zeros((n, width + 1), np.uint8)
    table[:, :width] = text.view(np.uint8).reshape(n, width)
    return table, (table > 0).sum(1)


class Digests:
    """Hex digests of `a1,a2|b1;a3|b2` strings."""

    def __init__(self, n: int):
        self.table, self.sizes = _decimal_table(n)

    def of(self, ids_a: np.ndarray, ids_b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, first_a: np.ndarray,
           first_b: np.ndarray) -> list[str]:
        # a group's A tokens come before its B tokens: each token moves behind the other side's tokens of earlier (B: same) groups
        group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
        n_groups = int(cut_a.sum())
        before_b = np.concatenate([[0], np.cumsum(np.bincount(group_b, minlength=n_groups))])
        upto_a = np.cumsum(np.bincount(group_a, minlength=n_groups))
        place_a = np.arange(len(ids_a)) + before_b[group_a]
        place_b = np.arange(len(ids_b)) + upto_a[group_b]
        ids = np.empty(len(ids_a) + len(ids_b), np.int64)
        sign = np.empty(len(ids), np.uint8)
        ids[place_a], ids[place_b] = ids_a, ids_b
        sign[place_a] = np.where(cut_a, ord("|"), ord(","))
        sign[place_b] = np.where(cut_b, ord(";"), ord(","))
        rows, sizes = self.table[ids], self.sizes[ids]
        rows[np.arange(len(ids)), sizes] = sign
        text = rows[rows > 0].tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes + 1)])[first_a + first_b]
        return [hashlib.sha256(text[s:e - 1]).hexdigest() if e > s else "" for s, e in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


# ---------------------------------------------------------------- batches

def _flat(parts: list[np.ndarray | None]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, place of each document's first id and the end)."""
    first = np.concatenate([[0], np.cumsum([0 if p is None else len(p) for p in parts])]).astype(np.int64)
    there = [p for p in parts if p is not None and len(p)]
    return (np.concatenate(there) if there else np.zeros(0, np.uint32)).astype(np.int64), first


def align_batch(tokens_a: Tokens, tokens_b: Tokens, digests: Digests, texts: list[str | None]) -> dict:
    """Aligned documents of one batch: columns by document, the batch's distinct pairs with their numbers of links, and each document's
    links as places in the list of pairs."""
    got = list(zip(tokens_a.ids(texts), tokens_b.ids(texts), strict=True))
    got = [(x, y) if x is not None and y is not None else (None, None) for x, y in got]
    ids_a, first_a = _flat([x for x, _ in got])
    ids_b, first_b = _flat([y for _, y in got])
    end_a, end_b = np.cumsum(tokens_a.sizes[ids_a]), np.cumsum(tokens_b.sizes[ids_b])
    link_a, link_b, cut_a, cut_b = merge(first_a, first_b, end_a, end_b)
    pairs, place, counts = np.unique((ids_a[link_a] << PAIR_BITS) | ids_b[link_b], return_inverse=True, return_counts=True)
    doc = np.searchsorted(first_a, link_a, side="right") - 1
    order = np.argsort(doc, kind="stable")
    n_links = np.bincount(doc, minlength=len(texts))
    groups = np.concatenate([[0], np.cumsum(cut_a)])
    kind = np.uint16 if len(pairs) <= 1 << 16 else np.uint32
    places = place[order].astype(kind)
    ends = np.concatenate([[0], np.cumsum(n_links)]).tolist()
    return {"n_a": np.diff(first_a), "n_b": np.diff(first_b), "n_groups": groups[first_a[1:]] - groups[first_a[:-1]], "n_links": n_links,
            "groups_sha256": digests.of(ids_a, ids_b, cut_a, cut_b, first_a, first_b),
            "links": [places[s:e].tobytes() for s, e in zip(ends[:-1], ends[1:], strict=True)], "pairs": pairs, "counts": counts}


ALIGNED = "batch bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, links binary, " \
          "pairs array<bigint>, counts array<bigint>"


def _align(a: str, b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens_a, tokens_b = _tokenizers(a, b)
        digests = Digests(max(len(tokens_a.bytes_of), len(tokens_b.bytes_of)))
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for start, end in text_ranges(texts, BATCH_CHARS):
                out = align_batch(tokens_a, tokens_b, digests, texts[start:end])
                n = end - start
                # the batch's pairs ride on its first row
                ends = pa.array(np.concatenate([[0], np.full(n, len(out["pairs"]))]), pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(out[k], pa.int64())) for k in ("pairs", "counts")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, number), pa.int64()), batch.column(0).slice(start, n), *[pa.array(out[k], pa.int64()) for k in
                     ("n_a", "n_b", "n_groups", "n_links")], pa.array(out["groups_sha256"], pa.string()), pa.array(out["links"], pa.binary()), *lists],
                    [c.split()[0] for c in ALIGNED.split(", ")])
                number += 1
    return run


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, total, best): how many links of the corpus hold a pair of ids, and whether that is the most of its B id."""
    each = aligned.where(F.size("pairs") > 0).select(F.explode(F.arrays_zip("pairs", "counts")).alias("p"))
    totals = each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.counts").alias("total"))
    totals = staged(totals.withColumn("b", F.col("pair").bitwiseAND((1 << PAIR_BITS) - 1)), "pair-counts")
    # one row per id of B: at most its vocabulary, so it may be sent everywhere
    most = totals.groupBy("b").agg(F.max("total").alias("most"))
    return totals.join(F.broadcast(most), "b").select("pair", "total", (F.col("total") == F.col("most")).alias("best"))


def _score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Documents of one batch with the corpus counts of its pairs."""
    right = right.sort_values("pair")
    totals, best = right["total"].to_numpy(np.int64), right["best"].to_numpy(np.int64)
    kind = np.uint16 if len(totals) <= 1 << 16 else np.uint32
    places = [np.frombuffer(links, kind) for links in left["links"]]
    left["n_best"] = [int(best[p].sum()) for p in places]
    left["count_sum"] = [int(totals[p].sum()) for p in places]
    return left.drop(columns=["links", "batch"])


def align(docs: DataFrame, tokenizer_a: str, tokenizer_b: str) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256. The
    tokenizer files lie at the same place on every executor; A is a byte-level ``tokenizers`` file, B a ``sentencepiece`` model."""
    aligned = staged(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
                     .mapInArrow(_align(tokenizer_a, tokenizer_b), ALIGNED), "aligned")
    totals = pair_counts(aligned)
    wanted = aligned.where(F.size("pairs") > 0).select(F.col("batch").alias("of_batch"), F.explode("pairs").alias("pair"))
    known = wanted.join(totals, "pair").select("of_batch", "pair", "total", "best")
    rows = aligned.select("batch", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links")
    schema = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, n_best bigint, count_sum bigint"
    scored = rows.groupBy("batch").cogroup(known.groupBy("of_batch")).applyInPandas(_score, schema)
    return scored.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
