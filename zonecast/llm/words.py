"""Vectorised word splitting and hashing over Arrow text columns.

All functions work on one flat byte buffer that holds many texts plus the texts' offsets, so that a
task touches Python objects per batch, not per word. A word's hash is a polynomial over its bytes
modulo 2**64 (one running sum per segment gives every word's hash by difference), finalised by an
avalanche mix; it depends on the word's bytes only, never on its place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
SEGMENT = 1 << 20

# Fixed odd multipliers (any odd 64-bit constants do).
RADIX = U64(0x9E3779B97F4A7C15)
MIX_A = U64(0xBF58476D1CE4E5B9)
MIX_B = U64(0x94D049BB133111EB)


def separators(*ranges: tuple[int, int]) -> np.ndarray:
    """Table of 256 flags, False for the byte ranges (inclusive) that separate words."""
    table = np.ones(256, dtype=bool)
    for low, high in ranges:
        table[low:high + 1] = False
    return table


#: Words are runs without blanks and control white space.
BLANKS = separators((0x20, 0x20), (0x09, 0x0D))
#: Words are runs of ASCII digits, letters and any non-ASCII character.
ALNUM = separators((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """Avalanche finaliser of 64-bit hashes."""
    x = (x ^ (x >> U64(30))) * MIX_A
    x = (x ^ (x >> U64(27))) * MIX_B
    return x ^ (x >> U64(31))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type)
                                  else b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64 if large else np.int32)[column.offset:column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = 4 * SEGMENT) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes (one longer text is a range of its own), so that the
    temporary arrays of a batch stay bounded."""
    n, first = len(offsets) - 1, 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


_POWERS = np.ones(0, U64)


def _powers(n: int) -> np.ndarray:
    """RADIX ** i for i < n."""
    global _POWERS
    if len(_POWERS) < n:
        _POWERS = np.cumprod(np.concatenate([np.ones(1, U64), np.full(max(n, SEGMENT + 4096) - 1, RADIX)]))
    return _POWERS


def _inverse_radix() -> np.uint64:
    return U64(pow(int(RADIX), -1, 1 << 64))


_INVERSES = np.ones(0, U64)


def _inverses(n: int) -> np.ndarray:
    global _INVERSES
    if len(_INVERSES) < n:
        step = np.full(max(n, SEGMENT + 4096) - 1, _inverse_radix())
        _INVERSES = np.cumprod(np.concatenate([np.ones(1, U64), step]))
    return _INVERSES


def word_bounds(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every word; a text's end always ends a word."""
    inside = table[data]
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    before[cuts] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = offsets[1:][offsets[1:] > 0] - 1
    after[ends] = False
    return starts, np.flatnonzero(inside & ~after) + 1


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every byte span, ASCII letters lower-cased. Spans are in order and apart."""
    out = np.empty(len(starts), U64)
    first = 0
    while first < len(starts):
        base = int(starts[first])
        last = max(int(np.searchsorted(ends, base + SEGMENT, side="right")), first + 1)
        stop = int(ends[last - 1])
        size = stop - base
        run = np.empty(size + 1, U64)
        run[0] = 0
        np.cumsum((_LOWER[data[base:stop]].astype(U64) + U64(1)) * _powers(size)[:size], out=run[1:])
        a, b = starts[first:last] - base, ends[first:last] - base
        out[first:last] = (run[b] - run[a]) * _inverses(size + 1)[a] + (b - a).astype(U64) * MIX_B
        first = last
    return mix64(out)


class Words:
    """Words of a run of texts: hashes in order, and the first word's index of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray):
        self.data, self.offsets = data, offsets
        self.starts, self.ends = word_bounds(data, offsets, table)
        self.first = np.searchsorted(self.starts, offsets)  # len(texts) + 1
        self._hashes: np.ndarray | None = None

    @property
    def hashes(self) -> np.ndarray:
        if self._hashes is None:
            self._hashes = hash_spans(self.data, self.starts, self.ends)
        return self._hashes

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def ngram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive words (runs that cross texts are for the caller to skip)."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.zeros(0, U64)
    total = np.full(size, (n * int(MIX_A)) % (1 << 64), U64)
    for i in range(n):
        total = total * RADIX + hashes[i:i + size]
    return mix64(total)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values: on hashes one sort takes a quarter of the time of numpy's hash table."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def shingle_sets(words: Words, n: int) -> Iterator[np.ndarray]:
    """Each text's sorted distinct ``n``-word shingle hashes; with fewer words the whole sequence is
    the one shingle, without words there is none."""
    hashes, grams = words.hashes, ngram_hashes(words.hashes, n)
    for a, b in zip(words.first[:-1], words.first[1:], strict=True):
        if b - a >= n:
            yield distinct(grams[a:b - n + 1])
        elif b > a:
            yield ngram_hashes(hashes[a:b], int(b - a))
        else:
            yield np.zeros(0, U64)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def binary_array(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


def list_array(flat_values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat_values, kind))
