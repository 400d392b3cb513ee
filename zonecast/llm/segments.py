"""Token ids of texts by a library, one call per distinct segment.

Where a tokenizer never joins characters across a cut, the ids of a text are those of its segments in order. Tables from segment
to ids are kept per Python worker, have a bounded size and are emptied when full, so they change the speed alone.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Callable, Iterator
from itertools import filterfalse

#: the splitting pattern of a lower-casing word tokenizer whose matches hold no white space (fixed value)
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: pieces encoded as one text
JOINED = 1000
#: printable ASCII signs and the Latin-1 letters: composed already, and lower-cased alike everywhere
PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]*").fullmatch
#: the same pattern on lower-case plain signs
WORD_PLAIN = r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^ \na-z0-9ß-öø-ÿ]+"
TABLE_ENTRIES = 1_000_000
BLANK = " "
#: a white-space run of other signs than blanks at first, with more behind its blank, is one unit to a byte-level splitter
MIXED_RUN = re.compile(r"[^\S ] (?:\s|\Z)")


class SegmentTable:
    """Ids (as little-endian bytes) of segments, filled by ``encode``; at most ``entries`` of them."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], entries: int = TABLE_ENTRIES):
        self.encode, self.entries, self.table = encode, entries, {}

    def ids(self, texts: list[list[str]]) -> list[bytes]:
        """Joined ids of the segments of each text; the unseen segments of all texts are encoded in one call. The table exceeds its
        bound by the segments of one call at most."""
        table, unseen = self.table, set()
        for segments in texts:
            unseen.update(filterfalse(table.__contains__, segments))
        if len(table) + len(unseen) > self.entries:
            table.clear()
            unseen = set().union(*texts)
        new = list(unseen)
        if new:
            table.update(zip(new, self.encode(new), strict=True))
        return [b"".join(map(table.__getitem__, segments)) for segments in texts]


def text_ranges(texts: list[str | None], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``limit`` characters; one longer text is a range of its own."""
    start = size = 0
    for i, text in enumerate(texts):
        n = len(text or "")
        if i > start and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if len(texts) > start:
        yield start, len(texts)


def pack(ids: list[int], width: int) -> bytes:
    packed = array("H" if width == 2 else "I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


def id_width(vocabulary: int) -> int:
    return 2 if vocabulary <= 1 << 16 else 4


def byte_signs() -> dict[int, int]:
    """Sign that a byte-level vocabulary writes for each byte: printable Latin-1 bytes are themselves, the others take the signs
    from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = sorted(set(range(256)) - set(plain))
    return {b: b for b in plain} | {b: 256 + i for i, b in enumerate(rest)}


SIGNS = byte_signs()


END = "</w>"
MARK = "\n"


class PlainPieces:
    """Ids of segments of plain signs by the library's model alone: on them a tokenizer's normaliser and splitter do no more than ``pattern``,
    and cost more than the merges. All segments are cut in one pass and their pieces are encoded many at a time; a piece's last token bears
    the vocabulary's word end, which tells the pieces, and so the segments, apart again."""

    def __init__(self, tokenizer, pattern: str, width: int):
        import numpy as np
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.cut = re.compile(f"{MARK}|{pattern}").findall
        self.width = width
        self.bare = Tokenizer(tokenizer.model)
        self.bare.pre_tokenizer = WhitespaceSplit()
        self.is_end = np.zeros(tokenizer.get_vocab_size(), bool)
        for token, i in tokenizer.get_vocab(with_added_tokens=False).items():
            self.is_end[i] = token.endswith(END)
        # bytes behind ASCII as a byte-level vocabulary's signs; ASCII signs stay, and so does white space
        self.sign = np.array([b if b <= 0x7F else SIGNS[b] for b in range(256)], "<u2")

    def _signs(self, text: str) -> str:
        import numpy as np

        return text if text.isascii() else self.sign[np.frombuffer(text.encode(), np.uint8)].tobytes().decode("utf-16-le")

    def ids(self, segments: list[str]) -> list[bytes]:
        import numpy as np

        if not segments:
            return []
        pieces = self.cut(MARK.join([*segments, ""]).lower())
        texts = [self._signs(" ".join(pieces[i:i + JOINED])) for i in range(0, len(pieces), JOINED)]
        ids = np.concatenate([np.array(e.ids, "<u2" if self.width == 2 else "<u4")
                              for e in self.bare.encode_batch_fast(texts, add_special_tokens=False)])
        ends = np.append(0, np.flatnonzero(self.is_end[ids]) + 1)
        # the marks among the pieces end the segments and have no ids
        marks = np.array([i for i, piece in enumerate(pieces) if piece == MARK])
        if len(marks) != len(segments) or len(ends) - 1 != len(pieces) - len(marks):
            raise ValueError("pieces and word ends of the vocabulary differ")
        raw, stops = ids.tobytes(), (ends[marks - np.arange(len(marks))] * self.width).tolist()
        return [raw[i:j] for i, j in zip([0, *stops[:-1]], stops, strict=True)]


class WordTokenizer:
    """A ``tokenizers`` file whose matches hold no white space: segments lie between blanks. Other files are read text by text."""

    def __init__(self, path: str, entries: int = TABLE_ENTRIES):
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the cores
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.width = id_width(self.model.get_vocab_size(with_added_tokens=True))
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        first = ((spec["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0]
        added = spec["added_tokens"]
        self.by_segment = (first.get("type") == "Split" and first["pattern"].get("Regex") == WORD_PATTERN and first["invert"]
                           and all(t["content"].startswith("<") and BLANK not in t["content"] and not (t["lstrip"] or t["rstrip"] or t["single_word"])
                                   for t in added))
        self.special = [t["content"] for t in added]
        self.table = SegmentTable(self._segments, entries)
        self.pieces = PlainPieces(self.model, WORD_PLAIN, self.width) if self.by_segment else None

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [pack(e.ids, self.width) for e in self.model.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def _segments(self, segments: list[str]) -> list[bytes]:
        """Plain segments by their pieces, the others and those that hold a special token by the whole tokenizer."""
        plain = [PLAIN(s) is not None and not ("<" in s and any(t in s for t in self.special)) for s in segments]
        rest = iter(self._encode([s for s, p in zip(segments, plain, strict=True) if not p]))
        known = iter(self.pieces.ids([s for s, p in zip(segments, plain, strict=True) if p]))
        return [next(known if p else rest) for p in plain]

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, without special tokens around it; a null text has none."""
        if not self.by_segment:
            return self._encode([t or "" for t in texts])
        return self.table.ids([(t or "").replace("\n", BLANK).replace("\t", BLANK).replace("\r", BLANK).split(BLANK) for t in texts])
