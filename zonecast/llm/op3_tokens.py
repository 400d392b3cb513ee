"""Operator 3: token counts by a compiled finite-state transducer.

The piece model merges neighbouring symbols, best score first, the left pair first among equals. A merge result has two properties:
its first tokens are the result of the text that they cover, and a row of tokens is a result if and only if each two neighbours
are one of their joined text. So the last token behind a character follows from the last tokens at the few places before it where a
vocabulary piece may still be open. These places, their last tokens and their counts relative to the current one are a state of
``Machine``; reading a character leads to one state and emits a change of the token count (below zero where a longer token replaces
several). States and transitions are compiled from pieces and scores on demand, in tables of bounded size; the model's library
counts nothing and is what the tests compare with.

The model never joins a blank to the text before it: no piece has the blank mark behind another character, so every blank behind
a non-blank leads to one boundary state. A segment is a run of blanks and the non-blanks behind it; ``Transducer`` keeps the sums
of whole segments in a table too, as composed transitions from the boundary state to itself. ``Transducer.check`` holds all
that is used here against the model.

Long texts are read in chunks. A chunk cut anywhere has the state map (head, count, tail): the
characters before its first boundary, the tokens of its whole segments, and the unfinished segment it leaves;
maps compose associatively (tail and head meet in one segment), so a text's chunks are folded by a
pairwise scan. One text stays within one task, which has read it as one row already.

Defined results: a null or empty text has 0 bytes and 0 tokens; every row of ``docs`` gives one row,
repeated rows and null doc_ids included; only doc_id and text are read, so extra columns cannot clash.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANK, MARK = " ", "▁"
CHUNK_CHARS = 1 << 16
TABLE_ENTRIES = 600_000
#: longer segments are read by the machine each time
TABLE_CHARS = 64
MACHINE_STATES = 200_000
PAIR_ENTRIES = 400_000
NO_SCORE = float("-inf")

#: (head, count, tail); count None: no boundary inside, head holds all characters and tail none.
Map = tuple[str, int | None, str]


class State(dict):
    """Transitions: character -> (next state, change of the token count). ``open``: (characters back, last token there, count there less
    the count here), longest first; ``text``: the characters from the first of these places on."""

    __slots__ = ("open", "text")


class Machine:
    """Deterministic transducer of a piece vocabulary: ``scores`` by piece; a character without a piece is its bytes."""

    def __init__(self, scores: dict[str, float], states: int = MACHINE_STATES):
        self.scores, self.limit = scores, states
        self.prefixes = {piece[:i] for piece in scores for i in range(1, len(piece))}
        self.pairs: dict[tuple[str | None, str], bool] = {}

        self.states: dict[tuple, State] = {}
        self._begin()

    def _begin(self) -> None:
        for state in self.states.values():
            state.clear()  # states name each other
        self.states.clear()
        self.start = self._state("", ((0, None, 0),))

    def _state(self, text: str, marks: tuple) -> State:
        state = self.states.get((text, marks))
        if state is None:
            state = self.states[text, marks] = State()
            state.open, state.text = marks, text
        return state

    def merged(self, text: str) -> list[str]:
        """Tokens of a short text by the merge rule itself."""
        parts, get = list(text), self.scores.get
        scores = [get(a + b, NO_SCORE) for a, b in zip(parts, parts[1:])]
        while scores and (best := max(scores)) != NO_SCORE:
            i = scores.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i:
                scores[i - 1] = get(parts[i - 1] + parts[i], NO_SCORE)
            if i < len(scores):
                scores[i] = get(parts[i] + parts[i + 1], NO_SCORE)
        return parts

    def follows(self, last: str | None, piece: str) -> bool:
        """Whether ``piece`` may stand behind the token ``last`` (None: at the start)."""
        known = self.pairs.get((last, piece))
        if known is None:
            if len(self.pairs) >= PAIR_ENTRIES:
                self.pairs.clear()
            known = self.pairs[last, piece] = self.merged((last or "") + piece) == ([piece] if last is None else [last, piece])
        return known

    def compile(self, state: State, char: str) -> tuple[State, int]:
        """The transition of a state by a character."""
        text = state.text + char
        end = len(text) - 1
        if char in self.scores:
            last, count = next((text[end - back:], n + 1) for back, token, n in state.open
                               if text[end - back:] in self.scores and self.follows(token, text[end - back:]))
        else:
            last, count = char, len(char.encode())
        marks = (*((back + 1, token, n - count) for back, token, n in state.open if text[end - back:] in self.prefixes), (0, last, 0))
        state[char] = found = self._state(text[len(text) - marks[0][0]:], marks), count
        return found

    def count(self, text: str) -> int:
        """Tokens of a text whose blanks are marks."""
        if len(self.states) > self.limit:
            self._begin()
        state, total = self.start, 0
        for char in text:
            found = state.get(char)
            if found is None:
                if len(self.states) > 2 * self.limit:  # within one long text: go on from the same place in an empty table
                    self._begin()
                    state = self._state(state.text, state.open)
                found = self.compile(state, char)
            state, change = found
            total += change
        return total


class Transducer:
    """Segment transitions with emitted-token counts over the machine of a piece model."""

    def __init__(self, model: str, entries: int = TABLE_ENTRIES):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        self.entries = entries
        self.table: dict[str, int] = {}
        self.check()
        m = self.model
        self.machine = Machine({m.id_to_piece(i): m.get_score(i) for i in range(m.get_piece_size())
                                if not (m.is_unknown(i) or m.is_control(i) or m.is_byte(i))})

    def check(self) -> None:
        """The boundary state exists only if no piece continues across a blank; the machine reads characters as they are, a
        character without a piece as its bytes, and merges to any piece."""
        m = self.model
        for i in range(m.get_piece_size()):
            piece = m.id_to_piece(i)
            if MARK in piece.lstrip(MARK):
                raise ValueError(f"piece {piece!r} spans a blank")
        if m.encode("  a") == m.encode("a"):
            raise ValueError("the model drops blanks")
        if sum(m.is_byte(i) for i in range(m.get_piece_size())) != 256 or any(m.is_unused(i) for i in range(m.get_piece_size())):
            raise ValueError("the model has no byte pieces, or pieces that it does not use")
        signs = "".join(map(chr, [*range(1, 0xD800), *range(0xE000, 0x110000)]))
        if m.normalize(signs) != MARK + signs.replace(BLANK, MARK):
            raise ValueError("the model changes characters")

    def total(self, segments: list[str]) -> int:
        """Tokens of segments, each written without its first blank; the table is emptied when full."""
        counts = list(map(self.table.get, segments))
        if None in counts:
            table, read = self.table, self.machine.count
            for i, segment in enumerate(segments):
                if counts[i] is None and (count := table.get(segment)) is not None:
                    counts[i] = count
                elif counts[i] is None:
                    counts[i] = count = read(MARK + segment.replace(BLANK, MARK))
                    if len(segment) <= TABLE_CHARS:
                        if len(table) >= self.entries:
                            table.clear()
                        table[segment] = count
        return sum(counts)


def segments_of(text: str) -> list[str]:
    """Segments of a non-empty stretch that starts right behind a boundary blank, each without its
    first blank. A run of blanks belongs to the segment behind it; trailing blanks are one segment."""
    parts = text.split(BLANK)
    if "" not in parts:
        return parts
    out, run = [], 0
    for part in parts[:-1]:
        if part:
            out.append(BLANK * run + part)
            run = 0
        else:
            run += 1
    out.append(BLANK * run + parts[-1])
    return out


def chunk_map(t: Transducer, chunk: str) -> Map:
    """State map of a chunk cut anywhere. A blank at its very start may continue a run of the chunk before,
    so its first sure boundary is a blank behind a non-blank of its own."""
    lead = len(chunk) - len(chunk.lstrip(BLANK))
    first = chunk.find(BLANK, lead)
    if first < 0:
        return chunk, None, ""
    open_at = len(chunk.rstrip(BLANK)) if chunk.endswith(BLANK) else _run_start(chunk)
    return chunk[:first], t.total(segments_of(chunk[first + 1:open_at])) if open_at > first else 0, chunk[open_at:]


def _run_start(chunk: str) -> int:
    """Start of the last run of blanks."""
    return len(chunk[:chunk.rindex(BLANK)].rstrip(BLANK))


def compose(t: Transducer, a: Map, b: Map) -> Map:
    """Map of two neighbouring stretches; associative."""
    if a[1] is None:
        head, count, tail = chunk_map(t, a[0] + b[0])
        if b[1] is None:
            return head, count, tail
        if count is None:
            return head, b[1], b[2]
        return head, count + t.total(segments_of(tail[1:])) + b[1], b[2]
    middle = segments_of((a[2] + b[0])[1:])
    if b[1] is not None:
        return a[0], a[1] + t.total(middle) + b[1], b[2]
    return a[0], a[1] + t.total(middle[:-1]), BLANK + middle[-1]


def fold(t: Transducer, maps: list[Map]) -> Map:
    """All maps in order, composed pair by pair (a scan's up-sweep)."""
    while len(maps) > 1:
        maps = [compose(t, *maps[i:i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
    return maps[0]


def count_tokens(t: Transducer, text: str | None, chunk_chars: int = CHUNK_CHARS) -> int:
    """Tokens of a whole text."""
    if not text:
        return 0
    text = text.replace(MARK, BLANK)
    if len(text) <= chunk_chars:
        return t.total(segments_of(text))
    # the blank that the library puts in front of a text opens the first segment
    start: Map = ("", 0, BLANK)
    _, count, tail = fold(t, [start] + [chunk_map(t, text[i:i + chunk_chars]) for i in range(0, len(text), chunk_chars)])
    return count + t.total(segments_of(tail[1:]))


_loaded: dict[str, Transducer] = {}


def _transducer(model: str) -> Transducer:
    """Compiled once per Python worker."""
    if model not in _loaded:
        _loaded.clear()
        _loaded[model] = Transducer(model)
    return _loaded[model]


def token_counts(docs: DataFrame, model: str, limit: int = 4096) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit. ``model`` is the model file's path, at the
    same place on every executor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _transducer(model)
        gc.disable()  # its rounds over all states find nothing
        try:
            for batch in batches:
                counts = [count_tokens(t, text) for text in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(counts, pa.int64())],
                                                 ["doc_id", "n_bytes", "n_tokens"])
        finally:
            gc.enable()

    text = F.col("text").cast("string")
    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"),
                        F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes"))
            .mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint")
            .withColumn("over_limit", F.col("n_tokens") > limit))
