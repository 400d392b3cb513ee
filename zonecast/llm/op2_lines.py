"""Operator 2: line dedup as an exact set-similarity join.

A line's tokens are its distinct five-word shingles (ASCII letters lower-cased, words as runs of digits, letters and
non-ASCII characters). A line is removed if an earlier line, by (doc_id, text hash, line number), has Jaccard
similarity of at least 80 % with it. The word sequence of a line of fewer than five words is its one token, so that repeats of it go too
(without ``short`` such lines have no token, match nothing and stay). Lines without words always stay.

1. Tokens are counted into 65,536 hash buckets over all documents; (bucket count, token) is the global order, rare
   tokens first. The table is all that is broadcast, 64 KB at any corpus size.
2. Each line keeps a prefix of its ordered tokens: two lines that are similar enough share a token of the larger
   one's prefix (n - ceil(0.8 n) + 1) and the smaller one's shorter prefix (n - ceil(8/9 n) + 1). Equal lines are one
   class, represented by its first line. The classes' prefix tokens are dealt to cells of bounded size, many to a row; those of a
   single class are dropped there, which leaves the few that repeat.
3. Classes that share a token are compared with the group's earliest class first; only lines still unmatched are joined
   with all earlier members. Both joins hold the length, prefix and positional filters and a 128-bit map of each set in
   their condition, so that only likely pairs become rows; these are verified on their full sets.

No group is collected: hot lines are classes, hot tokens are last in the order, and groups are joined by key.

Defined results: one row per row of ``docs``; a null text stays null with no lines; rows with a null doc_id are returned
unchanged and match nothing; rows that repeat a doc_id and its text are the same document; a doc_id's different texts are
ordered by hash. Only doc_id and text are read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.llm import words as W
from zonecast.llm.frames import likely, staged

SHINGLE = 5
PERCENT = 80
RARITY_BITS, RARITY_LEVELS = 16, 128
TOKEN_BITS, LINE_BITS = 40, 17
POSITIONS = 1 << 24
CELL_PLACES = 1 << 16


def line_offsets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, text index) of all lines; a text without a newline is one line."""
    breaks = np.flatnonzero(data == 10)
    owner = np.searchsorted(offsets, breaks, side="right") - 1
    n = len(offsets) - 1
    text = np.concatenate([np.arange(n), owner])
    start = np.concatenate([offsets[:-1], breaks + 1])
    order = np.lexsort((start, text))
    return start[order], text[order]


def line_tokens(data: np.ndarray, offsets: np.ndarray, shingle: int,
                short: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(64-bit token hashes, line of each token, text of each line, number of each line within its text)."""
    starts, text = line_offsets(data, offsets)
    words = W.Words(data, np.append(starts, offsets[-1]), W.ALNUM)
    line = np.repeat(np.arange(len(starts)), words.counts)
    grams = W.ngram_hashes(words.hashes, shingle)
    whole = line[:len(grams)] == line[shingle - 1:] if len(grams) else np.zeros(0, bool)
    number = np.arange(len(text)) - np.searchsorted(text, text)
    tokens, line = grams[whole], line[:len(grams)][whole]
    if short:
        small = [np.flatnonzero(words.counts == k) for k in range(1, shingle)]
        tokens = np.concatenate([tokens, *(W.ngram_hashes(words.hashes, k)[words.first[s]] for k, s in enumerate(small, 1))])
        line = np.concatenate([line, *small])
        order = np.argsort(line, kind="stable")
        tokens, line = tokens[order], line[order]
    return tokens, line, text, number


def _blocks(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = W.flat(batch.column(column))
    for a, b in W.slices(offsets, W.SEGMENT):
        base = offsets[a]
        yield a, b, data[base:offsets[b]], offsets[a:b + 1] - base


def _cut(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(64 - TOKEN_BITS)


def _bucket(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(TOKEN_BITS - RARITY_BITS)).astype(np.int64)


def _count(shingle: int, short: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << RARITY_BITS, np.int64)
        for batch in batches:
            for _, _, data, offsets in _blocks(batch, 0):
                total += np.bincount(_bucket(_cut(line_tokens(data, offsets, shingle, short)[0])), minlength=len(total))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["bucket", "n"])
    return run


def rarity_levels(docs: DataFrame, shingle: int, short: bool = True) -> np.ndarray:
    """Rarity level (0 rare .. 127 common) of each token bucket, from counts over all documents."""
    counts = (docs.select("text").mapInArrow(_count(shingle, short), "bucket bigint, n bigint")
              .groupBy("bucket").agg(F.sum("n").alias("n")).toPandas())  # at most 65,536 rows
    levels = np.zeros(1 << RARITY_BITS, np.uint8)
    levels[counts["bucket"].to_numpy()] = np.minimum(3 * np.log2(1 + counts["n"].to_numpy()), RARITY_LEVELS - 1)
    return levels


def _least_overlap(n: np.ndarray, up: int, down: int) -> np.ndarray:
    return -(-n * up // down)


LINES = ("doc_id bigint, text_hash bigint, line_no bigint, set_key bigint, n bigint, bits_a bigint, bits_b bigint, "
         "prefix array<bigint>")


def _prefixes(levels: np.ndarray, shingle: int, percent: int, short: bool):
    """Lines with their set's key and size and their prefix: token above 24 bits of position."""
    def sets(hashes: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, ...]:
        leading, tokens = hashes[np.flatnonzero(np.diff(line, prepend=-1))], _cut(hashes)
        order = (line.astype(np.uint64) << np.uint64(TOKEN_BITS + 7)) | \
            (levels[_bucket(tokens)].astype(np.uint64) << np.uint64(TOKEN_BITS)) | tokens
        order = W.distinct(order)
        line = (order >> np.uint64(TOKEN_BITS + 7)).astype(np.int64)
        tokens = order & np.uint64((1 << TOKEN_BITS) - 1)
        first = np.flatnonzero(np.diff(line, prepend=-1))
        n = np.diff(np.append(first, len(line)))
        key = W.mix64(np.add.reduceat(W.mix64(tokens + W.MIX_B), first) + n.astype(np.uint64) * W.MIX_A)
        # a single token is too short for a key, its hash is not
        key = np.where(n == 1, W.mix64(leading + W.MIX_A), key)
        size = np.minimum(n - _least_overlap(n, percent, 100) + 1, POSITIONS)
        place = np.arange(len(line)) - np.repeat(first, n)
        keep = place < np.repeat(size, n)
        prefix = (tokens[keep] << np.uint64(24)) | place[keep].astype(np.uint64)
        # a 128-bit map of the tokens: sets differ in at least as many tokens as their maps in bits
        one = np.uint64(1) << (tokens & np.uint64(63))
        upper = (tokens & np.uint64(64)) > 0
        bits = [np.bitwise_or.reduceat(np.where(half, one, np.uint64(0)), first) for half in (~upper, upper)]
        return line[first], key, n, bits, prefix, size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, text_hash = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for a, _, data, offsets in _blocks(batch, 2):
                tokens, line, text, number = line_tokens(data, offsets, shingle, short)
                opens = np.diff(line, prepend=-1) > 0
                names, line = line[opens], np.cumsum(opens) - 1
                for at in range(0, len(names), 1 << LINE_BITS):
                    low, high = np.searchsorted(line, [at, at + (1 << LINE_BITS)])
                    if low == high:
                        continue
                    own, key, n, bits, prefix, size = sets(tokens[low:high], line[low:high] - at)
                    own = names[own + at]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[a + text[own]], pa.int64()), pa.array(text_hash[a + text[own]], pa.int64()),
                         pa.array(number[own], pa.int64()), pa.array(W.signed(key)), pa.array(n, pa.int64()),
                         pa.array(W.signed(bits[0])), pa.array(W.signed(bits[1])),
                         W.list_array(W.signed(prefix), size, pa.int64())],
                        ["doc_id", "text_hash", "line_no", "set_key", "n", "bits_a", "bits_b", "prefix"])
    return run


def _deal(cells: int):
    """Prefix places of classes as packed rows, one for each cell of tokens and batch: the shuffle and its sort handle few rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            places = lists.flatten().to_numpy().view(np.uint64)
            keys = np.repeat(batch.column(0).to_numpy(), lists.value_lengths().to_numpy())
            cell = ((places >> np.uint64(24)) % np.uint64(cells)).astype(np.int64)
            order = np.argsort(cell, kind="stable")
            cell, places, keys = cell[order], places[order], keys[order]
            starts = np.flatnonzero(np.diff(cell, prepend=-1))
            ends = np.append(starts[1:], len(cell)).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell[starts], pa.int64()), *[pa.array([x[i:j].tobytes() for i, j in zip(starts.tolist(), ends, strict=True)], pa.binary())
                                                        for x in (places, keys)]], ["cell", "places", "set_keys"])
    return run


def _shared(places: list[bytes], keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Of one cell: one row per token and set, of tokens that at least two sets have."""
    place, key = np.frombuffer(b"".join(places), np.int64), np.frombuffer(b"".join(keys), np.int64)
    token = place >> 24
    order = np.lexsort((key, token))
    place, key, token = place[order], key[order], token[order]
    same_token = token[1:] == token[:-1]
    fresh = np.append(True, ~(same_token & (key[1:] == key[:-1])))
    place, key, token = place[fresh], key[fresh], token[fresh]
    same = token[1:] == token[:-1]
    keep = np.append(False, same) | np.append(same, False)
    return place[keep], key[keep]


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell: the shared tokens of each cell, of which one is held at a time."""
    held, places, keys = None, [], []
    for batch in batches:
        for cell, p, k in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if cell != held and places:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in _shared(places, keys)], ["place", "set_key"])
                places, keys = [], []
            held = cell
            places.append(p)
            keys.append(k)
    if places:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in _shared(places, keys)], ["place", "set_key"])


def _cut_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, lines = [], []
        for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            parts = text.split("\n")
            for w in wanted:
                keys.append(w["set_key"])
                lines.append(parts[w["line_no"]])
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(lines, pa.string())], ["set_key", "line"])


def _similar(shingle: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [W.flat(batch.column(i)) for i in (2, 3)]
            good = np.zeros(batch.num_rows, bool)
            for a, b in W.slices(sides[0][1] + sides[1][1]):
                pair = [W.shingle_sets(W.Words(d[o[a]:o[b]], o[a:b + 1] - o[a], W.ALNUM), shingle) for d, o in sides]
                for at, (x, y) in enumerate(zip(*pair, strict=True), a):
                    union = len(W.distinct(np.concatenate([x, y])))
                    good[at] = 100 * (len(x) + len(y) - union) >= percent * union
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(good)) for i in (0, 1)], ["x", "y"])
    return run


def _drop_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, lines, gone = [], [], []
        for text, removed in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            parts = [] if text is None else text.split("\n")
            bad = set(removed or ())
            texts.append(text if not bad else "\n".join([p for i, p in enumerate(parts) if i not in bad]))
            lines.append(len(parts))
            gone.append(sorted(bad))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(texts, pa.string()), pa.array(lines, pa.int64()),
             pa.array(gone, pa.list_(pa.int64()))], ["row", "text", "n_lines", "removed"])


def _position(prefix: str = "") -> Column:
    return F.struct(F.col(prefix + "doc_id"), F.col(prefix + "text_hash"), F.col(prefix + "line_no"))


def _candidates(later: DataFrame, earlier: DataFrame, percent: int) -> DataFrame:
    """Pairs (x, y) of sets that share a prefix token, y earlier, under the join's filters. Each holds for every similar
    pair, the second for at least one of its tokens."""
    l, e = later.alias("l"), earlier.alias("e")
    n, m = F.col("l.n"), F.col("e.n")
    small = F.least(n, m)
    # length: similar sets are of similar size
    sized = small * 100 >= F.greatest(n, m) * percent
    # prefix: the smaller set's token lies in its shorter prefix
    shorter = F.when(n <= m, F.col("l.pos")).otherwise(F.col("e.pos"))
    within = shorter <= small - F.ceil(small * 2 * percent / F.lit(100.0 + percent) - 1e-9)
    # position: what lies before and behind the shared token must suffice for the overlap
    overlap = F.ceil((n + m) * percent / F.lit(100.0 + percent) - 1e-9)
    room = F.least("l.pos", "e.pos") + F.least(n - F.col("l.pos"), m - F.col("e.pos"))
    # token map: bits that differ are tokens that differ
    differ = sum(F.bit_count(F.col(f"l.{b}").bitwiseXOR(F.col(f"e.{b}"))) for b in ("bits_a", "bits_b"))
    return (l.join(e, (F.col("l.token") == F.col("e.token")) & (F.col("e.first") < F.col("l.first")) & sized & within
                   & (room >= overlap) & (differ <= n + m - 2 * overlap))
            .select(F.col("l.set_key").alias("x"), F.col("e.set_key").alias("y")).distinct())


def removed_lines(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, short: bool = True) -> DataFrame:
    """(doc_id, text_hash, removed): numbers, from 0, of the lines to remove from each document that has any."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).where(
        "doc_id is not null and text is not null")
    hashed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    levels = rarity_levels(docs, shingle, short)
    lines = staged(hashed.mapInArrow(_prefixes(levels, shingle, percent, short), LINES), "lines")

    classes = staged(lines.groupBy("set_key").agg(
        F.min(_position()).alias("first"), F.any_value("n").alias("n"), F.any_value("bits_a").alias("bits_a"),
        F.any_value("bits_b").alias("bits_b"), F.any_value("prefix").alias("prefix"), F.count("*").alias("copies")), "line-classes")
    # a line that is repeated sends its tokens once; a cell holds about CELL_PLACES places, whatever the size of the corpus
    total = classes.agg(F.sum(F.size("prefix"))).first()[0] or 0
    cells = max(64, -(-total // CELL_PLACES))
    dealt = classes.select("set_key", "prefix").mapInArrow(_deal(cells), "cell bigint, places binary, set_keys binary")
    shared = staged(dealt.repartition("cell").sortWithinPartitions("cell").mapInArrow(_repeated, "place bigint, set_key bigint"), "line-shared")
    members = staged(shared.select(F.shiftright("place", 24).alias("token"),
                                   F.col("place").bitwiseAND(F.lit(POSITIONS - 1)).alias("pos"), "set_key")
                     .join(classes.select("set_key", "first", "n", "bits_a", "bits_b"), "set_key"), "line-members")

    def verified(pairs: DataFrame) -> DataFrame:
        """Those x of the pairs (x, y) that are similar to their y. Only the pairs' own lines are fetched."""
        keys = pairs.select(F.col("x").alias("set_key")).union(pairs.select("y")).distinct()
        wanted = staged(classes.join(keys, "set_key").groupBy("first.doc_id", "first.text_hash")
                        .agg(F.collect_list(F.struct("set_key", F.col("first.line_no").alias("line_no"))).alias("wanted")), "line-wanted")
        texts = staged(likely(hashed, "doc_id", wanted.select("doc_id")).join(wanted, ["doc_id", "text_hash"])
                       .dropDuplicates(["doc_id", "text_hash"])
                       .select("text", "wanted").mapInArrow(_cut_lines, "set_key bigint, line string"), "line-texts")
        tx = texts.select(F.col("set_key").alias("x"), F.col("line").alias("line_x"))
        ty = texts.select(F.col("set_key").alias("y"), F.col("line").alias("line_y"))
        return (pairs.join(tx, "x").join(ty, "y").select("x", "y", "line_x", "line_y")
                .mapInArrow(_similar(shingle, percent), "x bigint, y bigint").select("x").distinct())

    # each class against the earliest class of its token
    packed = F.struct("first", "set_key", "n", "pos", "bits_a", "bits_b")
    earliest = staged(members.groupBy("token").agg(F.min(packed).alias("e"), F.count("*").alias("sets")).select("token", "sets", "e.*"),
                      "line-earliest")
    stars = staged(_candidates(members, earliest, percent), "line-stars")
    matched = staged(verified(stars), "line-matched")

    # those without a match against all earlier members, where a token has more than the pair just judged
    crowd = staged(members.join(earliest.where("sets > 2").select("token"), "token", "left_semi"), "line-crowd")
    left = crowd.join(matched.withColumnRenamed("x", "set_key"), "set_key", "left_anti")
    rest = staged(_candidates(left, crowd, percent).join(stars, ["x", "y"], "left_anti"), "line-rest")
    matched = matched.unionByName(verified(rest)).distinct()

    judged = classes.join(matched.select(F.col("x").alias("set_key"), F.lit(True).alias("later")), "set_key", "left")
    judged = judged.where("copies > 1 or later").select("set_key", "first", F.coalesce("later", F.lit(False)).alias("later"))
    judged = staged(judged, "line-judged")
    bad = likely(lines.drop("prefix"), "set_key", judged.select("set_key")).join(judged, "set_key").where(F.col("later") | (_position() != F.col("first")))
    return bad.groupBy("doc_id", "text_hash").agg(F.collect_list("line_no").alias("removed"))


def dedup_lines(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, short: bool = True) -> DataFrame:
    """All columns of ``docs`` with the remaining ``text``, and a struct column ``dedup`` (n_lines, removed), which takes the
    place of one of that name."""
    removed = staged(removed_lines(docs, shingle, percent, short), "line-removed")
    # the other columns ride as one struct, so that they cannot clash with ours
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("text", "dedup")]
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.struct(*others).alias("row"), F.col("text").cast("string").alias("text"))
    ids = removed.select("doc_id")
    untouched = likely(rows, "doc_id", ids, absent=True).select(
        "row", "text", F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("bigint").alias("n_lines"),
        F.expr("cast(array() as array<bigint>)").alias("removed"))
    touched = (likely(rows, "doc_id", ids).withColumn("text_hash", F.xxhash64("text")).join(removed, ["doc_id", "text_hash"], "left")
               .select("row", "text", "removed"))
    kind = touched.select("row").schema.toDDL()
    cut = touched.mapInArrow(_drop_lines, f"{kind}, text string, n_lines bigint, removed array<bigint>")
    columns = [F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns if c != "dedup"]
    return untouched.unionByName(cut).select(*columns, F.struct("n_lines", "removed").alias("dedup"))
