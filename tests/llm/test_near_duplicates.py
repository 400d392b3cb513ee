"""Line dedup, MinHash and vector near-duplicates against brute force."""

from __future__ import annotations

import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.llm import op2_lines, op6_embeddings, op7_minhash
from zonecast.llm.frames import components, likely, without


def shingles(text, n, pattern, short):
    words = re.findall(pattern, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < n:
        return {tuple(words)} if words and short else set()
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}


def reach(ids, links):
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            for x in (a, b):
                if label[x] != low:
                    label[x], changed = low, True
    return label


def edited(words, text, every):
    parts = text.split()
    for i in range(every // 2, len(parts), every):
        parts[i] = words.word()
    return " ".join(parts)


# ---- components -------------------------------------------------------------------------------------------

def test_components_match_union(spark, words):
    edges = [(words.pick(300), words.pick(300)) for _ in range(160)] + [(i, i + 1) for i in range(400, 460)] + [(5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    edges = [e for e in edges if e[0] != e[1]]
    want = reach({x for e in edges for x in e}, edges)
    assert got == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_without_and_likely(spark, docs):
    df = docs([(i, str(i)) for i in range(50)] + [(None, "n"), (3, "again")])
    ids = docs([(3, ""), (7, ""), (99, "")]).select("doc_id")
    assert sorted(r.text for r in without(df, "doc_id", ids).collect()) == sorted([str(i) for i in range(50) if i not in (3, 7)] + ["n"])
    assert {3, 7} <= {r.doc_id for r in likely(df, "doc_id", ids).collect()}


# ---- operator 7 -------------------------------------------------------------------------------------------

def brute_minhash(rows, n, percent):
    """Component of each row: smallest doc_id among the rows that its text reaches."""
    sets = [shingles(t, n, r"[^\x20\x09-\x0D]+", True) for _, t in rows]
    at = [k for k, (i, _) in enumerate(rows) if i is not None]
    links = [(a, b) for a in at for b in at if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    label = reach(at, links)
    lowest = {}
    for k in at:
        lowest[label[k]] = min(lowest.get(label[k], rows[k][0]), rows[k][0])
    return sorted([(i, len(s), lowest[label[k]] if i is not None else None, i is not None and lowest[label[k]] == i)
                   for k, ((i, _), s) in enumerate(zip(rows, sets, strict=True))], key=str)


def check_minhash(docs, rows, n=3, percent=85):
    out = op7_minhash.near_duplicates(docs(rows), n, percent).collect()
    assert sorted([tuple(r) for r in out], key=str) == brute_minhash(rows, n, percent)


def test_minhash_copies_near_copies_and_edge_cases(docs, words):
    base = [words.text(120) for _ in range(12)]
    rows = list(enumerate(base))
    rows += [(100 + i, t) for i, t in enumerate(base[:4])]  # exact copies
    rows += [(200 + i, edited(words, base[i], 70)) for i in range(8)]  # near
    rows += [(300 + i, edited(words, base[i], 9)) for i in range(8)]  # too far
    rows += [(400, ""), (401, None), (402, " \t\n"), (403, "one"), (404, "ONE"), (405, "one two"), (406, "one  two"), (407, "two one")]
    rows += [(None, base[0]), (None, None), (500, base[1]), (500, base[1]), (501, base[2]), (501, base[9])]
    rows += [(600, words.text(30_000))]
    rows += [(601, edited(words, rows[-1][1], 500))]
    check_minhash(docs, rows)


def test_minhash_large_groups_just_under_and_over_the_threshold(docs, words):
    base = words.text(200)
    rows = [(i, edited(words, base, 60 + i % 60)) for i in range(90)]  # a crowd around 0.8 to 0.95
    rows += [(1000 + i, edited(words, base, 25)) for i in range(60)]  # a crowd that shares buckets, unlinked
    check_minhash(docs, rows)
    check_minhash(docs, rows, 5, 80)


def test_minhash_empty_table_and_clashing_columns(docs):
    assert op7_minhash.near_duplicates(docs([])).count() == 0
    wide = docs([(1, "a b c"), (2, "a b c")]).withColumn("node", F.lit(9)).withColumn("component_id", F.lit("x")).withColumn("key", F.lit(0))
    assert {(r.doc_id, r.component_id) for r in op7_minhash.near_duplicates(wide).collect()} == {(1, 1), (2, 1)}


def test_keep_representatives_keeps_one_whole_row_per_group(spark, docs, words):
    text = words.text(60)
    df = docs([(2, text), (1, text), (3, words.text(60)), (3, None), (None, text), (5, ""), (6, "")]).withColumns(
        {"source": F.lit("s"), "id_bucket": F.lit(1), "row_mark": F.lit("r"), "a.b": F.lit(0)})
    out = op7_minhash.keep_representatives(df)
    assert out.columns == df.columns
    ids = [r.doc_id for r in out.collect()]
    assert sorted(ids, key=str) == sorted([1, 3, 3, None, 5, 6], key=str)


def test_keep_representatives_of_repeated_rows(docs, words):
    a, b = words.text(60), words.text(60)
    df = docs([(1, a), (1, a), (1, b), (2, b), (3, a), (4, edited(words, a, 50))])
    assert sorted((r.doc_id, r.text) for r in op7_minhash.keep_representatives(df).collect()) == sorted([(1, a), (1, b)])


def test_similarity_matrix_is_exact(words):
    texts = [words.text(50).encode() for _ in range(6)]
    texts += [edited(words, texts[0].decode(), 40).encode(), b"", b"a b"]
    xs, ys = texts, texts[::-1]
    got = op7_minhash.similar_matrix(3, 60, columns=16)(xs, ys)
    for i, x in enumerate(xs):
        for j, y in enumerate(ys):
            a, b = (shingles(t.decode(), 3, r"\S+", True) for t in (x, y))
            assert got[i, j] == bool(a & b and 100 * len(a & b) >= 60 * len(a | b))


# ---- operator 2 -------------------------------------------------------------------------------------------

def brute_lines(rows):
    lines = [((i, n), shingles(line, 5, r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", True), line)
             for i, text in rows if i is not None and text is not None for n, line in enumerate(text.split("\n"))]
    lines.sort(key=lambda x: x[0])
    gone = set()
    for k, (place, s, _) in enumerate(lines):
        if s and any(t and 100 * len(s & t) >= 80 * len(s | t) for _, t, _ in lines[:k]):
            gone.add(place)
    return {i: "\n".join(line for n, line in enumerate(text.split("\n")) if (i, n) not in gone)
            for i, text in rows if i is not None and text is not None}, gone


def test_line_dedup_against_brute_force(docs, words):
    pool = [words.text(8 + words.pick(60)) for _ in range(40)]
    rows = []
    for i in range(60):
        lines = [words.text(12) for _ in range(2)] + [pool[words.pick(40)] for _ in range(3)]
        lines += [edited(words, pool[words.pick(40)], 20 + words.pick(40)), "short one", "", "###"]
        rows.append((i, "\n".join(lines)))
    rows += [(100, ""), (101, None), (102, "one line of some five words here\n" * 3), (103, words.text(20_000)), (None, pool[0])]
    want, gone = brute_lines(rows)
    out = op2_lines.dedup_lines(docs(rows)).collect()
    assert len(out) == len(rows)
    assert gone
    for r in out:
        if r.doc_id is None:
            assert r.text == pool[0] and r.dedup.removed == []
        elif r.doc_id == 101:
            assert r.text is None and r.dedup.n_lines == 0
        else:
            assert r.text == want[r.doc_id]
            assert sorted(r.dedup.removed) == sorted(n for i, n in gone if i == r.doc_id)


def test_one_line_in_most_documents(docs, words):
    hot = words.text(60)
    rows = [(i, f"{words.text(15)}\n{hot}") for i in range(300)]
    out = {r.doc_id: r.text for r in op2_lines.dedup_lines(docs(rows)).collect()}
    assert hot in out[0] and not any(hot in out[i] for i in range(1, 300))


def test_line_dedup_ties_repeats_and_clashing_columns(docs, words):
    a, b = words.text(10), words.text(10)
    df = docs([(1, a), (1, a), (1, b), (2, a)]).withColumn("dedup", F.lit(1)).withColumn("text_hash", F.lit("x")).withColumn("row", F.lit(0))
    out = op2_lines.dedup_lines(df)
    assert sorted(out.columns) == sorted(["doc_id", "text", "text_hash", "row", "dedup"])
    assert sorted((r.doc_id, r.text) for r in out.collect()) == sorted([(1, a), (1, a), (1, b), (2, "")])
    assert op2_lines.dedup_lines(docs([])).count() == 0


# ---- operator 6 -------------------------------------------------------------------------------------------

VEC = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))])


def brute_vectors(rows):
    unit = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        x = np.array(v, np.float32).astype(float)
        unit[i] = x / np.linalg.norm(x)
    links = [(a, b) for a in unit for b in unit if a < b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.9]
    return links, reach([i for i, _ in rows if i is not None], links)


def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(24).tolist()) for i in range(300)]
    centre = rng.standard_normal(24)
    rows += [(1000 + i, (centre + 0.25 * rng.standard_normal(24)).tolist()) for i in range(120)]  # around the threshold
    rows += [(2000 + i, (3 * np.array(rows[i % 7][1])).tolist()) for i in range(40)]  # scaled copies
    rows += [(3000, None), (3001, []), (3002, [0.0] * 24), (3003, [float("nan")] * 24), (3004, [None] + [1.0] * 23),
             (3005, [float("inf")] * 24), (3006, [1.0, 2.0]), (3007, [2.0, 4.0]), (None, rows[0][1])]
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    links, label = brute_vectors(rows)
    n = {i: 0 for i, _ in rows}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    out = op6_embeddings.near_vectors(spark.createDataFrame(rows, VEC)).collect()
    assert len(out) == len(rows)
    for r in out:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, False)
        else:
            assert (r.vec_id, r.n_links, r.component_id) == (r.vec_id, n[r.vec_id], label[r.vec_id])
            assert r.kept is (r.vec_id == r.component_id)


def test_vectors_empty_table_and_clashing_columns(spark):
    assert op6_embeddings.near_vectors(spark.createDataFrame([], VEC)).count() == 0
    wide = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0])], VEC).withColumn("node", F.lit(5)).withColumn("unit", F.lit("u"))
    assert {(r.vec_id, r.n_links, r.component_id) for r in op6_embeddings.near_vectors(wide).collect()} == {(1, 1, 1), (2, 1, 1)}


@pytest.mark.parametrize("n", [100, 10_000, 10_000_000])
def test_tables_follow_the_miss_bound(n):
    k, tables = op6_embeddings.plan(n, 0.9)
    near = op6_embeddings.collision((2 - 1.8) ** 0.5)
    assert (1 - near ** k) ** tables <= op6_embeddings.MISS
    assert n * op6_embeddings.collision(2 ** 0.5) ** k <= max(1, n / 300)


def test_many_cells_and_repeated_lines(docs, words, monkeypatch):
    """Tokens dealt to many small cells, lines that repeat often: the same lines go."""
    monkeypatch.setattr(op2_lines, "CELL_PLACES", 4)
    lines = [words.text(9) for _ in range(12)]
    rows = [(i, "\n".join([lines[i % 12], edited(words, lines[(i + 5) % 12], 40), words.text(7)])) for i in range(40)]
    want, gone = brute_lines(rows)
    assert {r.doc_id: r.text for r in op2_lines.dedup_lines(docs(rows)).collect()} == want
    assert gone


def test_line_dedup_without_short_lines(docs, words):
    rows = [(1, "Les.\nLes."), (2, "Les.")]
    assert {r.doc_id: r.text for r in op2_lines.dedup_lines(docs(rows), short=False).collect()} == dict(rows)


def test_line_dedup_with_short_lines_against_brute_force(docs, words):
    long = [words.text(12) for _ in range(6)]
    rows = [(1, f"Les.\n{long[0]}\nAnd ornd.\n\none two three four"), (2, f"les\n{long[1]}\nand  ornd\n***\n***\nfour three two one"),
            (3, f"Les.\n{long[0]}\nAnd ornd.\n\none two three four"), (4, f"{long[2]}\none two three\nOne two three four!"),
            (5, "la la la la\nla la la la la\nla la la la la la"), (6, "\n".join(["Les."] * 50)), (7, None), (None, "Les.")]
    rows += [(100 + i, f"{words.word()}\n{long[i % 6]}\n{words.word()} {words.word()}") for i in range(30)]
    seen, want = set(), {}
    for i, text in rows:
        if i is None or text is None:
            continue
        kept = []
        for line in text.split("\n"):
            s = frozenset(shingles(line, 5, r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", True))
            if not s or not any(100 * len(s & t) >= 80 * len(s | t) for t in seen):
                kept.append(line)
            seen |= {s} if s else set()
        want[i] = "\n".join(kept)
    out = op2_lines.dedup_lines(docs(rows)).collect()
    assert {r.doc_id: r.text for r in out if r.doc_id is not None and r.text is not None} == want
    assert want[2] == f"{long[1]}\n***\n***\nfour three two one" and want[6] == ""
    assert sorted(r.text for r in out if r.doc_id is None) == ["Les."]


def test_vectors_of_a_repeated_id_are_linked_on_their_own(spark):
    rng = np.random.default_rng(5)
    x, y = rng.standard_normal((2, 64))
    rows = [(1, x), (1, y), (5, x + 0.01 * rng.standard_normal(64)), (3, y + 0.01 * rng.standard_normal(64)), (9, rng.standard_normal(64))]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id bigint, embedding array<double>")
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in op6_embeddings.near_vectors(df).collect())
    assert got == [(1, 1, 1, True), (1, 1, 1, True), (3, 1, 1, False), (5, 1, 1, False), (9, 0, 9, True)]
