"""The corpus pipeline on a small corpus with planted cases, and the entry's guard."""

from __future__ import annotations

import corpus_pipeline as C
from pyspark.sql import types as T

KIND = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
ITEM = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])


def corpus(words):
    prose = lambda n: ". ".join(words.text(9).capitalize() for _ in range(n)) + "."
    clean = {i: "\n".join(prose(4) for _ in range(3)) for i in range(40)}
    passage, item = words.text(60), words.text(20)
    docs = dict(clean)
    docs |= {100 + i: words.text(50).replace(" ", "%%% ") for i in range(12)}  # junk
    docs |= {200 + i: prose(3) + "\n" + passage for i in range(4)}  # one passage in several documents
    docs[300] = clean[0]  # a copy
    near = clean[1].replace("\n", " ").split()
    near[20] = "changed"
    docs[301] = " ".join(near)  # a near copy in one line
    docs[302] = prose(2) + " " + item + " " + prose(2)  # a leak
    docs |= {400: None, 401: ""}
    return clean, docs, passage, item


def test_stages_in_order():
    assert [name for name, _ in C.STAGES] == ["quality_classifier", "line_dedup", "minhash_near_dedup", "benchmark_decontamination",
                                              "best_fit_packing"]


def test_each_stage_on_planted_cases(spark, words, tmp_path):
    clean, docs, passage, item = corpus(words)
    rows = [(i, t, "xx", "s", None if t is None else len(t)) for i, t in docs.items()]
    sf = str(tmp_path)
    spark.createDataFrame(rows, KIND).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, item)], ITEM).write.parquet(f"{sf}/benchmark.parquet")
    df = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {}
    for name, stage in C.STAGES:
        out = stage(spark, df, sf)
        if name != "best_fit_packing":
            assert out.columns == df.columns
        out.write.parquet(f"{sf}/{name}")
        df = spark.read.parquet(f"{sf}/{name}")
        kept[name] = {r.doc_id: r for r in df.collect()}
    first = kept["quality_classifier"]
    assert set(clean) <= set(first) and not any(100 <= i < 112 or i >= 400 for i in first)
    lines = kept["line_dedup"]
    assert set(clean) <= set(lines) and all(lines[i].text == clean[i] for i in clean)
    assert 300 not in lines  # nothing of a copy is left
    assert passage in lines[200].text and not any(passage in lines[i].text for i in (201, 202, 203))
    assert all(r.n_chars == len(r.text) for r in lines.values())
    near = kept["minhash_near_dedup"]
    assert 301 not in near and set(clean) <= set(near)
    assert 302 in near and 302 not in kept["benchmark_decontamination"] and set(clean) <= set(kept["benchmark_decontamination"])
    packed = spark.read.parquet(f"{sf}/best_fit_packing").collect()
    want = {i: len(r.text.split()) + 1 for i, r in kept["benchmark_decontamination"].items()}
    got: dict[int, int] = {}
    for r in packed:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.n_tokens
    assert got == want
    # run() gives the rows of the stages in sequence
    assert sorted((r.doc_id, r.n_tokens) for r in C.run(spark, sf).collect()) == sorted((r.doc_id, r.n_tokens) for r in packed)


def test_empty_corpus(spark, tmp_path):
    sf = str(tmp_path)
    spark.createDataFrame([], KIND).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], ITEM).write.parquet(f"{sf}/benchmark.parquet")
    assert C.run(spark, sf).count() == 0


def test_entry_lists_all_queries_of_the_subpackage():
    import __spark_entry__ as E

    names = E.queries()
    assert [n for n in range(1, 11) if not any(q.startswith(f"op{n}_") for q in names)] == [] and "pipeline" in names
    assert set(E.oracle_sql()) <= set(names)


def test_line_dedup_leaves_nothing_of_a_copy_with_short_lines(spark, words):
    text = "\n".join(["Les.", words.text(30), "And ornd.", words.text(30)])
    rows = [(1, text, "xx", "s", len(text)), (2, text, "xx", "s", len(text)), (3, "And ornd.\n" + words.text(20), "xx", "s", 0)]
    out = {r.doc_id: r.text for r in C.line_dedup(spark, spark.createDataFrame(rows, KIND), "").collect()}
    assert out == {1: text, 3: rows[2][1].split("\n")[1]}
