"""Corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read back as the next stage's
``docs``; all stages but the last return the columns of ``documents``. ``run`` applies them to the documents of ``sf_dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.llm.frames import read, staged, without
from zonecast.llm.op1_quality import keep_good
from zonecast.llm.op2_lines import dedup_lines
from zonecast.llm.op7_minhash import keep_representatives, near_duplicates
from zonecast.llm.op9_decontaminate import drop_contaminated
from zonecast.llm.op10_packing import pack_documents


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly trained classifier keeps."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat an earlier line, short ones included; those of which nothing but blank lines is left go."""
    cut = dedup_lines(docs).where((F.size("dedup.removed") == 0) | (F.trim(F.translate("text", "\r\n\t", "   ")) != ""))
    columns = [F.length("text").cast("bigint").alias("n_chars") if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns]
    return cut.select(*columns)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8 or more.

    The line dedup before takes from a near copy the lines that it shares, and what is left resembles nothing. So documents are judged by their
    whole texts in ``documents`` first, among those that are still there; then those that stay by the texts they have now."""
    whole = read(spark, sf_dir, "documents").select("doc_id", "text")
    still = docs.select("doc_id").where("doc_id is not null").distinct()
    judged = near_duplicates(whole.join(still, "doc_id", "left_semi"), shingle_words=5, percent=80)
    # a doc_id goes if none of its rows stands for a group
    copies = staged(judged.groupBy("doc_id").agg(F.bool_or("kept").alias("kept")).where("not kept").select("doc_id"), "near-copies")
    return keep_representatives(without(docs, "doc_id", copies), shingle_words=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of ten words of a benchmark item occurs."""
    return drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All remaining documents, cut into pieces where too long, packed into sequences."""
    return pack_documents(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", minhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: EM, a trained scorer and best-fit packing are beyond SQL; tests/llm holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
