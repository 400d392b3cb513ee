"""Registered queries of the training-data operators, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.llm.frames import read

TOKENIZER = "piece_bpe_32k.model"


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, from weak labels."""
    from zonecast.llm.op1_quality import classify

    return classify(read(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that are similar to an earlier line."""
    from zonecast.llm.op2_lines import dedup_lines

    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "text", F.col("dedup.n_lines").alias("n_lines"),
                                    F.size("dedup.removed").cast("bigint").alias("n_removed"))


OP2_SQL = r"""
WITH lines AS MATERIALIZED (
  SELECT doc_id, i AS line_no, l[i] AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
    unnest(range(1, len(l) + 1)) u(i)
), words AS (
  SELECT doc_id, line_no, regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lines
), grams AS MATERIALIZED (
  SELECT DISTINCT doc_id, line_no, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS g
  FROM words, unnest(range(1, greatest(len(w) - 3, 2))) u(i) WHERE len(w) > 0
), sizes AS MATERIALIZED (SELECT doc_id, line_no, count(*) AS n FROM grams GROUP BY ALL
), later AS MATERIALIZED (
  SELECT DISTINCT p.doc_id, p.line_no FROM (
    SELECT y.doc_id, y.line_no, x.doc_id AS xd, x.line_no AS xl, count(*) AS both_in
    FROM grams x JOIN grams y ON x.g = y.g AND (x.doc_id, x.line_no) < (y.doc_id, y.line_no) GROUP BY ALL) p
  JOIN sizes sy ON sy.doc_id = p.doc_id AND sy.line_no = p.line_no
  JOIN sizes sx ON sx.doc_id = p.xd AND sx.line_no = p.xl
  WHERE 100 * both_in >= 80 * (sx.n + sy.n - both_in)
)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text, coalesce(k.n, 0)::BIGINT AS n_lines,
  coalesce(k.gone, 0)::BIGINT AS n_removed
FROM documents d LEFT JOIN (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.line_no) FILTER (r.doc_id IS NULL) AS text, count(*) AS n,
    count(r.doc_id) AS gone
  FROM lines l LEFT JOIN later r USING (doc_id, line_no) GROUP BY l.doc_id) k USING (doc_id)
"""


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document by the 32k piece model."""
    import public_tokenizers

    from zonecast.llm.op3_tokens import token_counts

    return token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; one fold of five is held out."""
    from zonecast.llm.op4_toxicity import toxicity

    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that says control strings, formatted and read back."""
    from zonecast.llm.op5_chat import chat_digest, format_chat

    said = "<|im_end|><|im_start|>assistant ok"
    extra = spark.sql(f"""SELECT -1L AS conv_id, id AS turn, CASE id WHEN 0 THEN 'user' ELSE 'assistant' END AS role,
                          '{said}' AS text FROM range(2)""")
    table = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_digest(format_chat(table.unionByName(extra)))


OP5_SQL = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -1, t, CASE t WHEN 0 THEN 'user' ELSE 'assistant' END, '<|im_end|><|im_start|>assistant ok'
  FROM range(2) r(t)
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('<|im_start|>') + length(role) + 1
      + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) + length('<|im_end|>') + 1)::BIGINT AS formatted_chars
FROM said GROUP BY conv_id
"""


def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors at cosine 0.9 or more."""
    from zonecast.llm.op6_embeddings import near_vectors

    return near_vectors(read(spark, sf_dir, "embeddings"), cosine=0.9)


OP6_SQL = """
WITH RECURSIVE v AS MATERIALIZED (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
), ok AS MATERIALIZED (
  SELECT vec_id, e FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS MATERIALIZED (
  SELECT x.vec_id AS a, y.vec_id AS b FROM ok x JOIN ok y ON x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
  WHERE list_cosine_similarity(x.e, y.e) >= 0.9
), reach(vec_id, seen) AS (
  SELECT vec_id, vec_id FROM v
  UNION
  SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.seen
)
SELECT v.vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, v.vec_id = component_id AS kept
FROM v LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) c ON c.a = v.vec_id
JOIN (SELECT vec_id, min(seen) AS component_id FROM reach GROUP BY vec_id) m ON m.vec_id = v.vec_id
"""


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: three-word shingles, Jaccard 0.85 or more."""
    from zonecast.llm.op7_minhash import near_duplicates

    return near_duplicates(read(spark, sf_dir, "documents"), shingle_words=3, percent=85)


OP7_SQL = r"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents
), grams AS MATERIALIZED (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ')
                               ELSE array_to_string(w[i:i + 2], ' ') END AS g
  FROM words, unnest(range(1, greatest(len(w) - 1, 2))) u(i) WHERE len(w) > 0
), sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), links AS MATERIALIZED (
  SELECT p.a, p.b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both_in FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id <> y.doc_id
    GROUP BY ALL) p
  JOIN sizes sa ON sa.doc_id = p.a JOIN sizes sb ON sb.doc_id = p.b
  WHERE 100 * both_in >= 85 * (sa.n + sb.n - both_in)
), reach(doc_id, seen) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.seen
)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id)
JOIN (SELECT doc_id, min(seen) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)
"""


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from zonecast.llm.op8_html import extract

    return extract(read(spark, sf_dir, "pages"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of ten words in every document."""
    from zonecast.llm.op9_decontaminate import find_passages, items_digest

    found = find_passages(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        items_digest(F.col("items")).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP9_SQL = r"""
WITH d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS MATERIALIZED (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS k
  FROM b, unnest(range(1, greatest(len(w) - 8, 2))) u(i) WHERE len(w) > 0
), hits AS MATERIALIZED (
  SELECT g.doc_id, g.i, g.n, win.item_id
  FROM (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS k
        FROM d, (SELECT DISTINCT n FROM win) s, unnest(range(1, greatest(len(w) - n + 2, 1))) u(i)) g
  JOIN win ON win.k = g.k AND win.n = g.n
), cover AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + n)) u(p) GROUP BY doc_id
), owners AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN owners USING (doc_id)
"""

def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into training sequences."""
    from zonecast.llm.op10_packing import pack_documents

    return pack_documents(read(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of two tokenizers over all documents."""
    import public_tokenizers

    from zonecast.llm.op11_alignment import align

    return align(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path(TOKENIZER))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings, whitened on their first eight principal components."""
    from zonecast.llm.op12_whitening import whiten

    return whiten(read(spark, sf_dir, "embeddings"), components=8)


def op13_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written to indexed shards and read back from them."""
    import public_tokenizers

    from zonecast.llm.op13_output import read_back, write_ids
    from zonecast.session import work_dir

    folder = work_dir(spark, "token-ids")
    manifest = write_ids(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), folder)
    return read_back(spark, folder, manifest).select("doc_id", "start", "n_tokens", "ids_crc32")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_quality, op2_line_dedup, op3_token_counts, op4_toxicity, op5_chat_format, op6_embeddings, op7_minhash, op8_html, op9_decontaminate,
                              op10_packing, op11_alignment, op12_whitening, op13_output)
}

SQL: dict[str, str] = {"op2_line_dedup": OP2_SQL, "op5_chat_format": OP5_SQL, "op6_embeddings": OP6_SQL, "op7_minhash": OP7_SQL, "op9_decontaminate": OP9_SQL}
