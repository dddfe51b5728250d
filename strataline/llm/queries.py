"""The registered queries of this subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import op1_packing, op2_embeddings, op3_bitsliced, op4_token_files, op5_substrings, op6_language, op7_content
from . import op8_simhash, op9_licences, op10_mixing, op11_lexical, op12_merkle, op13_exact
from .shared import folder_for, table


def op1_pack_sequences(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    return op1_packing.pack(table(spark, folder, "documents"), with_ids=False)


def op2_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings linked at cosine 0.95 and more."""
    return op2_embeddings.near_duplicates(table(spark, folder, "embeddings"))


def op3_top_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """The five best rows for every fiftieth embedding."""
    return op3_bitsliced.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op4_token_files_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """All documents' token ids written as ORC and read back."""
    path = folder_for(spark, "tokens")
    op4_token_files.write_tokens(table(spark, folder, "documents"), path)
    return op4_token_files.checksums(op4_token_files.with_positions(op4_token_files.read_tokens(spark, path)))


def op5_repeated_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without the words of repeated windows of 35 words."""
    return op5_substrings.remove_repeats(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_language_of_text(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    return op6_language.identify(table(spark, folder, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op7_main_text(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    return op7_content.main_text(table(spark, folder, "pages"))


def op8_simhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    return op8_simhash.near_duplicates(table(spark, folder, "documents")).drop("row_key")


def op9_licences_of_text(spark: SparkSession, folder: str) -> DataFrame:
    """The licences that documents state."""
    return op9_licences.scan(table(spark, folder, "documents")).groupBy("doc_id").agg(
        F.array_join(F.array_sort(F.collect_set("licence")), ",").alias("licences"), F.count("*").alias("n_matches"))


def op10_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document in the mix of sources."""
    return op10_mixing.mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_ranked_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The fifty best documents for every benchmark item."""
    return op11_lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_merkle_proofs(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's leaf, proof and folded root in the manifest of all documents; one in five is tampered."""
    return op12_merkle.verify(table(spark, folder, "documents"), op12_merkle.every_fifth())


def op13_exact_copies(spark: SparkSession, folder: str) -> DataFrame:
    """Equal texts of all documents; the one with the largest id stays."""
    return op13_exact.exact_duplicates(table(spark, folder, "documents"), smallest=False)


QUERIES = {f.__name__: f for f in (
    op1_pack_sequences, op2_near_vectors, op3_top_vectors, op4_token_files_round_trip, op5_repeated_windows,
    op6_language_of_text, op7_main_text, op8_simhash_groups, op9_licences_of_text, op10_mix_sources,
    op11_ranked_documents, op12_merkle_proofs, op13_exact_copies)}

ORACLES = {
    "op11_ranked_documents": op11_lexical.ORACLE,
    "op12_merkle_proofs": op12_merkle.ORACLE,
    "op13_exact_copies": """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    "op9_licences_of_text": op9_licences.oracle(),
    "op7_main_text": r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*?)(</article>|$)', 1, 's') AS h FROM pages),
t AS (SELECT page_id, url, trim(regexp_replace(regexp_replace(regexp_replace(h, '</?b>', '', 'g'), '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS t FROM a),
d AS (SELECT page_id, url, regexp_replace(replace(t, '&quot;', '"'), '&amp;?', '&', 'g') AS text FROM t)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM d""",
    "op3_top_vectors": """
WITH q AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
           FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(CAST(a.v AS DOUBLE[]), CAST(b.v AS DOUBLE[])) AS BIGINT) AS score
  FROM q a JOIN q b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 5""",
    "op5_repeated_windows": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
starts AS (
  SELECT doc_id, s, list_aggregate(ws[s:s + 34], 'string_agg', ' ') AS win
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS s FROM w WHERE len(ws) >= 35)),
same AS (SELECT md5(win) AS k FROM starts GROUP BY 1 HAVING count(*) > 1),
hit AS (SELECT doc_id, s FROM starts WHERE md5(win) IN (SELECT k FROM same)),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 35)) AS p FROM hit),
words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
kept AS (
  SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.p) AS t, count(*) AS n
  FROM words LEFT JOIN gone ON gone.doc_id = words.doc_id AND gone.p = words.p
  WHERE gone.p IS NULL GROUP BY 1)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id""",
    "op2_near_vectors": """
WITH RECURSIVE unit AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS n
  FROM embeddings),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b ON a.vec_id <> b.vec_id
  WHERE list_dot_product(a.v, b.v) / (a.n * b.n) >= 0.95),
reach(a, b) AS (SELECT vec_id, vec_id FROM unit UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
least AS (SELECT a, min(b) AS c FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(degree.n, 0) AS BIGINT) AS n_links, c AS component_id, vec_id = c AS kept
FROM unit JOIN least ON least.a = vec_id LEFT JOIN degree ON degree.a = vec_id""",
}
