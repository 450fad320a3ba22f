"""Registered queries of this package: one ``opN_<name>`` per operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from needbridge.llm import (
    collocations, cover_tree, decontam, ego_join, fixity, kneser_ney, line_dedup, ngram_join, packing, pii, secrets, syncmers, wrappers)
from needbridge.llm.common import table


def op1_pii_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.train(docs))


def op2_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op3_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_adaptive_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_documents(table(spark, sf_dir, "documents"))


def op5_merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as WARC records against a replica whose faults hang on the records' hashes."""
    records = fixity.records_of(table(spark, sf_dir, "pages"))
    return fixity.audit(fixity.leaves(records), fixity.leaves(fixity.damaged_copy(records)))


def op6_ego_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ego_join.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(table(spark, sf_dir, "pages"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.removed_lines(table(spark, sf_dir, "documents"))


def op10_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprint_edits(table(spark, sf_dir, "documents"))


def op12_prefix_free_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_cover_tree_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return cover_tree.mine(cover_tree.quantized(vectors.withColumn("label", label)), F.col("vec_id") % 50 == 0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_pii_boosting": op1_pii_boosting,
        "op2_secret_forest": op2_secret_forest,
        "op3_kneser_ney": op3_kneser_ney,
        "op4_adaptive_jaccard": op4_adaptive_jaccard,
        "op5_merkle_audit": op5_merkle_audit,
        "op6_ego_join": op6_ego_join,
        "op7_containment": op7_containment,
        "op8_wrappers": op8_wrappers,
        "op9_line_dedup": op9_line_dedup,
        "op10_best_two_fit": op10_best_two_fit,
        "op11_closed_syncmers": op11_closed_syncmers,
        "op12_prefix_free_phrases": op12_prefix_free_phrases,
        "op13_cover_tree_negatives": op13_cover_tree_negatives,
    }


def oracle_sql() -> dict[str, str]:
    """Twins of the queries that SQL can express."""
    return {
        "op5_merkle_audit": OP5,
        "op12_prefix_free_phrases": OP12,
        "op13_cover_tree_negatives": OP13,
    }


#: The audit's result from the records and faults alone: no tree, every record compared.
OP5 = r"""
WITH rec AS (
  SELECT coalesce(floor(page_id / 1000.0), -1)::BIGINT AS archive, page_id,
    encode('WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:'
      || coalesce(page_id::VARCHAR, '') || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
      || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, ''))::VARCHAR
      || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10)) AS bytes
  FROM pages),
hashed AS (
  SELECT archive, page_id, octet_length(bytes)::BIGINT AS length, sha256(bytes) AS h,
    sha256(unhex(substr(hex(bytes), 1, 18) || '58' || substr(hex(bytes), 21))) AS changed,
    (sum(octet_length(bytes)) OVER (PARTITION BY archive ORDER BY page_id, hex(bytes)
      ROWS UNBOUNDED PRECEDING) - octet_length(bytes))::BIGINT AS "offset"
  FROM rec)
SELECT archive, "offset", length, page_id,
  CASE WHEN h LIKE '00%' THEN 'missing' ELSE 'damaged' END AS status, h AS expected,
  CASE WHEN h NOT LIKE '00%' THEN changed END AS found
FROM hashed WHERE substr(h, 1, 2) IN ('00', '40', '80', 'c0')
"""

#: All n-grams counted one by one, without a parse.
OP12 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, list_filter(string_split_regex(piece, '[ \x09]+'), lambda x: x <> '') AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
sizes AS (SELECT lang, count(*) AS n FROM places GROUP BY lang),
grams AS (
  SELECT lang, k, list_slice(w, i, i + k - 1) AS g, count(*) AS f
  FROM places, (VALUES (1), (2), (3)) AS t(k) WHERE i + k - 1 <= len(w) GROUP BY ALL),
cand AS (SELECT lang, k, g, f AS a FROM grams WHERE k > 1 AND f >= 10),
cuts AS (
  SELECT c.lang, c.g, c.a, cut, x.f AS l, y.f AS r,
    (1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM cand) c
  JOIN grams x ON x.lang = c.lang AND x.g = list_slice(c.g, 1, c.cut)
  JOIN grams y ON y.lang = c.lang AND y.g = list_slice(c.g, c.cut + 1, c.k)),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
kept AS (
  SELECT * FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM cand t WHERE t.k = 3 AND len(b.g) = 2 AND t.lang = b.lang
      AND (list_slice(t.g, 1, 2) = b.g OR list_slice(t.g, 2, 3) = b.g) AND 100 * t.a >= 50 * b.a)),
named AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score FROM kept)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
  a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM named JOIN sizes USING (lang) QUALIFY rank <= 2000
"""

#: All anchors against all rows.
OP13 = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_dot_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)),
positives AS (
  SELECT * FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.other_id AS positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY n.score DESC, n.other_id)::INTEGER AS rank,
  n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3
"""
