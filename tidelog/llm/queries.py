"""The registered queries of the corpus operators and the SQL they must agree with."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.alignment import align
from tidelog.llm.bpe import encode
from tidelog.llm.common import table
from tidelog.llm.decontaminate import decontaminate
from tidelog.llm.exact_dedup import exact_dedup
from tidelog.llm.hard_negatives import mine
from tidelog.llm.language_id import identify, learn
from tidelog.llm.main_text import extract
from tidelog.llm.mixing import mix
from tidelog.llm.neighbours import nearest
from tidelog.llm.quality import classify
from tidelog.llm.simhash import simhash_dedup
from tidelog.llm.substrings import remove_repeats
from tidelog.llm.token_counts import token_counts

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_substrings(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"), BYTE_BPE)


def op3_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return identify(docs, learn(docs, PIECES))


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents")).taken().select(
        "doc_id", "size", "source_size", "target", "taken")


def op6_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return encode(table(spark, folder, "documents"), WORD_BPE).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def judged(docs: DataFrame, labels: DataFrame, whole_rows: bool = False) -> DataFrame:
    """Documents judged with their source as host and its part in one language as path."""
    return classify(docs, labels, F.col("source"), F.col("lang"), whole_rows=whole_rows)


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    return judged(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op8_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return extract(table(spark, folder, "pages"))


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_dedup(table(spark, folder, "documents"))


def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup(table(spark, folder, "documents"))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    turned = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, turned)


def op12_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated")


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align(table(spark, folder, "documents"), BYTE_BPE, PIECES, groups="digest")


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
  FROM documents),
r AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY h ORDER BY chars DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY h) AS group_size
  FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM r
"""

OP11_SQL = """
WITH r AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS alike,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT alike AND score * 100 BETWEEN 80 * positive_score AND 100 * positive_score
QUALIFY rank <= 5
"""

OP12_SQL = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS n, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
g AS MATERIALIZED (
  SELECT DISTINCT item, size, array_to_string(w[i:i + size - 1], ' ') AS gram
  FROM (SELECT item, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM (SELECT item, w, least(len(w), 10) AS size FROM b WHERE len(w) > 0))),
p AS (
  SELECT n, size, i, array_to_string(w[i:i + size - 1], ' ') AS gram
  FROM (SELECT n, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM d, (SELECT DISTINCT size FROM g) WHERE len(w) >= size)),
h AS MATERIALIZED (SELECT p.n, p.i, p.size, g.item FROM p JOIN g USING (size, gram)),
c AS (SELECT n, count(DISTINCT place) AS n_hit FROM (
        SELECT n, unnest(range(i, i + size)) AS place FROM (SELECT DISTINCT n, i, size FROM h)) GROUP BY n),
l AS (SELECT n, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT n, item FROM h WHERE item IS NOT NULL) GROUP BY n)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (n) LEFT JOIN l USING (n)
"""

QUERIES = {f.__name__: f for f in (
    op1_substrings, op2_token_counts, op3_neighbours, op4_language_id, op5_mixing, op6_bpe, op7_quality,
    op8_main_text, op9_simhash, op10_exact_dedup, op11_hard_negatives, op12_decontaminate, op13_alignment)}
ORACLES = {"op10_exact_dedup": OP10_SQL, "op11_hard_negatives": OP11_SQL, "op12_decontaminate": OP12_SQL}
