"""The queries of the llm operators over the driver's tables, and SQL where it can express them."""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, embed, langid, licenses, lm, packing, quality, sadedup, simhash, toxicity
from .common import table

#: Folder of the public vocabularies, on the driver; another may be named in the environment.
TOKENIZERS = os.environ.get("GRAPHLOOM_TOKENIZERS") or os.path.dirname(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
#: Split pattern of the rank files.
PATTERN = public_tokenizers.PATTERN


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed.near_duplicates(table(spark, sf_dir, "embeddings"), 0.95)


def _fold(modulus: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(_fold(3) != 1).select("doc_id", "toxic")
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select("doc_id", (_fold(3) == 1).alias("held_out"), "score", "predicted")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_multi_50k.tiktoken", PATTERN)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = quality.ledger(table(spark, sf_dir, "documents"))
    return led.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        quality.failed(quality.BASE).alias("base_failed"), (~quality.failed(quality.STRICT)).alias("kept"),
    )


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    names = F.array_sort(F.array_distinct(F.transform("found", lambda x: x["license"])))
    best = F.array_max(F.transform("found", lambda x: x["reduction"]))
    return found.select(
        "doc_id", "n_blocks", F.size(names).cast("long").alias("n_licenses"), F.array_join(names, ",").alias("licenses"),
        F.coalesce(best, F.lit(0.0)).alias("reduction"), F.array_join(F.transform("found", lambda x: x["differences"]), "; ").alias("differences"),
    )


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sadedup.digests(table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/word_bpe_49k.json")


def identified_documents(docs: DataFrame) -> DataFrame:
    """Documents with their language: the lang column is what was declared, the source is the host."""
    return langid.identify(docs, declared=F.col("lang"), host=F.col("source"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identified_documents(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "lang_id", "lang_text", "lang_confidence", langid.verdict().alias("kept"))


def llm_page_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = langid.page_evidence(table(spark, sf_dir, "pages"))
    found = langid.identify(pages, F.col("declared"), F.col("host"), F.col("suffix"))
    return found.select("page_id", "lang_id", "lang_text", "lang_confidence", langid.verdict().alias("kept"))


def op10_context_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (_fold(10) != 0).alias("train"))
    scored = lm.score(docs, "train")
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


OP1_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e,
         embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
         AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS good
  FROM embeddings),
p AS (
  SELECT a.vec_id AS u, b.vec_id AS w FROM (SELECT * FROM v WHERE good) a JOIN (SELECT * FROM v WHERE good) b
  ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
r AS (SELECT vec_id AS node, vec_id AS reached FROM v UNION SELECT r.node, p.w FROM r JOIN p ON p.u = r.reached)
SELECT v.vec_id, (SELECT count(*) FROM p WHERE p.u = v.vec_id) AS n_links, min(r.reached) AS component_id, v.vec_id = min(r.reached) AS kept
FROM v JOIN r ON r.node = v.vec_id GROUP BY v.vec_id
"""

OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(ws[i : i + 7], ' ') AS w
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM d WHERE len(ws) >= 8)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM win) WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM again) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS word_chars,
         len(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) AS n_lines,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         len(list_filter(ws, lambda x: length(x) > 1 AND upper(x) = x AND lower(x) <> x)) AS n_upper_words,
         len(list_filter(ws, lambda x: regexp_matches(x, '\p{L}'))) AS n_letter_words,
         len(list_filter(range(1, len(ws)), lambda i: ws[i] = ws[i + 1])) AS n_stutters
  FROM d LEFT JOIN covered c ON d.doc_id = c.doc_id)
SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 10 * n_symbols > 3 * n_words
            OR 2 * n_upper_words > n_words OR 2 * n_dup_lines > n_lines
            OR word_chars < 2 * n_words OR word_chars > 14 * n_words
            OR 2 * n_letter_words < n_words OR 10 * n_stutters > 3 * n_words) AS kept
FROM m
"""

QUERIES = {
    "op1_embedding_near_dedup": op1_embedding_near_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_simhash": op3_simhash,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_quality_rules": op5_quality_rules,
    "op6_license_scan": op6_license_scan,
    "op7_suffix_array_dedup": op7_suffix_array_dedup,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_language_id": op9_language_id,
    "op10_context_tree_lm": op10_context_tree_lm,
    "llm_page_language": llm_page_language,
}
ORACLE_SQL = {"op1_embedding_near_dedup": OP1_SQL, "op5_quality_rules": OP5_SQL}
