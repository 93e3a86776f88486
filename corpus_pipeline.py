"""The corpus pipeline: documents through five stages of the llm operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, with the columns of documents but for the last.
A stage's result is written as Parquet in the shared folder and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm import langid, packing, quality, queries, sadedup, simhash
from graphloom.llm.common import shared_dir, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the strict policy.

    Null, empty texts and such without words fail it; repeated rows are judged each for itself; texts of any length
    are measured whole; ids and further columns don't matter; an empty table gives an empty one.
    """
    return quality.keep_passing(docs, quality.STRICT)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found with confidence, and whose text reads as that language and fits it.

    Texts without letters, null or empty, are rejected; a null lang or source is no evidence; repeated rows are judged
    each for itself; of equally likely languages the first by code is taken; without any declared language none is
    found and all are rejected; an empty table gives an empty one.
    """
    return queries.identified_documents(docs).where(langid.verdict()).select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group that five-word shingles and a Jaccard similarity of 0.8 or more link.

    Rows with one id are one document: they stay if one of them leads its group. Rows without an id belong to no
    group and stay. Texts without words are copies of one another; an empty table gives an empty one.
    """
    groups = simhash.similar_documents(docs, size=5, similarity=0.8)
    kept = groups.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    unnamed = docs.where(F.col("doc_id").isNull())
    return docs.join(kept, "doc_id", "left_semi").select(*docs.columns).unionByName(unnamed)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of 100 bytes that an earlier place holds; n_chars is that of what is left.

    All documents stay, with whatever is left of them, also nothing; null texts stay null; rows with one id are one
    document and lose the same places; rows without an id stay as they are; an empty table gives an empty one.
    """
    left = sadedup.deduplicated(docs)
    counted = F.when(F.col("text").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType)
    return left.withColumn("n_chars", counted).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents, packed into sequences of at most 2048 tokens.

    A null or empty text is its end mark alone; repeated rows are packed each for itself; only documents longer than a
    sequence are cut; pieces of equal length fit equally well, any of them is taken; an empty table gives no piece.
    """
    return packing.pack_documents(docs, f"{queries.TOKENIZERS}/word_bpe_49k.json")


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: SQL cannot express SimHash, the tokenizer and best fit; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        out, path = stage(spark, docs, sf_dir), shared_dir(spark)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
