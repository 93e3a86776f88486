"""From chunks of text to extraction input: term density, splitting, numbering, incremental decisions."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..plans.durable import cut
from . import patterns, retrieve


def term_counts(chunks: DataFrame, terms: DataFrame) -> DataFrame:
    """(id, n_terms, n_words, density): different terms (column term) of one or more words in each chunk (id, text)."""
    found = retrieve.phrase_hits(chunks, terms, 2).groupBy("id").agg(F.count("*").alias("n_terms"))
    n_words = F.size(F.filter(F.split("text", r"\s+"), lambda w: w != ""))
    base = chunks.select("id", n_words.cast("long").alias("n_words"))
    out = base.join(found, "id", "left").withColumn("n_terms", F.coalesce("n_terms", F.lit(0)))
    return out.withColumn("density", F.when(F.col("n_words") > 0, F.round(F.col("n_terms") / F.col("n_words"), 4)).otherwise(F.lit(0.0)))


def chunk_config(density: Column, dense: float = 0.05) -> tuple[Column, Column]:
    """Token budget of a part and its overlap (15 % rounded): less where terms are dense."""
    size = F.when(density >= dense, 256).otherwise(512)
    return size, F.when(density >= dense, 38).otherwise(77)


def split_parts(chunks: DataFrame, budget: int = 120, overlap: int = 18) -> DataFrame:
    """(id, part, text, n_tokens): sentences packed in order into parts of at most the budget of white-space tokens.

    A part starts with the last sentences of the one before it that fit the overlap. A longer sentence is a part alone.
    """

    def pack(sentences: list[str]) -> Iterator[list[str]]:
        held: list[str] = []
        size = 0
        fresh = False
        for s in sentences:
            n = len(s.split())
            if fresh and size + n > budget:
                yield held
                back: list[str] = []
                room = overlap
                for prior in reversed(held):
                    room -= len(prior.split())
                    if room < 0:
                        break
                    back.insert(0, prior)
                held, size = back, sum(len(x.split()) for x in back)
                if size + n > budget:
                    held, size = [], 0
            held.append(s)
            size += n
            fresh = True
        if held and fresh:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        for batch in batches:
            ids, parts, texts, sizes = [], [], [], []
            for key, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sentences = [s for s in re.split(r"(?<=[.!?])\s+|\n+", t or "") if s.strip()]
                for i, held in enumerate(pack(sentences)):
                    ids.append(key)
                    parts.append(i)
                    texts.append(" ".join(held))
                    sizes.append(len(texts[-1].split()))
            yield pa.RecordBatch.from_pydict({"id": pa.array(ids, pa.int64()), "part": pa.array(parts, pa.int32()), "text": pa.array(texts, pa.string()), "n_tokens": pa.array(sizes, pa.int64())})

    return chunks.select(F.col("id").cast("long"), "text").mapInArrow(run, "id long, part int, text string, n_tokens long")


def numbered(chunks: DataFrame, group: str, order: str) -> DataFrame:
    """Chunks with ``local_id`` within their group and ``global_id``, from 0, by group then order.

    Rows are sorted by range, so a group of any size is dealt to many tasks; a row's number is its place in its
    partition and the sum of the partitions before, of which there is one row each.
    """
    ranged = chunks.repartitionByRange(group, order).sortWithinPartitions(group, order)
    placed = cut(ranged.withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    sizes = placed.groupBy("__part").agg(F.count("*").alias("__n"))
    before = sizes.select("__part", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    out = placed.join(before, "__part").withColumn("global_id", (F.col("__at") + F.col("__before")).cast("long"))
    first = out.groupBy(F.col(group).alias("__group")).agg(F.min("global_id").alias("__first"))
    out = out.join(first, F.col(group).eqNullSafe(F.col("__group")))
    return out.withColumn("local_id", F.col("global_id") - F.col("__first")).drop("__part", "__at", "__before", "__group", "__first")


def actions(chunks: DataFrame, manifest: DataFrame) -> DataFrame:
    """(id, action, reason): whether what was extracted from a chunk (id, signature) can be used again.

    The manifest has id, signature and status.
    """
    m = manifest.select("id", F.col("signature").alias("was"), "status")
    reason = F.when(F.col("was").isNull(), "missing").when(F.col("status") != "ok", "error").when(F.col("was") != F.col("signature"), "stale").otherwise("ok")
    out = chunks.select("id", "signature").join(m, "id", "left").withColumn("reason", reason)
    return out.select("id", F.when(F.col("reason") == "ok", "reuse").otherwise("regenerate").alias("action"), "reason")


def candidate_terms(chunks: DataFrame, n: int = 100, least: int = 2) -> DataFrame:
    """(term, n): the most frequent words of over three characters, ties by word."""
    words = chunks.select(F.explode(text.tokens(F.col("text"), 4)).alias("term")).where(~F.col("term").isin(*text.STOPWORDS))
    return words.groupBy("term").agg(F.count("*").alias("n")).where(F.col("n") >= least).orderBy(F.desc("n"), "term").limit(n)


def leading_categories(terms: DataFrame, concepts: DataFrame, n: int = 7) -> DataFrame:
    """(category, n): the categories that most of the terms' concepts (concept, label, lang, category) are in, ties by name.

    ``concepts`` is any table of a vocabulary, or what ``repository.Repository.select`` gives of a remote one.
    """
    said = concepts.select(F.lower(F.trim("label")).alias("term"), "concept", "category").distinct()
    return terms.select("term").distinct().join(said, "term").groupBy("category").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "category").limit(n)


def category_terms(concepts: DataFrame, categories: DataFrame, lang: str, least: int = 4, words: int = 4, most: int = 200) -> DataFrame:
    """(term, concept, category): labels of the categories (category, rank) in a language, of some length and at most so many words.

    Each category gives its first ``most`` labels in order, as the feature asks; a label that several give is the first one's.
    """
    own = concepts.where((F.col("lang") == lang) & (F.length("label") >= least)).select("category", "concept", F.lower(F.trim("label")).alias("term")).distinct()
    some = patterns.top_by(own, most, "category", F.col("term"), F.col("concept")).drop("rank").where(F.size(F.split("term", r"\s+")) <= words)
    first = F.min(F.struct("rank", "concept", "category"))
    return some.join(categories, "category").groupBy("term").agg(first.alias("m")).select("term", F.col("m.concept").alias("concept"), F.col("m.category").alias("category"))
