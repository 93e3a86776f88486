"""Plan families: stored query templates, scored against parsed questions in one join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from . import patterns


def references(c: Column) -> Column:
    """Codes, addresses and words in capitals that a question refers to; plain numbers of up to five digits are none."""
    found = F.concat(*[F.regexp_extract_all(c, F.lit(p), F.lit(0)) for p in (r"[A-Za-z0-9._-]+@[A-Za-z0-9.-]+", r"\b[A-Za-z]+[0-9][A-Za-z0-9]*\b", r"\b[A-Z]{4,}\b", r"\b[0-9]{6,}\b")])
    return F.array_distinct(found)


def parsed(questions: DataFrame) -> DataFrame:
    """(id, text, words, refs): questions with their significant words and references."""
    return questions.select("id", "text", text.significant_tokens(F.col("text")).alias("words"), references(F.col("text")).alias("refs"))


def family_scores(questions: DataFrame, families: DataFrame) -> DataFrame:
    """(id, family, n_any, n_all, score): families (family, keyword, needed) by the keywords that a question has.

    Two for each keyword, and four more if all that are needed stand there; a family that lacks a needed one has no score.
    """
    words = parsed(questions).select("id", F.explode("words").alias("keyword"))
    total = families.groupBy("family").agg(F.sum(F.col("needed").cast("int")).alias("total"))
    hit = words.join(families, "keyword").groupBy("id", "family").agg(F.count("*").alias("n_any"), F.sum(F.col("needed").cast("int")).alias("n_all"))
    out = hit.join(total, "family").where("n_all = total")
    return out.select("id", "family", "n_any", "n_all", (2 * F.col("n_any") + F.when(F.col("n_all") > 0, 4).otherwise(0)).alias("score"))


def confidence(score: Column) -> Column:
    return F.round(F.least(F.lit(0.95), 0.45 + 0.05 * score), 4)


def selected(questions: DataFrame, families: DataFrame, fallback: str = "generic") -> DataFrame:
    """(id, family, score, confidence): the family of highest score, then least name, for each question."""
    best = patterns.first_by(family_scores(questions, families), "id", F.desc("score"), F.col("family"))
    out = questions.select("id").join(best.select("id", "family", "score"), "id", "left")
    s = F.coalesce("score", F.lit(0)).cast("long")
    return out.select("id", F.coalesce("family", F.lit(fallback)).alias("family"), s.alias("score"), confidence(s).alias("confidence"))


def strict_families(groups: DataFrame, families: DataFrame) -> DataFrame:
    """(id, family, n): families (family, group) all of whose anchor groups a question (id, group) has, with how many they are."""
    need = families.select("family", "group").distinct()
    total = need.groupBy("family").agg(F.count("*").alias("n"))
    hit = groups.select("id", "group").distinct().join(need, "group").groupBy("id", "family").agg(F.count("*").alias("has"))
    return hit.join(total, "family").where("has = n").select("id", "family", "n")


def cascade(questions: DataFrame, strict: DataFrame, scored: DataFrame, allowed: DataFrame, fallback: str = "generic") -> DataFrame:
    """(id, family, how): a strict family where the question's context allows it (allowed: id), the one of most groups,
    then least name; else the family of highest score (id, family, score); else the fallback."""
    first = patterns.first_by(strict.join(allowed.select("id").distinct(), "id", "left_semi"), "id", F.desc("n"), F.col("family")).select("id", F.col("family").alias("a"))
    second = patterns.first_by(scored.where("score > 0"), "id", F.desc("score"), F.col("family")).select("id", F.col("family").alias("b"))
    out = questions.select("id").join(first, "id", "left").join(second, "id", "left")
    return out.select("id", F.coalesce("a", "b", F.lit(fallback)).alias("family"), F.when(F.col("a").isNotNull(), "strict").when(F.col("b").isNotNull(), "scored").otherwise("fallback").alias("how"))


def resolved_seeds(seeds: DataFrame, nodes: DataFrame, aliases: DataFrame, surfaces: DataFrame) -> DataFrame:
    """(seed, node, how): declared seeds found as they are, by alias, or by equal compact surface; the first way that works."""
    exact = seeds.join(nodes, seeds.seed == nodes.node).select("seed", "node", F.lit(0).alias("o"), F.lit("exact").alias("how"))
    alias = seeds.join(aliases, "seed").select("seed", F.col("target").alias("node")).join(nodes, "node", "left_semi").select("seed", "node", F.lit(1).alias("o"), F.lit("alias").alias("how"))
    keyed = seeds.withColumn("key", text.compact_key(text.humanize(text.local_name(F.col("seed")))))
    named = surfaces.select(F.col("id").alias("node"), text.compact_key(F.col("surface")).alias("key"))
    surface = keyed.where("key <> ''").join(named, "key").select("seed", "node", F.lit(2).alias("o"), F.lit("surface").alias("how"))
    found = patterns.first_by(exact.unionByName(alias).unionByName(surface), "seed", F.col("o"), F.col("node")).drop("o")
    return seeds.join(found, "seed", "left").select("seed", "node", F.coalesce("how", F.lit("unresolved")).alias("how"))


def signature(steps: Column) -> Column:
    """A plan's fingerprint: equal for equal steps (an array of structs) whatever the question."""
    return text.short_hash(F.to_json(steps), 16)


def generic_candidates(questions: DataFrame, triples: DataFrame, most: int = 10) -> DataFrame:
    """(id, node, score, rank): subjects whose label or identifier has a question's words, two for each word.

    Words of any frequency count; the best by score, then name, are kept, pruned to that number before the shuffle.
    """
    words = parsed(questions).select("id", F.explode("words").alias("word"))
    named = triples.where(F.col("p").isin("label", "identifier")).select(F.col("s").alias("node"), F.explode(F.array_distinct(text.tokens(F.col("o"), 3))).alias("word")).distinct()
    hit = words.join(named, "word").groupBy("id", "node").agg((2 * F.count("*")).alias("score"))
    return patterns.top_by(hit, most, "id", F.desc("score"), F.col("node"))
