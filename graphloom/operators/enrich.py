"""Enrichment: proposals of links and surfaces for entities with gaps, ranked and guarded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from . import patterns, retrieve

#: Patterns of values worth a literal of their own, most telling first (fixed values).
STRUCTURED = (
    r"[A-Za-z0-9._-]+@[A-Za-z0-9-]+\.[A-Za-z0-9.-]+",
    r"\b[0-9]{4}/[0-9]{2}/[A-Z]{2}\b",
    r"\b[0-9]{1,3}(?:\.[0-9]{1,3}){3}\b",
    r"\b[0-9]+(?:[.,][0-9]+)? ?(?:mm|cm|kg|hz|v|bar)\b",
    r"\b[A-Z]{2,}[0-9]+\b",
)


def structured_values(c: Column) -> Column:
    """Distinct structured values, by pattern and place."""
    return F.array_distinct(F.concat(*[F.regexp_extract_all(c, F.lit(p), F.lit(0)) for p in STRUCTURED]))


def types_compatible(pairs: DataFrame, types: DataFrame, closed: DataFrame, disjoint: DataFrame) -> DataFrame:
    """(a, b, verdict) for pairs of entities: same, below, disjoint or unrelated types; the first that holds."""
    up = closed.select(F.col("child").alias("x"), F.col("ancestor").alias("y"))
    below = up.union(up.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct().withColumn("below", F.lit(True))
    refl = closed.union(closed.select("child", F.col("child").alias("ancestor"))).union(closed.select(F.col("ancestor").alias("child"), "ancestor")).distinct()
    apart = disjoint.union(disjoint.select(F.col("right").alias("left"), F.col("left").alias("right")))
    apart = apart.join(refl.select(F.col("child").alias("x"), F.col("ancestor").alias("left")), "left").join(refl.select(F.col("child").alias("y"), F.col("ancestor").alias("right")), "right")
    apart = apart.select("x", "y").distinct().withColumn("apart", F.lit(True))
    ta, tb = types.select(F.col("s").alias("a"), F.col("class").alias("x")), types.select(F.col("s").alias("b"), F.col("class").alias("y"))
    each = pairs.join(ta, "a").join(tb, "b").join(below, ["x", "y"], "left").join(apart, ["x", "y"], "left")
    agg = each.groupBy("a", "b").agg(F.max((F.col("x") == F.col("y")).cast("int")).alias("same"), F.max(F.coalesce("below", F.lit(False)).cast("int")).alias("below"), F.max(F.coalesce("apart", F.lit(False)).cast("int")).alias("apart"))
    return agg.select("a", "b", F.when(F.col("same") == 1, "same").when(F.col("apart") == 1, "disjoint").when(F.col("below") == 1, "below").otherwise("unrelated").alias("verdict"))


def selection_score(identifier: Column, in_degree: Column, n_surfaces: Column) -> Column:
    """How well an entity can stand for its block: shape of the identifier, links to it, surfaces, less for bare digits."""
    return F.round(2.6 * text.structured_identifier_score(identifier) + F.least(in_degree, F.lit(10)) * 0.1 + F.least(n_surfaces, F.lit(4)) * 0.25 - F.when(identifier.rlike("^[0-9]+$"), 0.5).otherwise(0.0), 4)


def surface_proposals(entities: DataFrame, triples: DataFrame) -> DataFrame:
    """(s, p, o): structured values in an entity's (id, text) text that it does not state as identifier or value yet."""
    found = entities.select(F.col("id").alias("s"), F.explode(structured_values(F.col("text"))).alias("o")).where(F.length("o") <= 400).distinct()
    stated = triples.where(F.col("p").isin("identifier", "value")).select("s", "o")
    return found.join(stated, ["s", "o"], "left_anti").select("s", F.lit("value").alias("p"), "o")


def link_proposals(entities: DataFrame, surfaces: DataFrame, predicate: str) -> DataFrame:
    """(s, p, o): entities (id, text) whose text has a surface (word, id; of one or more words) of another, which stands for just one."""
    unique = surfaces.groupBy(text.normalize(F.col("word")).alias("word")).agg(F.min("id").alias("o"), F.count_distinct("id").alias("n")).where("n = 1")
    words = retrieve.phrase_hits(entities, surfaces.select(F.col("word").alias("term")), 4).select(F.col("id").alias("s"), F.col("term").alias("word"))
    return words.join(unique, "word").where("s <> o").select("s", F.lit(predicate).alias("p"), "o").distinct()


def gaps(before: DataFrame, after: DataFrame) -> DataFrame:
    """(gap, n_before, n_after, delta) of two runs' gap rows (gap)."""
    b = before.groupBy("gap").agg(F.count("*").alias("n_before"))
    a = after.groupBy("gap").agg(F.count("*").alias("n_after"))
    out = b.join(a, "gap", "full_outer").select("gap", F.coalesce("n_before", F.lit(0)).alias("n_before"), F.coalesce("n_after", F.lit(0)).alias("n_after"))
    return out.withColumn("delta", F.col("n_after") - F.col("n_before"))


def best_fragment(texts: DataFrame, least: float = 0.0) -> DataFrame:
    """(id, fragment, overlap): of each text (id, text, wanted words) the fragment that holds most of the words, then the shortest."""
    f = texts.select("id", "wanted", F.explode(text.fragments(F.col("text"))).alias("fragment"))
    scored = f.select("id", "fragment", F.round(text.token_overlap(F.col("wanted"), text.tokens(F.col("fragment"), 3)), 6).alias("overlap")).where(F.col("overlap") > least)
    return patterns.first_by(scored, "id", F.desc("overlap"), F.length("fragment"), F.col("fragment"))
