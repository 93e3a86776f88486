"""The lexicon: what entities are called in each language, with aliases of technical terms, its index and its names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text


def entries(triples: DataFrame) -> DataFrame:
    """(uri, class, language, surface, kind): labels and identifiers of entities; labels without a language have none."""
    named = triples.where(F.col("p").isin("label", "identifier") & (F.col("kind") == "literal"))
    kind = triples.where("p = 'type'").groupBy("s").agg(F.min("o").alias("class"))
    out = named.join(kind, "s", "left")
    return out.select(F.col("s").alias("uri"), "class", F.when(F.col("p") == "label", F.col("lang")).alias("language"), F.col("o").alias("surface"), F.col("p").alias("kind")).distinct()


def enriched(entry: DataFrame, terms: DataFrame) -> DataFrame:
    """Entries with an alias more for each (alias) of the terms (term, alias) whose name is one of the entity's identifiers."""
    key = entry.where("kind = 'identifier'").select("uri", "class", text.compact_key(F.col("surface")).alias("key")).where("key <> ''").distinct()
    alias = terms.select(text.compact_key(F.col("term")).alias("key"), "alias").distinct()
    more = key.join(alias, "key").select("uri", "class", F.lit(None).cast("string").alias("language"), F.col("alias").alias("surface"), F.lit("alias").alias("kind"))
    return entry.unionByName(more).distinct()


def index(entry: DataFrame, least: int = 3) -> DataFrame:
    """(surface, n_uris, uris): entities by normalised surface; of a surface at most the least ten are named, n_uris counts all."""
    keyed = entry.select(text.normalize(F.col("surface")).alias("surface"), "uri").where(F.length("surface") >= least).distinct()
    counted = keyed.groupBy("surface").agg(F.count("*").alias("n_uris"))
    from . import patterns

    first = patterns.top_by(keyed, 10, "surface", F.col("uri")).groupBy("surface").agg(F.array_sort(F.collect_list("uri")).alias("uris"))
    return counted.join(first, "surface")


def uri_map(triples: DataFrame) -> DataFrame:
    """(local, uri): the least entity of each local name."""
    s = triples.select(F.col("s").alias("uri")).distinct()
    return s.groupBy(text.local_name(F.col("uri")).alias("local")).agg(F.min("uri").alias("uri"))


def payload(entry: DataFrame) -> DataFrame:
    """(entry_count, surface_count, languages): what describes a lexicon that is written."""
    return entry.agg(F.count_distinct("uri").alias("entry_count"), F.count_distinct(text.normalize(F.col("surface"))).alias("surface_count"), F.array_sort(F.collect_set("language")).alias("languages"))
