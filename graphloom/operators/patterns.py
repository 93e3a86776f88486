"""Pattern matching and traversal over triples (s, p, o, kind, lang).

A triple set is a set: operators that add or rewrite end in ``distinct``. Every limit has a total order,
so results don't depend on partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def match(triples: DataFrame, s: str | None = None, p: str | None = None, o: str | None = None, lang: str | None = None) -> DataFrame:
    """Triples with the given constants; a language must match along with the value."""
    for name, value in (("s", s), ("p", p), ("o", o), ("lang", lang)):
        if value is not None:
            triples = triples.where(F.col(name) == value)
    return triples


def links(triples: DataFrame) -> DataFrame:
    """Triples between entities, other than types."""
    return triples.where((F.col("kind") == "iri") & (F.col("p") != "type"))


def nodes(triples: DataFrame) -> DataFrame:
    """Entities in subject or object place, once each."""
    objects = triples.where((F.col("kind") == "iri") & (F.col("p") != "type")).select(F.col("o").alias("node"))
    return triples.select(F.col("s").alias("node")).union(objects).distinct()


def star(triples: DataFrame, **columns: str) -> DataFrame:
    """One row a subject; each named column has the least object of its predicate (null without one)."""
    wanted = triples.where(F.col("p").isin(*columns.values()))
    return wanted.groupBy("s").agg(*[F.min(F.when(F.col("p") == p, F.col("o"))).alias(c) for c, p in columns.items()])


def describe(triples: DataFrame, seeds: DataFrame, predicates: list[str]) -> DataFrame:
    """(s, p, o) of the seeds' (column node) triples with the given predicates, once each.

    An inner join, as a semi-join would be planned anew, with its seeds, in each branch of the view.
    """
    wanted = triples.where(F.col("p").isin(*predicates))
    return wanted.join(seeds, wanted.s == seeds.node).select("s", "p", "o").distinct()


def traverse(triples: DataFrame, seeds: DataFrame, predicate: str, incoming: bool = False) -> DataFrame:
    """Entities one step from the seeds (column node) along a predicate, once each."""
    step = triples.where((F.col("p") == predicate) & (F.col("kind") == "iri"))
    at, to = ("o", "s") if incoming else ("s", "o")
    return step.join(seeds.select(F.col("node").alias("__seed")), step[at] == F.col("__seed")).select(F.col(to).alias("node")).distinct()


def degrees(triples: DataFrame) -> DataFrame:
    """(node, in_degree, out_degree) over links; partial sums are combined before the shuffle."""
    both = links(triples).select(F.explode(F.array(F.struct(F.col("s").alias("node"), F.lit(0).alias("i"), F.lit(1).alias("x")), F.struct(F.col("o").alias("node"), F.lit(1).alias("i"), F.lit(0).alias("x")))).alias("e"))
    return both.groupBy("e.node").agg(F.sum("e.i").alias("in_degree"), F.sum("e.x").alias("out_degree"))


def union(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()


def without(triples: DataFrame, gone: DataFrame, keys: tuple[str, ...] = ("s", "p", "o")) -> DataFrame:
    """Triples that are not among ``gone``."""
    return triples.join(gone.select(*keys).distinct(), list(keys), "left_anti")


def rewrite(triples: DataFrame, mapping: DataFrame) -> DataFrame:
    """Triples with mapped entities (source, target) replaced in subject and object place.

    Types stay; links that become loops go; what becomes equal is one triple. The mapping has a row a source.
    """
    m1 = mapping.select(F.col("source").alias("s"), F.col("target").alias("s2"))
    m2 = mapping.select(F.col("source").alias("o"), F.col("target").alias("o2"))
    link = (F.col("kind") == "iri") & (F.col("p") != "type")
    out = triples.join(m1, "s", "left").join(m2, "o", "left")
    out = out.select(F.coalesce("s2", "s").alias("s"), "p", F.when(link, F.coalesce("o2", "o")).otherwise(F.col("o")).alias("o"), "kind", "lang")
    return out.where(~(link & (F.col("s") == F.col("o")))).distinct()


def first_by(df: DataFrame, group: str | list[str], *order: Column) -> DataFrame:
    """The first row of each group in a total order."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def top_by(df: DataFrame, n: int, group: str | list[str], *order: Column) -> DataFrame:
    """The first n rows of each group in a total order, with their rank; Spark prunes to n before the shuffle."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n).withColumn("rank", F.col("rank").cast("long"))
