"""Average-linkage clustering of labels, as rounds of joins.

Labels are unit vectors of their words. The mean cosine of two clusters is the product of their mean vectors, so a
cluster is its sum and size, and no table of distances is held. The method is reducible: merging all pairs of clusters
that are each other's nearest gives what merging one pair at a time gives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..plans.durable import cut, forget

#: What counts as equal in sums of floating-point numbers.
SLACK = 1e-9


def _worded(entities: DataFrame) -> DataFrame:
    words = F.array_distinct(F.filter(F.split(text.normalize(F.col("label")), " "), lambda w: w != ""))
    return entities.select("id", words.alias("words")).where(F.size("words") > 0).withColumn("key", F.array_join(F.array_sort("words"), " "))


def close_labels(labels: DataFrame, similarity: float) -> DataFrame:
    """(a, b): pairs a < b of labels (node, words) whose cosine reaches the similarity.

    Only pairs that share one of their rarest words are compared: a label of n words needs at most n less its least
    overlap, and one more, of them, so no pair is lost and the most frequent words are joined by few.
    """
    said = labels.select("node", F.size("words").alias("n"), F.explode("words").alias("w"))
    ranked = said.join(said.groupBy("w").agg(F.count("*").alias("df")), "w").groupBy("node", "n").agg(F.array_sort(F.collect_list(F.struct("df", "w"))).alias("ws"))
    need = F.ceil(F.lit(similarity**2) * F.col("n") - SLACK).cast("int")
    rare = ranked.select("node", F.explode(F.slice("ws", F.lit(1), F.col("n") - need + 1)).alias("e")).select("node", F.col("e.w").alias("w"))
    met = rare.select(F.col("node").alias("a"), "w").join(rare.select(F.col("node").alias("b"), "w"), "w").where("a < b").select("a", "b").distinct()
    x, y = labels.select(F.col("node").alias("a"), F.col("words").alias("x")), labels.select(F.col("node").alias("b"), F.col("words").alias("y"))
    cosine = F.size(F.array_intersect("x", "y")) / F.sqrt(F.size("x") * F.size("y"))
    return met.join(x, "a").join(y, "b").where(cosine >= similarity - SLACK).select("a", "b")


def _product(x: Column, y: Column) -> Column:
    return F.aggregate(F.map_keys(x), F.lit(0.0), lambda s, w: s + F.element_at(x, w) * F.coalesce(F.try_element_at(y, w), F.lit(0.0)))


def average_linkage(entities: DataFrame, distance: float = 0.2) -> DataFrame:
    """(id, cluster) of entities (id, label): clusters merge, nearest first, while their mean cosine distance is at most so much.

    A cluster is named by its shortest id, the least of equals. Labels of the same words are one from the start, with
    their number. Entities without words are alone. Of equally near pairs the one of
    least hash merges first: an order that every pair sees alike, and by which many merge in one round.
    """
    similarity = 1.0 - distance
    worded = cut(_worded(entities))
    labels = worded.groupBy("key").agg(F.min("id").alias("node"), F.count("*").alias("n"), F.first("words").alias("words"))
    labels = cut(labels.select("node", "key", "n", "words"))
    weight = F.col("n") / F.sqrt(F.size("words"))
    sums = labels.select(F.col("node").alias("c"), "n", F.map_from_arrays("words", F.array_repeat(weight, F.size("words"))).alias("sum"))
    member, edges = labels.select("node", F.col("node").alias("c")), cut(close_labels(labels, similarity))
    while True:
        a, b = (sums.select(F.col("c").alias(s), F.col("n").alias(f"n_{s}"), F.col("sum").alias(f"sum_{s}")) for s in "ab")
        near = F.round(_product(F.col("sum_a"), F.col("sum_b")) / (F.col("n_a") * F.col("n_b")), 12)
        scored = cut(edges.join(a, "a").join(b, "b").select("a", "b", near.alias("near")).where(F.col("near") >= similarity - SLACK))
        if scored.isEmpty():
            break
        order = F.struct((-F.col("near")).alias("d"), F.xxhash64("a", "b").alias("h"), "a", "b")
        ends = scored.select(F.explode(F.array("a", "b")).alias("c"), order.alias("e")).groupBy("c").agg(F.min("e").alias("e"))
        merge = cut(ends.groupBy("e.a", "e.b").agg(F.count("*").alias("k")).where("k = 2").select(F.col("b").alias("gone"), F.col("a").alias("into")))
        named = lambda df, c: df.join(merge.withColumnRenamed("gone", c), c, "left").withColumn(c, F.coalesce("into", c)).drop("into")
        member, before = cut(named(member, "c")), [scored, edges]
        changed = sums.join(merge.select(F.explode(F.array("gone", "into")).alias("c"), F.col("into").alias("to")), "c")
        size = changed.groupBy("to").agg(F.sum("n").alias("n"))
        by_word = changed.select("to", F.explode("sum").alias("w", "x")).groupBy("to", "w").agg(F.sum("x").alias("x"))
        added = by_word.groupBy("to").agg(F.map_from_entries(F.collect_list(F.struct("w", "x"))).alias("sum")).join(size, "to").select(F.col("to").alias("c"), "n", "sum")
        kept = sums.join(changed.select("c"), "c", "left_anti")
        sums = cut(kept.select("c", "n", "sum").unionByName(added))
        edges = cut(named(named(scored.select("a", "b"), "a"), "b").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        for df in before:
            forget(df)
    placed = worded.select("id", "key").join(labels.select("key", "node"), "key").join(member, "node").select("id", "c")
    name = placed.groupBy("c").agg(F.min(F.struct(F.length("id").alias("k"), "id"))["id"].alias("cluster"))
    found = placed.join(name, "c").select("id", "cluster")
    return entities.select("id").join(found, "id", "left").select("id", F.coalesce("cluster", "id").alias("cluster"))
