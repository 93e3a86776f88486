"""Merging fragments into one graph: acceptance of fragments, duplicates, declared anchors, manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from . import patterns

#: Faults that reject a fragment; others warn.
BLOCKING = ("missing_type", "class_as_entity", "unknown_predicate", "anonymous", "dangling_value")


def fragment_faults(fragments: DataFrame, classes: DataFrame, properties: DataFrame) -> DataFrame:
    """(fragment, category, n): faults of triples with a fragment column, in one pass and two small joins."""
    f = fragments.join(properties.select(F.col("property").alias("p"), F.lit(True).alias("known")), "p", "left")
    f = f.join(classes.select(F.col("class").alias("s"), F.lit(True).alias("is_class")), "s", "left")
    by_subject = f.groupBy("fragment", "s").agg(
        F.max((F.col("p") == "type").cast("int")).alias("typed"), F.max(F.col("p").isin("label", "identifier", "extract").cast("int")).alias("traced"),
        F.max(F.coalesce("is_class", F.lit(False)).cast("int")).alias("is_class"), F.sum(F.col("known").isNull().cast("int")).alias("unknown"),
        F.sum(((F.col("kind") == "iri") & (F.col("p") != "type")).cast("int")).alias("links"), F.sum(((F.col("p") == "value") & (F.col("kind") == "iri")).cast("int")).alias("values"),
    )
    found = {
        "missing_type": F.col("typed") == 0, "missing_trace": F.col("traced") == 0, "class_as_entity": F.col("is_class"), "unknown_predicate": F.col("unknown"),
        "anonymous": F.col("s").startswith("_:"), "dangling_value": F.col("values"), "no_links": F.col("links") == 0, "long_name": F.length("s") > 100,
    }
    faults = F.array(*[F.struct(F.lit(k).alias("category"), c.cast("long").alias("n")) for k, c in found.items()])
    long = by_subject.select("fragment", F.explode(faults).alias("f"))
    return long.groupBy("fragment", "f.category").agg(F.sum("f.n").alias("n"))


def verdicts(faults: DataFrame) -> DataFrame:
    """(fragment, verdict, n_faults): rejected for a blocking fault, warned for another, else ok."""
    hard = F.sum(F.when(F.col("category").isin(*BLOCKING), F.col("n")).otherwise(0))
    agg = faults.groupBy("fragment").agg(hard.alias("hard"), F.sum("n").alias("n_faults"))
    return agg.select("fragment", F.when(F.col("hard") > 0, "rejected").when(F.col("n_faults") > 0, "warned").otherwise("ok").alias("verdict"), "n_faults")


def merge_fragments(fragments: DataFrame, judged: DataFrame) -> DataFrame:
    """The set union of the fragments that are not rejected."""
    good = judged.where("verdict <> 'rejected'").select("fragment")
    return fragments.join(good, "fragment", "left_semi").drop("fragment").distinct()


def duplicate_groups(entities: DataFrame) -> DataFrame:
    """(fragment, class, ident, n): entities (id, fragment, class, surface) of one fragment with one normalised identifier."""
    keyed = entities.withColumn("ident", text.identifier(F.col("surface"))).where("ident <> ''")
    return keyed.groupBy("fragment", "class", "ident").agg(F.count_distinct("id").alias("n")).where("n > 1")


def duplicate_mapping(entities: DataFrame, degrees: DataFrame) -> DataFrame:
    """(source, target): in each duplicate group all go to the one of highest degree, then shortest and least name."""
    keyed = entities.withColumn("ident", text.identifier(F.col("surface"))).where("ident <> ''")
    d = keyed.join(degrees, "id", "left").withColumn("degree", F.coalesce("degree", F.lit(0)))
    keep = d.groupBy("fragment", "class", "ident").agg(F.min(F.struct((-F.col("degree")).alias("d"), F.length("id").alias("l"), "id")).alias("m"))
    out = d.join(keep, ["fragment", "class", "ident"]).select(F.col("id").alias("source"), F.col("m.id").alias("target")).where("source <> target")
    return out.groupBy("source").agg(F.min("target").alias("target"))


def anchor_problems(anchors: DataFrame, graph_nodes: DataFrame | None = None) -> DataFrame:
    """(canonical, absorbed, problem) of declared anchors: self, absorbed twice, canonical absorbed elsewhere, absent."""
    times = anchors.groupBy("absorbed").agg(F.count_distinct("canonical").alias("times"))
    a = anchors.join(times, "absorbed").join(anchors.select(F.col("absorbed").alias("canonical"), F.lit(True).alias("chained")).distinct(), "canonical", "left")
    if graph_nodes is not None:
        a = a.join(graph_nodes.select(F.col("node").alias("canonical"), F.lit(True).alias("there")), "canonical", "left")
    else:
        a = a.withColumn("there", F.lit(True))
    problem = (
        F.when(F.col("canonical") == F.col("absorbed"), "self")
        .when(F.col("times") > 1, "absorbed_twice")
        .when(F.col("chained"), "canonical_is_absorbed")
        .when(F.col("there").isNull(), "absent_canonical")
    )
    return a.select("canonical", "absorbed", problem.alias("problem")).where("problem IS NOT NULL")


def apply_anchors(triples: DataFrame, anchors: DataFrame) -> DataFrame:
    """The graph with what sound anchors absorb rewritten to their canonical entity."""
    bad = anchor_problems(anchors, patterns.nodes(triples)).select("canonical", "absorbed")
    mapping = anchors.join(bad, ["canonical", "absorbed"], "left_anti").select(F.col("absorbed").alias("source"), F.col("canonical").alias("target"))
    return patterns.rewrite(triples, mapping)


def divergent_subjects(triples: DataFrame) -> DataFrame:
    """(s, n_labels, n_identifiers): subjects whose labels or identifiers differ after normalisation."""
    n = lambda p: F.count_distinct(F.when(F.col("p") == p, text.normalize(F.col("o"))))
    return triples.where(F.col("p").isin("label", "identifier")).groupBy("s").agg(n("label").alias("n_labels"), n("identifier").alias("n_identifiers")).where("n_labels > 1 OR n_identifiers > 1")
