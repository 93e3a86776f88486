"""Checks of a graph: each gives subjects at fault, and a summary counts them by category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from . import ontology, patterns


def subjects(triples: DataFrame) -> DataFrame:
    return triples.select("s").distinct()


def missing(triples: DataFrame, predicates: list[str]) -> DataFrame:
    """Subjects without any triple of the predicates."""
    has = triples.where(F.col("p").isin(*predicates)).select("s")
    return subjects(triples).join(has, "s", "left_anti")


def weakly_linked(triples: DataFrame, least: int = 1) -> DataFrame:
    """(s, degree): subjects with at most so many links in and out."""
    d = patterns.degrees(triples).select(F.col("node").alias("s"), (F.col("in_degree") + F.col("out_degree")).alias("degree"))
    return subjects(triples).join(d, "s", "left").select("s", F.coalesce("degree", F.lit(0)).alias("degree")).where(F.col("degree") <= least)


def unknown_predicates(triples: DataFrame, allowed: DataFrame) -> DataFrame:
    """(p, n) of predicates that the vocabulary (column property) lacks."""
    return triples.join(allowed, F.col("p") == F.col("property"), "left_anti").groupBy("p").agg(F.count("*").alias("n"))


def dangling(triples: DataFrame) -> DataFrame:
    """Linked entities that are no subject of any triple."""
    to = patterns.links(triples).select(F.col("o").alias("s")).distinct()
    return to.join(triples.select("s"), "s", "left_anti")


def long_names(triples: DataFrame, limit: int = 100) -> DataFrame:
    return subjects(triples).where(F.length("s") > limit)


def incomparable_types(types: DataFrame, closed: DataFrame) -> DataFrame:
    """(s, left, right): pairs of a subject's types of which neither is above the other."""
    a, b = types.withColumnRenamed("class", "left"), types.withColumnRenamed("class", "right")
    pairs = a.join(b, "s").where("left < right")
    over = closed.select(F.col("child").alias("x"), F.col("ancestor").alias("y"))
    both = over.union(over.select(F.col("y").alias("x"), F.col("x").alias("y")))
    return pairs.join(both, (F.col("left") == F.col("x")) & (F.col("right") == F.col("y")), "left_anti")


#: Categories that fail a graph (fixed values).
HARD = ("non_canonical_class", "non_canonical_property", "missing_type", "missing_traceability", "blank_node_entity", "file_uri_entity", "redundant_type_assertion", "individual_used_as_class")


def semantic(triples: DataFrame, classes: DataFrame, properties: DataFrame, closed: DataFrame, traced: str = "extract", value: str = "value", longest: int = 100) -> DataFrame:
    """(category, n, samples): the twelve semantic categories of a graph (s, p, o, kind, lang), samples the least 15 names.

    ``classes`` (class) and ``properties`` (property) are the vocabulary, ``closed`` its subclass closure. Assertions
    of unknown classes and properties count each; other categories count subjects. Types are judged by the class,
    subjects in one pass by subject and one by object.
    """
    typed = triples.where("p = 'type' AND kind = 'iri'").select("s", F.col("o").alias("class")).distinct()
    surfaces = ("label", "identifier", traced)
    flag = lambda c: F.max(F.coalesce(c, F.lit(False)).cast("int"))
    link = (F.col("kind") == "iri") & (F.col("p") != "type")
    own = triples.groupBy("s").agg(flag((F.col("p") == "type") & (F.col("kind") == "iri")).alias("typed"), flag(F.col("p") == traced).alias("traced"), flag(F.col("p").isin(*surfaces)).alias("named"), F.count_if(link).alias("n_out"), F.count_if((F.col("p") == value) & (F.col("kind") == "iri")).alias("n_value"))
    into = triples.where(link).groupBy(F.col("o").alias("s")).agg(F.count("*").alias("n_in"))
    redundant = ontology.redundant_types(typed, closed).select("s").distinct().withColumn("redundant", F.lit(True))
    nodes = own.join(into, "s", "full_outer").join(redundant, "s", "left")
    is_subject, is_typed = F.col("typed").isNotNull(), F.coalesce("typed", F.lit(0)) == 1
    blank, n_links = F.col("s").startswith("_:"), F.coalesce("n_out", F.lit(0)) + F.coalesce("n_in", F.lit(0))
    by_subject = {
        "missing_type": is_subject & ~blank & ~is_typed,
        "missing_traceability": is_typed & ~blank & (F.col("traced") == 0),
        "weak_linkage": is_typed & ~blank & (n_links == 0),
        "blank_node_entity": is_subject & blank & (is_typed | (F.col("named") == 1)),
        "file_uri_entity": F.col("s").startswith("file:///"),
        "redundant_type_assertion": F.col("redundant").isNotNull(),
        "long_local_name": is_subject & (F.length(text.local_name(F.col("s"))) > longest),
    }
    flags = nodes.select("s", F.explode(F.array(*[F.struct(F.lit(k).alias("category"), F.coalesce(c, F.lit(False)).alias("hit")) for k, c in by_subject.items()])).alias("f")).where("f.hit")
    faults = flags.select("f.category", "s", F.lit(1).cast("long").alias("n"))
    valued = nodes.where("n_value > 0").select(F.lit("value_used_as_object_property").alias("category"), "s", F.col("n_value").alias("n"))
    unknown_class = typed.join(classes.select("class").distinct(), "class", "left_anti").groupBy("class").agg(F.count("*").alias("n"))
    local = text.local_name(F.col("class"))
    individuals = own.where("typed = 1 OR named = 1").select(F.col("s").alias("class"), F.lit(True).alias("individual"))
    as_class = unknown_class.join(individuals, "class", "left").where(F.col("individual") | local.rlike("_[0-9a-f]{10}$|[A-Z][a-z]+[0-9]+|_[0-9]+$|[0-9]{4,}"))
    unknown_p = triples.groupBy("p").agg(F.count("*").alias("n")).join(properties.select(F.col("property").alias("p")).distinct(), "p", "left_anti")
    lonely = nodes.agg(F.count_if(is_typed).alias("n"), F.sum(F.coalesce("n_out", F.lit(0))).alias("links")).where("n > 1 AND links = 0")
    every = [
        faults, valued,
        unknown_class.select(F.lit("non_canonical_class").alias("category"), F.col("class").alias("s"), "n"),
        as_class.select(F.lit("individual_used_as_class").alias("category"), F.col("class").alias("s"), "n"),
        unknown_p.select(F.lit("non_canonical_property").alias("category"), F.col("p").alias("s"), "n"),
        lonely.select(F.lit("no_useful_links").alias("category"), F.lit("").alias("s"), "n"),
    ]
    whole = every[0]
    for more in every[1:]:
        whole = whole.unionByName(more)
    total = whole.groupBy("category").agg(F.sum("n").alias("n"))
    first = patterns.top_by(whole.select("category", text.local_name(F.col("s")).alias("name")).distinct(), 15, "category", F.col("name"))
    named = first.groupBy("category").agg(F.array_sort(F.collect_list("name")).alias("samples"))
    return total.join(named, "category").select("category", "n", "samples")


def passed(semantic_report: DataFrame) -> DataFrame:
    """(ok, n_hard, n_soft): whether a graph has no fault of a category that fails it."""
    hard = F.col("category").isin(*HARD)
    return semantic_report.agg(F.coalesce(F.sum(F.when(hard, F.col("n"))), F.lit(0)).alias("n_hard"), F.coalesce(F.sum(F.when(~hard, F.col("n"))), F.lit(0)).alias("n_soft")).select((F.col("n_hard") == 0).alias("ok"), "n_hard", "n_soft")


def predicate_usage(triples: DataFrame, declared: DataFrame, most: int = 3) -> DataFrame:
    """(property, n, status, samples): orphan predicates are used but not declared (property), dead ones the other way; samples the least subjects."""
    used = triples.where("p <> 'type'").groupBy(F.col("p").alias("property")).agg(F.count("*").alias("n"))
    known = declared.select("property").distinct().withColumn("known", F.lit(True))
    out = used.join(known, "property", "full_outer")
    sample = patterns.top_by(triples.where("p <> 'type'").select(F.col("p").alias("property"), "s").distinct(), most, "property", F.col("s")).groupBy("property").agg(F.array_sort(F.collect_list("s")).alias("samples"))
    status = F.when(F.col("known").isNull(), "orphan").when(F.col("n").isNull(), "dead").otherwise("used")
    return out.join(sample, "property", "left").select("property", F.coalesce("n", F.lit(0)).alias("n"), status.alias("status"), F.coalesce("samples", F.array().cast("array<string>")).alias("samples"))


def report(triples: DataFrame, allowed: DataFrame, closed: DataFrame) -> DataFrame:
    """(category, n, sample): how many subjects each check finds, and the least of them.

    One pass by subject and one by object carry all flags; both are combined before their shuffle.
    """
    known = allowed.select(F.col("property").alias("p"), F.lit(True).alias("known"))
    flag = lambda c: F.max(c.cast("int"))
    own = triples.join(known, "p", "left").groupBy("s").agg(
        flag(F.col("p") == "type").alias("typed"), flag(F.col("p").isin("label", "identifier", "extract")).alias("traced"),
        flag(F.col("known").isNull()).alias("unknown"), F.sum(((F.col("kind") == "iri") & (F.col("p") != "type")).cast("long")).alias("n_out"),
    )
    into = patterns.links(triples).groupBy(F.col("o").alias("s")).agg(F.count("*").alias("n_in"))
    redundant = ontology.redundant_types(ontology.types_of(triples), closed).select("s", F.lit(True).alias("redundant")).distinct()
    whole = own.join(into, "s", "full_outer").join(redundant, "s", "left")
    subject = F.col("typed").isNotNull()
    found = {
        "missing_type": subject & (F.col("typed") == 0),
        "missing_trace": subject & (F.col("traced") == 0),
        "weak_linkage": subject & (F.coalesce("n_out", F.lit(0)) + F.coalesce("n_in", F.lit(0)) <= 1),
        "unknown_predicate": subject & (F.col("unknown") == 1),
        "dangling": ~subject,
        "redundant_type": F.col("redundant").isNotNull(),
        "long_name": subject & (F.length("s") > 100),
    }
    each = whole.select("s", F.explode(F.array(*[F.struct(F.lit(k).alias("category"), c.alias("hit")) for k, c in found.items()])).alias("f"))
    return each.groupBy("f.category").agg(F.count_if("f.hit").alias("n"), F.min(F.when(F.col("f.hit"), F.col("s"))).alias("sample"))
