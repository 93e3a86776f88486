"""Schema-level operators: closures, inference and checks of domains, ranges, inverses and disjointness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.durable import cut
from . import patterns


def closure(edges: DataFrame) -> DataFrame:
    """(child, ancestor): transitive closure of (child, parent), by doubling paths until nothing is new.

    Chains of n levels take log n rounds, whatever n; cycles end it like any repeated pair.
    """
    found = edges.select("child", F.col("parent").alias("ancestor")).distinct()
    size = found.count()
    while size:
        step = found.alias("a").join(found.alias("b"), F.col("a.ancestor") == F.col("b.child")).select("a.child", "b.ancestor")
        found = cut(found.union(step).distinct())
        if (now := found.count()) == size:
            break
        size = now
    return found


def reflexive(closed: DataFrame) -> DataFrame:
    """The closure with every class as its own ancestor."""
    own = closed.select("child").union(closed.select("ancestor")).distinct().toDF("child")
    return closed.union(own.select("child", F.col("child").alias("ancestor"))).distinct()


def types_of(triples: DataFrame) -> DataFrame:
    return triples.where("p = 'type'").select("s", F.col("o").alias("class")).distinct()


def redundant_types(types: DataFrame, closed: DataFrame) -> DataFrame:
    """(s, class): types that another type of the subject has among its ancestors."""
    implied = types.join(closed, types["class"] == closed["child"]).select("s", F.col("ancestor").alias("class")).distinct()
    return types.join(implied, ["s", "class"], "left_semi")


def infer_types(triples: DataFrame, domains: DataFrame) -> DataFrame:
    """(s, class) of untyped subjects whose predicates' domains name exactly one class."""
    used = triples.where("p <> 'type'").select("s", "p").distinct()
    typed = triples.where("p = 'type'").select("s")
    found = used.join(typed, "s", "left_anti").join(domains, used.p == domains.property)
    return found.groupBy("s").agg(F.min("class").alias("class"), F.max("class").alias("__max")).where(F.col("class") == F.col("__max")).drop("__max")


def violations(triples: DataFrame, types: DataFrame, closed: DataFrame, allowed: DataFrame, end: str) -> DataFrame:
    """(property, n): links whose end (s or o) has types, none of them the allowed class or below it."""
    up = reflexive(closed)
    classes = types.join(up, types["class"] == up["child"]).select(F.col("s").alias("node"), F.col("ancestor").alias("class")).distinct()
    link = patterns.links(triples).join(allowed, F.col("p") == F.col("property")).select("property", F.col(end).alias("node"), F.col("class").alias("want"), "s", "o")
    judged = link.join(types.select(F.col("s").alias("node")).distinct(), "node", "left_semi")
    good = judged.join(classes, (judged.node == classes.node) & (judged.want == classes["class"]), "left_anti")
    return good.groupBy("property").agg(F.count("*").alias("n"))


def inverse_counts(triples: DataFrame, inverses: DataFrame) -> DataFrame:
    """(property, inverse, n, n_inverse): how often either direction is stated."""
    n = triples.groupBy("p").agg(F.count("*").alias("n"))
    out = inverses.join(n.withColumnRenamed("p", "property"), "property", "left")
    out = out.join(n.select(F.col("p").alias("inverse"), F.col("n").alias("n_inverse")), "inverse", "left")
    return out.select("property", "inverse", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("n_inverse", F.lit(0)).alias("n_inverse"))


def materialize_inverses(triples: DataFrame, inverses: DataFrame) -> DataFrame:
    """Links that the inverses imply in either direction and that are not stated yet."""
    both = inverses.select("property", "inverse").union(inverses.select(F.col("inverse").alias("property"), F.col("property").alias("inverse")))
    implied = patterns.links(triples).join(both, F.col("p") == F.col("property"))
    implied = implied.select(F.col("o").alias("s"), F.col("inverse").alias("p"), F.col("s").alias("o")).distinct()
    return patterns.without(implied, triples)


def endpoint_pairs(triples: DataFrame, types: DataFrame) -> DataFrame:
    """(p, source, target, n): typed links by predicate and the types of their ends."""
    a = types.select(F.col("s"), F.col("class").alias("source"))
    b = types.select(F.col("s").alias("o"), F.col("class").alias("target"))
    return patterns.links(triples).join(a, "s").join(b, "o").groupBy("p", "source", "target").agg(F.count("*").alias("n"))


def axiom_candidates(pairs: DataFrame, least: int = 3, ratio: float = 0.8) -> DataFrame:
    """(p, side, class, n): classes that so large a share of a predicate's sources or targets has."""
    long = pairs.select("p", F.explode(F.array(F.struct(F.lit("domain").alias("side"), F.col("source").alias("class")), F.struct(F.lit("range").alias("side"), F.col("target").alias("class")))).alias("e"), "n")
    by = long.groupBy("p", "e.side", "e.class").agg(F.sum("n").alias("n"))
    total = by.groupBy("p", "side").agg(F.sum("n").alias("total"))
    return by.join(total, ["p", "side"]).where((F.col("n") >= least) & (F.col("n") >= ratio * F.col("total"))).select("p", "side", "class", "n")


def disjoint_conflicts(types: DataFrame, closed: DataFrame, disjoint: DataFrame) -> DataFrame:
    """(s, left, right): subjects under two classes declared disjoint."""
    up = reflexive(closed)
    classes = types.join(up, types["class"] == up["child"]).select("s", "ancestor").distinct()
    a, b = classes.withColumnRenamed("ancestor", "left"), classes.withColumnRenamed("ancestor", "right")
    return a.join(disjoint, "left").join(b, ["s", "right"]).select("s", "left", "right")


def condensed_schema(domains: DataFrame, ranges: DataFrame) -> DataFrame:
    """Lines 'domain -> property -> range', one domain and range a property, Literal without range."""
    d = domains.groupBy("property").agg(F.min("class").alias("d"))
    r = ranges.groupBy("property").agg(F.min("class").alias("r"))
    return d.join(r, "property", "left").select(F.concat_ws(" -> ", "d", "property", F.coalesce("r", F.lit("Literal"))).alias("line")).distinct()
