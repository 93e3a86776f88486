"""Entity resolution: blocking, choice of canonical entities, mappings and guarded additions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import surfaces, text
from ..plans.durable import cut
from . import patterns


def collisions(entities: DataFrame, *block: str) -> DataFrame:
    """(block..., n, least): blocks that hold two or more different ids."""
    return entities.groupBy(*block).agg(F.count_distinct("id").alias("n"), F.min("id").alias("least")).where("n > 1")


def blocks(entities: DataFrame, surface: Column, least: int = 5) -> DataFrame:
    """(id, key): entities by the compact key of a surface, if it has enough characters."""
    return entities.select("id", text.compact_key(surface).alias("key")).where(F.length("key") >= least)


def pivot_pairs(blocked: DataFrame, degrees: DataFrame) -> DataFrame:
    """(key, pivot, id): each block's other members with its pivot, the one of highest degree, then least id.

    Pairs grow with the block, not with its square. The pivot is an aggregate, so a hot block is combined early.
    """
    d = blocked.join(degrees, "id", "left").select("key", "id", F.coalesce("degree", F.lit(0)).alias("degree"))
    pivot = d.groupBy("key").agg(F.min(F.struct((-F.col("degree")).alias("d"), "id")).alias("m")).select("key", F.col("m.id").alias("pivot"))
    return d.join(pivot, "key").where(F.col("id") != F.col("pivot")).select("key", "pivot", "id")


def canonical(candidates: DataFrame) -> DataFrame:
    """(source, target, score): for each source the target of highest score, then least name."""
    best = candidates.groupBy("source").agg(F.min(F.struct((-F.col("score")).alias("n"), F.col("target").alias("t"))).alias("m"))
    return best.select("source", F.col("m.t").alias("target"), (-F.col("m.n")).alias("score"))


def merged(*candidate_sets: DataFrame) -> DataFrame:
    """Candidates (source, target, issue, score, questions) of several sets, by key: best score, questions summed."""
    whole = candidate_sets[0]
    for c in candidate_sets[1:]:
        whole = whole.unionByName(c)
    return whole.groupBy("source", "target", "issue").agg(F.max("score").alias("score"), F.sum("questions").alias("questions"))


def resolve_chains(mapping: DataFrame) -> DataFrame:
    """(source, target): chains followed to their end by pointer jumping, so n hops take log n joins, whatever n.

    A source on a cycle, or leading to one, goes to the least entity of the cycle; that entity itself stays.
    """
    first = cut(mapping.groupBy("source").agg(F.min("target").alias("target")).where("source <> target"))
    m = first.withColumn("least", F.col("target")).withColumn("open", F.lit(True))
    for _ in range(first.count().bit_length() + 1):  # then every chain has ended, and what goes on is on a cycle
        ahead = m.select(F.col("source").alias("t"), F.col("target").alias("t2"), F.col("least").alias("l2"))
        step = m.join(ahead, m.target == ahead.t, "left")
        m = cut(step.select("source", F.coalesce("t2", "target").alias("target"), F.least("least", F.coalesce("l2", "least")).alias("least"), F.col("t2").isNotNull().alias("open")))
        if not m.where("open").head(1):
            return m.select("source", "target")
    # a target that is a source itself is on a cycle, all of which its jumps have passed
    on = m.select(F.col("source").alias("t"), F.col("least").alias("of"))
    return m.join(on, m.target == on.t, "left").select("source", F.coalesce("of", "target").alias("target")).where("source <> target")


def guarded(proposals: DataFrame, triples: DataFrame, properties: DataFrame) -> DataFrame:
    """Proposed links (s, p, o) with ``verdict``: the first guard that refuses them, present, or added."""
    typed = triples.where("p = 'type'").select(F.col("s").alias("node")).distinct()
    a = proposals.join(typed.select(F.col("node").alias("s"), F.lit(True).alias("s_typed")), "s", "left")
    a = a.join(typed.select(F.col("node").alias("o"), F.lit(True).alias("o_typed")), "o", "left")
    a = a.join(properties.select(F.col("property").alias("p"), F.lit(True).alias("known")), "p", "left")
    a = a.join(triples.select("s", "p", "o", F.lit(True).alias("there")).distinct(), ["s", "p", "o"], "left")
    verdict = (
        F.when(F.col("s") == F.col("o"), "self_loop")
        .when(F.col("s_typed").isNull() | F.col("o_typed").isNull(), "untyped")
        .when(F.col("known").isNull(), "unknown_property")
        .when(F.col("there"), "present")
        .otherwise("added")
    )
    return a.select("s", "p", "o", verdict.alias("verdict"))


def limited_name(name: Column, key: Column, most: int = 80) -> Column:
    """A name of at most so many characters: a longer one is cut and gets a hash of its key behind it."""
    mark = text.short_hash(key)
    cut_name = F.regexp_replace(F.substring(name, 1, most - 11), "_+$", "")
    return F.when(F.length(name) <= most, name).otherwise(F.concat_ws("_", cut_name, mark))


def search_variants(name: Column, prefixes: tuple[str, ...]) -> Column:
    """A local name, and what is left without a class's name (and Error) before it, where that is anything."""
    local = text.local_name(name)
    bare = F.regexp_replace(local, f"^(?:{'|'.join(prefixes)})_?", "")
    more = F.when((bare != local) & (bare != ""), bare)
    error = F.when(bare.startswith("Error"), F.substring(bare, 6, 1_000_000))
    return F.array_compact(F.array(local, more, error))


def mint_key(class_name: Column, surface: Column, context: Column) -> Column:
    """Struct (key, name, weak) that an entity is minted by: its class and surface, and the context that tells such apart.

    A surface that is missing or general names nothing: then class and context are the key, and the name is the class
    with a hash of the key. Context without a letter or digit counts by its hash; names keep to their length.
    """
    kind, said = F.lower(class_name), text.normalize(F.coalesce(context, F.lit("")))
    weak = F.coalesce(surface, F.lit("")).eqNullSafe("") | surfaces.generic(surface)
    told = F.when(F.coalesce(context, F.lit("")).isin("") | context.eqNullSafe(surface), F.lit("")).otherwise(F.concat(F.lit("|"), F.when(said != "", F.substring(said, 1, 80)).otherwise(text.short_hash(F.coalesce(context, F.lit(""))))))
    own = text.normalize(F.coalesce(surface, F.lit("")))
    strong_key = F.concat(kind, F.lit("|"), F.when(own != "", own).otherwise(kind), told)
    weak_key = F.concat(kind, F.lit("|"), F.when(said != "", said).otherwise(text.short_hash(F.coalesce(F.when(context != "", context), class_name))))
    key = F.when(weak, weak_key).otherwise(strong_key)
    base = lambda c: F.when(text.camel_case(c) != "", text.camel_case(c))
    named = F.coalesce(F.when(~weak, base(surface)), base(class_name), F.lit("Entity"))
    name = F.when(weak, F.concat_ws("_", named, text.short_hash(weak_key))).otherwise(named)
    return F.struct(key.alias("key"), limited_name(name, key).alias("name"), weak.alias("weak"))


def should_remint(local: Column, surface: Column, said_by: Column) -> Column:
    """Whether a name that an entity has should be minted anew: ``said_by`` is the predicate its preferred surface is from.

    So it is where an identifier is a code or says nothing, where the surface is a numbered variant, and where the name is general while
    an identifier, an extract or another surface tells more.
    """
    own = text.humanize(local)
    identified = said_by.eqNullSafe("identifier")
    more = identified | said_by.eqNullSafe("extract") | ((F.coalesce(surface, F.lit("")) != "") & (text.normalize(surface) != text.normalize(own)))
    return F.coalesce(identified & surfaces.code_like(surface), F.lit(False)) | F.coalesce(surfaces.numeric_variant(surface), F.lit(False)) | (surfaces.generic(own) & more) | (identified & surfaces.generic(surface))


def minted(entities: DataFrame, type_name: Column, surface: Column, registry: DataFrame | None = None) -> DataFrame:
    """(id, key, name): names minted from type and surface.

    Equal keys share a name; keys that want the same name get a hash behind it, but for the first key; a
    registry (key, name) is used where it has the key.
    """
    base = F.coalesce(F.when(text.camel_case(surface) != "", text.camel_case(surface)), type_name)
    keyed = entities.select("id", F.concat_ws("|", type_name, text.normalize(surface)).alias("key"), base.alias("base"))
    keys = keyed.groupBy("key").agg(F.min("base").alias("base"))
    first = keys.groupBy("base").agg(F.min("key").alias("first"))
    named = keys.join(first, "base").select("key", F.when(F.col("key") == F.col("first"), F.col("base")).otherwise(F.concat_ws("_", "base", text.short_hash(F.col("key")))).alias("name"))
    if registry is not None:
        known = registry.select("key", F.col("name").alias("known"))
        named = named.join(known, "key", "left").select("key", F.coalesce("known", "name").alias("name"))
    return keyed.join(named, "key").select("id", "key", "name")


def clusters(vectors: DataFrame) -> DataFrame:
    """(label, id, cosine): each vector with the centre of its label.

    Sums are combined before the shuffle; a centre is one array a label, as long as a vector, and each vector is
    compared with it as a whole.
    """
    at = vectors.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg("x").alias("c"))
    centre = at.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "c"))), lambda e: e["c"]).alias("centre"))
    total = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    e, c = F.col("embedding"), F.col("centre")
    return vectors.join(centre, "label").select("label", "id", (total(e, c) / (F.sqrt(total(e, e)) * F.sqrt(total(c, c)))).alias("cosine"))


def neighbours(triples: DataFrame) -> DataFrame:
    """(node, other): entities one link apart, in either direction."""
    e = patterns.links(triples)
    return e.select(F.col("s").alias("node"), F.col("o").alias("other")).union(e.select(F.col("o").alias("node"), F.col("s").alias("other"))).distinct()
