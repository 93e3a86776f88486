"""Judging proposed merges: descriptions, candidates by spelling, signals of a pair, and the rules that accept or refuse it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import similarity, text
from . import patterns

#: Least similarity of spellings that are one thing, and least characters of a key (fixed values).
SAME_SPELLING, KEY_LENGTH = 0.92, 5


def descriptions(triples: DataFrame) -> DataFrame:
    """(id, label, identifier, best, local, classes, n_surfaces, n_in): what merging is decided by, a row an entity."""
    least = lambda p: F.min(F.when(F.col("p") == p, F.col("o")))
    own = triples.groupBy(F.col("s").alias("id")).agg(
        least("label").alias("label"), least("identifier").alias("identifier"), F.array_sort(F.collect_set(F.when(F.col("p") == "type", F.col("o")))).alias("classes"),
        F.count_if(F.col("p").isin("label", "identifier")).alias("n_surfaces"),
    )
    into = patterns.links(triples).groupBy(F.col("o").alias("id")).agg(F.count("*").alias("n_in"))
    local = text.local_name(F.col("id"))
    return own.join(into, "id", "left").select("id", "label", "identifier", F.coalesce("identifier", "label", local).alias("best"), local.alias("local"), "classes", "n_surfaces", F.coalesce("n_in", F.lit(0)).alias("n_in"))


def variant_candidates(described: DataFrame, least: int = KEY_LENGTH) -> DataFrame:
    """(key, source, candidate): entities that share the compact key of any of their names, each with its key's pivot.

    The pivot has most links to it, then most surfaces, then the least name; it is an aggregate, so a hot key is
    combined early and pairs grow with the key's members, not with their square.
    """
    names = F.array(*[text.variant_key(F.coalesce(F.col(c), F.lit(""))) for c in ("label", "identifier", "best", "local")])
    keyed = described.select("id", "n_in", "n_surfaces", "local", F.explode(F.array_distinct(names)).alias("key")).where(F.length("key") >= least)
    pivot = keyed.groupBy("key").agg(F.min(F.struct((-F.col("n_in")).alias("a"), (-F.col("n_surfaces")).alias("b"), "local", "id")).alias("m"), F.count("*").alias("n")).where("n > 1")
    return keyed.join(pivot.select("key", F.col("m.id").alias("source")), "key").where("id <> source").select("key", "source", F.col("id").alias("candidate"))


def described_pairs(pairs: DataFrame, described: DataFrame) -> DataFrame:
    """Pairs (source, candidate) with both descriptions, as structs a and b."""
    d = F.struct(*described.columns)
    a, b = described.select(F.col("id").alias("source"), d.alias("a")), described.select(F.col("id").alias("candidate"), d.alias("b"))
    return pairs.join(a, "source").join(b, "candidate")


def spelled_alike(a: Column, b: Column) -> Column:
    """The matching-block ratio of two normalised values."""
    return similarity.ratio(text.normalize_technical(a), text.normalize_technical(b))


def spelling_similarity(ratio: Callable[[Column, Column], Column] = spelled_alike) -> Column:
    """The best similarity of surfaces, labels and local names of a and b."""
    some = lambda s, c: F.coalesce(F.col(f"{s}.{c}"), F.lit(""))
    return F.greatest(*[ratio(some("a", c), some("b", c)) for c in ("best", "label", "local")])


def merge_verdict(compatible: Column, similar: Column, blocked: Column, least: float = SAME_SPELLING) -> Column:
    """Why a pair of one spelling is refused, or that it is accepted: the first rule that holds."""
    return (
        F.when(~F.coalesce(compatible, F.lit(False)), "incompatible_entity_types")
        .when(similar < least, "surface_similarity_below_threshold")
        .when(blocked, "contextual_suffix_blocked")
        .otherwise("surface_variant_canonicalization")
    )


def variant_scan(described: DataFrame, compatible: DataFrame, ratio: Callable[[Column, Column], Column] = spelled_alike) -> DataFrame:
    """(key, source, candidate, similarity, verdict) of all spelling candidates; ``compatible`` has (x, y) for classes that go together.

    Equal classes go together by themselves; entities without a class with none.
    """
    pairs = described_pairs(variant_candidates(described), described)
    both = pairs.select("key", "source", "candidate", "a", "b", F.explode("a.classes").alias("x"), F.col("b.classes").alias("ys")).select("key", "source", "candidate", "x", F.explode("ys").alias("y"))
    known = compatible.select("x", "y").union(compatible.select("y", "x")).distinct().withColumn("known", F.lit(True))
    judged = both.join(known, ["x", "y"], "left").groupBy("key", "source", "candidate").agg(F.max((F.col("x") == F.col("y")) | F.coalesce("known", F.lit(False))).alias("compatible"))
    scored = pairs.join(judged, ["key", "source", "candidate"], "left").withColumn("similarity", F.round(spelling_similarity(ratio), 4))
    blocked = text.context_blocked(F.col("a.local")) | text.context_blocked(F.col("b.local"))
    return scored.select("key", "source", "candidate", "similarity", merge_verdict(F.col("compatible"), F.col("similarity"), blocked).alias("verdict"))


def scan_summary(scanned: DataFrame) -> DataFrame:
    """(verdict, n, n_sources): how the scan's pairs were judged."""
    return scanned.groupBy("verdict").agg(F.count("*").alias("n"), F.count_distinct("source").alias("n_sources"))


def alignment(expected: Column, value: Column, ratio: Callable[[Column, Column], Column] = spelled_alike) -> Column:
    """How well a value answers what is expected: shared words, spelling, shared key literals, shape of an identifier."""
    shared = F.size(F.array_intersect(text.key_literals(expected), text.key_literals(value)))
    return F.round(text.token_overlap(text.tokens(expected, 3), text.tokens(value, 3)) + ratio(expected, value) + 0.4 * shared + text.structured_identifier_score(value), 4)


def decision(issue: Column, compatible: Column, gain: Column, of_candidate: Column, hits: Column, candidate_hits: Column, shape: Column) -> Column:
    """Whether a candidate is kept for an issue, and by which rule: its gain in alignment over the source, its own
    alignment, the key literals either shares with what is expected, and the shape of its identifier."""
    canonical = F.when((candidate_hits > hits) & (shape >= 0.75), "expected_reference_key_literal_preferred").when((of_candidate >= 1.05) & (gain >= 0.25), "strong_expected_alignment_improvement").otherwise("insufficient_canonical_alignment_gain")
    linking = F.when((of_candidate >= 0.9) & (candidate_hits >= hits), "linkable_candidate_with_expected_alignment").otherwise("insufficient_linking_alignment_gain")
    surface = F.when((of_candidate >= 0.72) & (gain >= 0.12), "better_surface_literal_available").otherwise("surface_gain_too_small")
    return (
        F.when(~compatible, "incompatible_entity_types")
        .when(issue == "graph_canonicalization_gap", canonical)
        .when(issue == "graph_linking_gap", linking)
        .when(issue == "missing_value_surface", surface)
        .otherwise("unsupported_issue")
    )


#: Decisions that keep a candidate (fixed values).
KEPT = ("expected_reference_key_literal_preferred", "strong_expected_alignment_improvement", "linkable_candidate_with_expected_alignment", "better_surface_literal_available")


def protected(candidates: DataFrame, anchors: DataFrame) -> DataFrame:
    """Candidates (source, ...) whose source is no declared canonical entity (canonical)."""
    return candidates.join(anchors.select(F.col("canonical").alias("source")).distinct(), "source", "left_anti")


def anchor_mapping(anchors: DataFrame, column: str = "absorbs") -> DataFrame:
    """(source, target) of anchors (canonical, absorbs, legacy_aliases; lists): what each of a list's names stands for."""
    return anchors.select(F.explode(column).alias("source"), F.col("canonical").alias("target")).groupBy("source").agg(F.max("target").alias("target"))


def with_supplements(triples: DataFrame, mapping: DataFrame, supplements: DataFrame) -> DataFrame:
    """The graph rewritten by a mapping (source, target), with a link more for each that led to a source: from the
    same entity, by the same predicate, to each of the source's supplements (source, extra), themselves rewritten."""
    out = patterns.rewrite(triples, mapping)
    goes = mapping.select(F.col("source").alias("k"), F.col("target").alias("to"))
    extra = supplements.join(goes, supplements.extra == goes.k, "left").select("source", F.coalesce("to", "extra").alias("extra"))
    own = goes.withColumnRenamed("k", "source")
    extra = extra.join(own, "source", "left").where(F.col("to").isNull() | (F.col("to") != F.col("extra"))).select("source", "extra").distinct()
    led = patterns.links(triples).join(extra, F.col("o") == F.col("source"))
    led = led.join(goes, F.col("s") == F.col("k"), "left").select(F.coalesce("to", "s").alias("s"), "p", F.col("extra").alias("o"), F.lit("iri").alias("kind"), F.lit(None).cast("string").alias("lang"))
    return out.unionByName(led.where("s <> o")).distinct()


def rewrite_counts(triples: DataFrame, mapping: DataFrame) -> DataFrame:
    """(rewritten_subjects, rewritten_objects, rewritten_triples, skipped_loops) of a mapping applied to a graph."""
    m1 = mapping.select(F.col("source").alias("s"), F.col("target").alias("s2"))
    m2 = mapping.select(F.col("source").alias("o"), F.col("target").alias("o2"))
    link = (F.col("kind") == "iri") & (F.col("p") != "type")
    out = triples.join(m1, "s", "left").join(m2, "o", "left")
    subject, obj = F.col("s2").isNotNull(), link & F.col("o2").isNotNull()
    loop = link & (subject | obj) & (F.coalesce("s2", "s") == F.coalesce("o2", "o"))
    return out.agg(F.count_if(subject).alias("rewritten_subjects"), F.count_if(obj).alias("rewritten_objects"), F.count_if((subject | obj) & ~loop).alias("rewritten_triples"), F.count_if(loop).alias("skipped_loops"))


def link_relation(source: Column, target: Column, question: Column) -> Column:
    """(rule, predicate, flipped): how two entities are linked by their roles and the question, the first rule that holds; else null.

    Roles are directive, machine, consumable, maintenance, interface, component, reference.
    """
    asks = lambda *ws: F.array_size(F.array_intersect(text.tokens(question), F.array(*map(F.lit, ws)))) > 0
    rule = lambda name, p, flipped=False: F.struct(F.lit(name).alias("rule"), F.lit(p).alias("predicate"), F.lit(flipped).alias("flipped"))
    oil = asks("oil", "grease", "lubricant", "aceite", "grasa", "engrase", "consumible")
    care = asks("maintenance", "mantenimiento", "engrase", "horas", "50", "h")
    return (
        F.when((source == "machine") & (target == "directive"), rule("machine_directive", "complies"))
        .when((source == "directive") & (target == "machine"), rule("machine_directive", "complies", True))
        .when((target == "consumable") & (source != "consumable") & oil, rule("consumable", "requiresConsumable"))
        .when((source == "consumable") & (target != "consumable") & oil, rule("consumable", "requiresConsumable", True))
        .when((source == "maintenance") & (target != "maintenance"), rule("maintenance", "requiresMaintenance", True))
        .when((target == "maintenance") & care, rule("maintenance", "requiresMaintenance"))
        .when((source == "interface") & (target == "component"), rule("interface", "hasComponent"))
        .when((source == "component") & (target == "interface"), rule("interface", "hasComponent", True))
        .when((source == "reference") | (target == "reference"), F.when(asks("scheme", "plan", "esquema", "plano"), rule("reference", "detailedIn")).otherwise(rule("reference", "shownIn")))
    )


def unique_local_names(triples: DataFrame) -> DataFrame:
    """(local, id): local names that exactly one entity has."""
    names = triples.select(F.col("s").alias("id")).distinct().withColumn("local", text.local_name(F.col("id")))
    return names.groupBy("local").agg(F.min("id").alias("id"), F.count("*").alias("n")).where("n = 1").select("local", "id")


def found_by_text(triples: DataFrame, wanted: DataFrame, unique: bool = True) -> DataFrame:
    """(key, id): entities whose literals hold all of the words wanted (key, words); only those that are alone, if unique.

    Words meet by equality; an entity counts when it has as many of the different words as there are.
    """
    said = triples.where("kind = 'literal'").select(F.col("s").alias("id"), F.explode(F.array_distinct(text.tokens(F.col("o")))).alias("word")).distinct()
    words = wanted.select("key", F.explode(F.array_distinct(F.transform("words", text.normalize))).alias("word"), F.size(F.array_distinct(F.transform("words", text.normalize))).alias("need"))
    hit = words.join(said, "word").groupBy("key", "id", "need").agg(F.count("*").alias("n")).where("n = need").select("key", "id")
    if not unique:
        return hit
    return hit.groupBy("key").agg(F.min("id").alias("id"), F.count("*").alias("n")).where("n = 1").select("key", "id")


def excerpts(triples: DataFrame, found: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, id, excerpt): of each found entity the literal that holds most of the words wanted, then the shortest, then the least."""
    w = wanted.select("key", F.transform("words", text.normalize).alias("words"))
    values = found.join(w, "key").join(triples.where("kind = 'literal'").select(F.col("s").alias("id"), "o"), "id")
    scored = values.withColumn("n", F.size(F.array_intersect("words", text.tokens(F.col("o")))))
    return patterns.first_by(scored, ["key", "id"], F.desc("n"), F.length("o"), F.col("o")).select("key", "id", F.col("o").alias("excerpt"))


def chosen_entities(evidence: DataFrame, index: DataFrame) -> DataFrame:
    """(id, entity): for each question the first of its evidence (id, rank, name) that the index (name, entity) knows, by least entity."""
    known = index.groupBy("name").agg(F.min("entity").alias("entity"))
    return evidence.join(known, "name").groupBy("id").agg(F.min(F.struct("rank", "entity"))["entity"].alias("entity"))


def resolution_issue(n_rows: Column, chosen_literal: Column, chosen_score: Column, best_score: Column) -> Column:
    """What an answer's entity points to: another one that says it clearly better, one that should be linked, or nothing.

    Without another candidate the best score is null.
    """
    better = F.coalesce(best_score >= F.greatest(chosen_score + 0.2, F.lit(0.85)), F.lit(False))
    return F.when(better, "graph_canonicalization_gap").when((n_rows > 0) & (F.coalesce(chosen_literal, F.lit("")) == "") & best_score.isNotNull(), "graph_linking_gap")


def enrichment_corpus(results: DataFrame, targets: DataFrame, supported: DataFrame) -> DataFrame:
    """(id, gap, entity, target, score, status): results (id, gap, entity) of supported gaps (gap, priority), each with its best target (id, target, score).

    Those without an entity are marked as discarded; rows are in the order of priority, then score, then id.
    """
    best = targets.groupBy("id").agg(F.min(F.struct((-F.col("score")).alias("d"), "target")).alias("m")).select("id", F.col("m.target").alias("target"), (-F.col("m.d")).alias("score"))
    r = results.join(supported, "gap").join(best, "id", "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
    r = r.withColumn("status", F.when(F.col("entity").isNull(), "missing_entity").otherwise("accepted"))
    return r.orderBy("priority", F.desc("score"), "id").select("id", "gap", "entity", "target", "score", "status")


def question_families(questions: DataFrame, families: tuple[tuple[str, str], ...]) -> DataFrame:
    """(family, n, first): questions (id, text) by the first family (pattern, family) whose pattern they hold; others are left out."""
    family = F.coalesce(*[F.when(F.col("text").rlike(f"(?i){p}"), name) for p, name in families])
    return questions.select("id", family.alias("family")).where("family IS NOT NULL").groupBy("family").agg(F.count("*").alias("n"), F.min("id").alias("first"))


def residual_links(families: DataFrame, ends: DataFrame, least: float = 0.9) -> DataFrame:
    """(family, s, p, o, confidence): links that complete a graph, by families (family, predicate, confidence, active) and their ends (family, side, entity).

    A family gives links only if it is active, sure enough, has a predicate, and has exactly one source; then one to each target.
    """
    able = families.where(F.col("active") & (F.col("confidence") >= least) & F.col("predicate").isNotNull())
    source = ends.where("side = 'source'").groupBy("family").agg(F.count_distinct("entity").alias("k"), F.min("entity").alias("s")).where("k = 1")
    target = ends.where("side = 'target'").select("family", F.col("entity").alias("o")).distinct()
    return able.join(source, "family").join(target, "family").select("family", "s", F.col("predicate").alias("p"), "o", "confidence")
