"""Questions: repair, language, canonical surface, anchor groups, technical tokens, and the parse record of them all."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import surfaces, text, turtle_text
from . import patterns, retrieve


def groups(questions: DataFrame, rules: DataFrame) -> DataFrame:
    """(id, group, n): rule groups (group, phrase of one or more words) that a question (id, text) has phrases of."""
    found = retrieve.phrase_hits(questions, rules.select(F.col("phrase").alias("term")), 2).withColumnRenamed("term", "key")
    return found.join(rules.withColumn("key", text.normalize(F.col("phrase"))), "key").groupBy("id", "group").agg(F.count("*").alias("n"))


def normalized(questions: DataFrame, replacements: tuple[tuple[str, str], ...], rules: DataFrame, default: str = "en") -> DataFrame:
    """(id, text, language, confidence, canonical, tokens, signals, groups): the record that planning starts from.

    Broken characters are repaired first; the language is of the repaired text; phrases are replaced in order.
    """
    fixed = questions.select("id", turtle_text.mojibake_repaired(F.col("text")).alias("text"))
    lang = surfaces.detected_language(text.language_scores(F.col("text")), default)
    base = fixed.withColumn("__lang", lang).withColumn("canonical", surfaces.replaced(F.col("text"), replacements))
    found = groups(base.select("id", F.col("canonical").alias("text")), rules).groupBy("id").agg(F.array_sort(F.collect_set("group")).alias("groups"))
    out = base.join(found, "id", "left")
    return out.select(
        "id", "text", "__lang.language", "__lang.confidence", "canonical", text.significant_tokens(F.col("canonical")).alias("tokens"),
        surfaces.signal_tokens(F.col("canonical")).alias("signals"), F.coalesce("groups", F.array().cast("array<string>")).alias("groups"),
    )


def anchor_text(parsed: DataFrame, hits: DataFrame) -> DataFrame:
    """(id, anchor, how): what a question is about: its first signal, else its best lexicon hit (id, term, rank), else its longest word."""
    best = hits.where("rank = 1").select("id", F.col("term").alias("hit"))
    longest = F.array_max(F.transform("tokens", lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    signal = F.get("signals", 0)
    out = parsed.join(best, "id", "left")
    how = F.when(signal.isNotNull(), "signal").when(F.col("hit").isNotNull(), "lexicon").when(longest.isNotNull(), "word").otherwise("none")
    return out.select("id", F.coalesce(signal, F.col("hit"), longest).alias("anchor"), how.alias("how"))


def filtered(candidates: DataFrame, words: list[str]) -> DataFrame:
    """Candidates (id, node) that have one of the words; of a question without any such candidate, all of them."""
    keep = text.any_contains(F.col("node"), words)
    some = candidates.where(keep).select("id").distinct().withColumn("__some", F.lit(True))
    return candidates.join(some, "id", "left").where(keep | F.col("__some").isNull()).drop("__some")


def neighbourhood(triples: DataFrame, nodes: DataFrame, limit: int | None = None) -> DataFrame:
    """(node, text): what a node (column node) states, as one line a node, in order; clipped if a limit is given."""
    own = triples.join(nodes.select(F.col("node").alias("s")).distinct(), "s", "left_semi")
    joined = own.groupBy(F.col("s").alias("node")).agg(F.array_join(F.array_sort(F.collect_set(F.concat_ws(" ", "p", "o"))), "; ").alias("t"))
    return joined.select("node", (F.substring("t", 1, limit) if limit else F.col("t")).alias("text"))


def prompts(chunks: DataFrame, terms: DataFrame, template: str, least: int = 50) -> DataFrame:
    """(id, prompt): a prompt for each chunk (id, text) long enough, with the known terms (term, uri) that stand in it.

    The template has %s for the terms and %s for the text.
    """
    long = chunks.where(F.length(F.trim("text")) >= least)
    named = terms.groupBy(text.normalize(F.col("term")).alias("term")).agg(F.max("uri").alias("uri"))
    known = retrieve.phrase_hits(long, terms, 2).join(named, "term")
    listed = known.groupBy("id").agg(F.array_join(F.array_sort(F.collect_set(F.concat_ws("=", "term", "uri"))), ", ").alias("known"))
    return long.join(listed, "id", "left").select("id", F.format_string(template, F.coalesce("known", F.lit("")), F.trim("text")).alias("prompt"))


def paired_gates(results: DataFrame, left: str, right: str, least: float = 0.9) -> DataFrame:
    """(n, same_intent, same_family, same_groups, passed) of results (pair, language, intent, family, groups) in two languages."""
    a = results.where(F.col("language") == left).select("pair", F.col("intent").alias("ia"), F.col("family").alias("fa"), F.col("groups").alias("ga"))
    b = results.where(F.col("language") == right).select("pair", F.col("intent").alias("ib"), F.col("family").alias("fb"), F.col("groups").alias("gb"))
    n = a.join(b, "pair").agg(F.count("*").alias("n"), F.count_if(F.col("ia") == F.col("ib")).alias("same_intent"), F.count_if(F.col("fa") == F.col("fb")).alias("same_family"), F.count_if(F.col("ga") == F.col("gb")).alias("same_groups"))
    return n.withColumn("passed", (F.col("n") > 0) & (F.least("same_intent", "same_family", "same_groups") >= least * F.col("n")))


def best_hits(hits: DataFrame, most: int = 8) -> DataFrame:
    """Hits (id, term) by length, then name, at most so many a question."""
    return patterns.top_by(hits, most, "id", F.desc(F.length("term")), F.col("term"))
