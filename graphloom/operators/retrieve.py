"""From questions to evidence: surface index, intents, bounded plans and ranked evidence."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from . import patterns


def surface_index(entities: DataFrame) -> DataFrame:
    """(surface, n_entities, least): inverted index from normalised surfaces to entities (id, surface)."""
    keyed = entities.select("id", text.normalize(F.col("surface")).alias("surface")).where(F.length("surface") >= 3)
    return keyed.groupBy("surface").agg(F.count_distinct("id").alias("n_entities"), F.min("id").alias("least"))


def phrase_hits(texts: DataFrame, terms: DataFrame, least: int = 1) -> DataFrame:
    """(id, term): terms of one or more words that stand in a text (id, text), once each, both normalised.

    Runs of words as long as any term are joined with the terms by equality, so no text is compared with all terms.
    Terms of fewer than ``least`` characters are left out.
    """
    known = terms.select(text.normalize(F.col("term")).alias("term")).where(F.length("term") >= least).distinct()
    lengths = tuple(sorted(r[0] for r in known.select(F.size(F.split("term", " "))).distinct().collect()))  # a few numbers
    if not lengths:
        return texts.select("id", F.lit("").alias("term")).where(F.lit(False))
    return texts.select("id", F.explode(F.array_distinct(text.phrases(F.col("text"), lengths))).alias("term")).join(known, "term").select("id", "term")


def question_hits(questions: DataFrame, terms: DataFrame, most: int = 8) -> DataFrame:
    """(id, term, rank): terms of one or more words that stand in a question (id, text), the longest first, at most so many."""
    hit = phrase_hits(questions, terms, 3)
    return patterns.top_by(hit, most, "id", F.desc(F.length("term")), F.col("term")).select("id", "term", "rank")


def intents(questions: DataFrame, rules: DataFrame) -> DataFrame:
    """(id, intent, score): for each question the rule (intent, keyword, weight) set of highest weight, ties by name.

    Questions without any keyword have intent generic and score 0.
    """
    words = questions.select("id", F.explode(F.array_distinct(text.tokens(F.col("text"), 2))).alias("keyword"))
    scored = words.join(rules, "keyword").groupBy("id", "intent").agg(F.sum("weight").alias("score"))
    best = scored.groupBy("id").agg(F.min(F.struct((-F.col("score")).alias("n"), "intent")).alias("m"))
    out = questions.select("id").join(best, "id", "left")
    return out.select("id", F.coalesce("m.intent", F.lit("generic")).alias("intent"), F.coalesce(-F.col("m.n"), F.lit(0)).cast("long").alias("score"))


@dataclass(frozen=True)
class Step:
    """One step of a plan: along a predicate, and at most how many entities it may hand on."""

    predicate: str
    incoming: bool = False
    most: int | None = None


@dataclass(frozen=True)
class Plan:
    """Seeds, steps, and the predicates to describe at the end."""

    seeds: tuple[str, ...]
    steps: tuple[Step, ...]
    describe: tuple[str, ...] = ("label",)
    trace: list[str] = field(default_factory=list, compare=False)


def run_plan(triples: DataFrame, plan: Plan) -> DataFrame:
    """(s, p, o) of what the plan reaches: one lazy query, so filters and joins are planned as a whole.

    A step's bound keeps the least names, in a total order.
    """
    spark = triples.sparkSession
    at = spark.createDataFrame([(s,) for s in plan.seeds], "node string")
    for step in plan.steps:
        at = patterns.traverse(triples, at, step.predicate, step.incoming)
        if step.most is not None:
            at = at.orderBy("node").limit(step.most)
    return patterns.describe(triples, at, list(plan.describe))


def run_with_fallback(triples: DataFrame, *plans: Plan) -> tuple[int, DataFrame]:
    """(number, rows) of the first plan that reaches anything; the last one's rows if none does."""
    for i, plan in enumerate(plans):
        rows = run_plan(triples, plan)
        if i == len(plans) - 1 or not rows.isEmpty():
            return i, rows
    raise ValueError("no plan")


def boundedness(triples: DataFrame, plan: Plan) -> DataFrame:
    """(step, predicate, reached, status): whether each step reaches nothing, more than its bound, or what it may."""
    spark = triples.sparkSession
    at, out = spark.createDataFrame([(s,) for s in plan.seeds], "node string"), None
    for i, step in enumerate(plan.steps):
        at = patterns.traverse(triples, at, step.predicate, step.incoming)
        n = at.agg(F.lit(i).alias("step"), F.lit(step.predicate).alias("predicate"), F.count("*").alias("reached"))
        status = F.when(F.col("reached") == 0, "too_narrow").when(F.col("reached") > F.lit(step.most if step.most is not None else 2**62), "too_broad").otherwise("bounded")
        out = n.withColumn("status", status) if out is None else out.unionByName(n.withColumn("status", status))
        if step.most is not None:
            at = at.orderBy("node").limit(step.most)
    return out


def evidence(questions: DataFrame, rows: DataFrame, most: int = 3) -> DataFrame:
    """(id, row, shared, rank): for each question the rows (row, text) that share most significant words with it.

    All significant words of all rows count. Rows of equal words are scored once, and of them the first ``most`` are
    kept, as no other can rank.
    """
    q = questions.select("id", F.explode(text.significant_tokens(F.col("text"))).alias("word"))
    worded = rows.select("row", F.array_sort(text.significant_tokens(F.col("text"))).alias("words"))
    first = patterns.top_by(worded.select("row", F.sha2(F.array_join("words", " "), 256).alias("key"), "words"), most, "key", F.col("row")).drop("rank")
    r = first.groupBy("key").agg(F.first("words").alias("words")).select("key", F.explode("words").alias("word"))
    shared = q.join(r, "word").groupBy("id", "key").agg(F.count("*").alias("shared"))
    return patterns.top_by(shared.join(first.select("key", "row"), "key").select("id", "row", "shared"), most, "id", F.desc("shared"), F.col("row"))
