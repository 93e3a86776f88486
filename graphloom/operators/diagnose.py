"""Why a question did well or not: quality of the answer's surface, gaps of reference and structure, and what to change next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text

#: What an answer says that has nothing to say (fixed values).
NEGATIVE = ("no dispongo", "no se encuentra", "no hay informacion", "no se encontraron", "context is insufficient")
#: General cues of questions that need the strict plans (fixed values); an installation adds those of its own machines.
RUNTIME_CUES = (
    "mdi", "mda", "softkey", "tecla", "keyboard", "monitor", "jog", "home search", "busqueda de referencia", "busqueda de bloque", "block search", "tool inspection", "inspeccion de herramienta",
    "g code", "codigo g", "ctrl", "utilities mode", "modo utilidades", "administrator mode", "setup mode", "user mode", "configuration",
)
#: Work that follows from a gap (fixed values).
NEXT = {
    "graph_canonicalization_gap": "canonical_entity_consolidation",
    "graph_linking_gap": "structural_link_completion",
    "missing_value_surface": "surface_literal_enrichment",
    "planner_gap": "planner_generalization_tuning",
    "boundedness_gap": "boundedness_policy_tuning",
    "synthesis_surface_gap": "surface_synthesis_polish",
    "answer_reference_mismatch": "canonical_reference_alignment",
}
FINE = ("ok_structurally", "needs_expected_uris_promotion")


def identifier_like(c: Column) -> Column:
    """Whether an answer is an address, a name with underscores, in mixed case, or a word with numbers."""
    return c.rlike("https?://") | c.rlike("_") | c.rlike("[A-Z][a-z]+[A-Z][A-Za-z0-9]+") | c.rlike("^[A-Za-z]+(?:[0-9]+|_[0-9]+)+(?:_[A-Za-z0-9]+)*$")


def surface_quality(expected: Column, actual: Column, mode: Column) -> Column:
    """clean, acceptable, overspecified, identifier_heavy or underspecified, by the answer and how it matches."""
    said = text.normalize(actual)
    n = lambda c: F.greatest(F.size(text.significant_tokens(c)), F.lit(1))
    empty = (F.coalesce(said, F.lit("")) == "") | text.any_contains(said, list(NEGATIVE))
    return (
        F.when(empty, "underspecified")
        .when(identifier_like(actual), "identifier_heavy")
        .when((n(actual) > F.greatest(2 * n(expected), F.lit(20))) & mode.isin("partial", "weak"), "overspecified")
        .when(mode.isin("exact", "high_partial"), "clean")
        .otherwise("acceptable")
    )


def reference_gap(quality: Column, better: Column, n_expected_literals: Column, literal_hit: Column) -> Column:
    """What the answer's reference lacks: the first that holds."""
    return (
        F.when(quality == "identifier_heavy", "identifier_instead_of_surface")
        .when(better, "better_literal_exists")
        .when((n_expected_literals > 0) & ~literal_hit, "canonical_reference_missing")
        .otherwise("none")
    )


def structural_gap(r: dict[str, Column]) -> Column:
    """The gap behind a result, from columns bounded, n_rows, confidence, fallback, issue, quality, reference, mode,
    n_selected and chosen (boolean); the first that holds."""
    some = r["n_selected"] > 0
    return (
        F.when(~r["bounded"], "boundedness_gap")
        .when((r["n_rows"] == 0) & (r["confidence"] >= 0.55) & ~r["fallback"], "planner_gap")
        .when(r["issue"].isin("graph_linking_gap", "graph_canonicalization_gap"), r["issue"])
        .when(r["quality"] == "identifier_heavy", "missing_value_surface")
        .when(r["reference"] == "canonical_reference_missing", "answer_reference_mismatch")
        .when((r["mode"] == "none") & some, "graph_linking_gap")
        .when(r["mode"] == "none", "planner_gap")
        .when(some & r["mode"].isin("partial", "weak") & r["quality"].isin("acceptable", "overspecified"), "synthesis_surface_gap")
        .when(some & r["mode"].isin("exact", "high_partial") & r["chosen"], "needs_expected_uris_promotion")
        .otherwise("ok_structurally")
    )


def promotions(results: DataFrame) -> DataFrame:
    """(id, promote, expected): results (id, gap, mode, chosen, candidate) that did well; those with an entity are promoted with it."""
    good = results.where(F.col("gap").isin(*FINE) & F.col("mode").isin("exact", "high_partial"))
    expected = F.coalesce("chosen", "candidate")
    return good.select("id", expected.isNotNull().alias("promote"), expected.alias("expected"))


def next_change(gaps: DataFrame) -> DataFrame:
    """(work, gap): what to do next by the most frequent gap (column gap), ties by name; without any, promoting questions."""
    counted = gaps.where(~F.col("gap").isin(*FINE)).groupBy("gap").agg(F.count("*").alias("n"))
    top = counted.agg(F.min(F.struct((-F.col("n")).alias("n"), "gap")).alias("m"))
    work = F.create_map(*[F.lit(x) for kv in NEXT.items() for x in kv])
    gap = F.col("m.gap")
    return top.select(
        F.when(gap.isNull(), "formalize_promotable_sandbox_questions").otherwise(F.coalesce(F.try_element_at(work, gap), F.lit("structural_gap_triage"))).alias("work"),
        F.coalesce(gap, F.lit("stable_structural_behavior_detected")).alias("gap"),
    )


def planner_failure(blocked: Column, same_anchor: Column, same_family: Column, same_signature: Column, case_ok: Column) -> Column:
    """Why planning of one question in two languages differs: the first that holds, else null."""
    return F.when(blocked, "benchmark_runner_blocker").when(~same_anchor, "anchor_normalization_gap").when(~same_family, "family_selection_gap").when(~same_signature, "sparql_convergence_gap").when(~case_ok, "cross_family_missing")


def pair_failure(blocked: Column, same_plan: Column, n_left: Column, n_right: Column, left_ok: Column, right_ok: Column) -> Column:
    """Why a pair of answers in two languages fails: the first that holds, else null."""
    return (
        F.when(blocked, "benchmark_runner_blocker")
        .when(~same_plan, "cross_planner_gap")
        .when((n_left == 0) & (n_right == 0), "cross_document_coverage_gap")
        .when(~(left_ok & right_ok) & ((n_left > 0) | (n_right > 0)), "cross_surface_gap")
        .when(~(left_ok & right_ok), "cross_linking_gap")
    )


def runtime_context(n_groups: Column, n_signals: Column, canonical: Column, cues: tuple[str, ...] = RUNTIME_CUES) -> Column:
    """(strict, cue): whether a question has a cue of the strict plans, and whether it is a candidate for them."""
    cue = text.any_contains(canonical, list(cues))
    return F.struct(((n_groups > 0) | (n_signals > 0) | cue).alias("strict"), cue.alias("cue"))


def mostly_in(rows: DataFrame, group: str, language: str, least: float = 0.6) -> DataFrame:
    """(group, n, share, mostly): whether enough of each group's rows (column language) are in a language."""
    out = rows.groupBy(group).agg(F.count("*").alias("n"), F.count_if(F.col("language") == language).alias("k"))
    share = F.round(F.col("k") / F.col("n"), 4)
    return out.select(group, "n", share.alias("share"), (F.col("k") >= least * F.col("n")).alias("mostly"))


def snapshot(artifacts: DataFrame) -> DataFrame:
    """(stage, n, n_bytes, latest): inventory of artifacts (stage, path, n_bytes, written) by stage."""
    return artifacts.groupBy("stage").agg(F.count("*").alias("n"), F.sum("n_bytes").alias("n_bytes"), F.max("written").alias("latest"))
