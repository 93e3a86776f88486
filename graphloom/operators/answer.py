"""From ranked evidence to answers: mode, extraction, rendering. Answers come from evidence only, or are refused."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from . import patterns

#: (mode, pattern in the question), the first that matches (fixed values).
MODES = (
    ("email", r"\be-?mail\b|\bcorreo\b"),
    ("address", r"\baddress\b|\bdirecci[oó]n\b"),
    ("directive", r"\bdirective\b|\bdirectiva\b|\bnorm\b"),
    ("figure", r"\bfigure\b|\bfigura\b"),
    ("count", r"\bhow many\b|\bcu[aá]nt[oa]s\b"),
    ("purpose", r"\bwhat for\b|\bpurpose\b|\bpara qu[eé]\b"),
    ("procedure", r"\bhow\b|\bc[oó]mo\b"),
)


#: A word boundary where words are ASCII letters, digits and underscores, as SQL engines have it.
_ASCII_BOUNDARY = r"(?:(?<=[A-Za-z0-9_])(?![A-Za-z0-9_])|(?<![A-Za-z0-9_])(?=[A-Za-z0-9_]))"


def mode(question: Column, ascii_words: bool = False) -> Column:
    """The answer mode of a question; literal if no pattern matches.

    ``ascii_words``: letters outside ASCII bound words, as in SQL's regular expressions; else they are part of them.
    """
    lowered = F.lower(F.translate(question, "İ", "i"))  # one letter, not i and a mark
    bounded = (lambda p: p.replace(r"\b", _ASCII_BOUNDARY)) if ascii_words else (lambda p: f"(?U){p}")
    return F.coalesce(*[F.when(lowered.rlike(bounded(p)), m) for m, p in MODES], F.lit("literal"))


#: Keys of a control panel and its modes, most telling first (fixed values).
CONTROL_KEYS = (r"(?i)\[CTRL\]\s*\+\s*\[F[0-9]+\]", r"(?i)\[CTRL\]\s*\+\s*\[[A-Z]+\]", r"(?i)\[(?:START|STOP|RESET|ESC|ENTER|ZERO|DEL|INS|CALC)\]", r"(?i)\b(?:FOCUS|NEXT|BACK|HELP|AUTO|MANUAL|EDIT|MDI|TABLES|TOOLS|UTILITIES|CUSTOM)\b", r"\b[FST]\b")
MODE_WORDS = r"(?i)(Automatic mode|Jog mode|MDI/MDA mode|EDIT|AUTO|MANUAL|MDI)"


def _spaced(value: Column) -> Column:
    return F.trim(F.regexp_replace(value, r"\s+", " "))


def postal_address(value: Column) -> Column:
    """What follows an address's heading, up to telephone, fax or mail, without web addresses; or a district with its country; else null."""
    v = _spaced(value)
    headed = F.regexp_extract(v, r"(?i)(?:direcci[oó]n|address)\s*:\s*(.*?)(?:\b(?:tel[eé]fono|telephone|phone|fax|e-?mail)\b|$)", 1)
    headed = F.regexp_replace(F.regexp_replace(headed, r"(?i)\(www\.[^)]+\)", ""), r"^[\s.;,:]+|[\s.;,:]+$", "")
    district = F.regexp_extract(v, r"(?i)(barrio .*?\(espa[nñ]a\))", 1)
    return F.when(headed != "", headed).when(district != "", district)


def ownership(value: Column) -> Column:
    """Whom rights are reserved to, else the whole value."""
    owner = F.regexp_extract(_spaced(value), r"(?i)(?:reservados? a|reserved (?:to|by)) (.+?)(?:\.|$)", 1)
    return F.when(owner != "", F.trim(owner)).otherwise(_spaced(value))


def control_key(value: Column) -> Column:
    """The first key that a value names, in capitals, by the order of the patterns; else the whole value."""
    some = lambda c: F.when(c != "", F.upper(F.regexp_replace(F.regexp_replace(c, r"\[ ", "["), r" \]", "]")))
    return F.coalesce(*[some(F.regexp_extract(_spaced(value), p, 0)) for p in CONTROL_KEYS], _spaced(value))


def mode_literals(value: Column) -> Column:
    """The operating modes that a value names, once each, in order; else the whole value."""
    found = F.array_distinct(F.regexp_extract_all(_spaced(value), F.lit(MODE_WORDS), F.lit(1)))
    return F.when(F.size(found) > 0, F.array_join(found, ", ")).otherwise(_spaced(value))


def department(value: Column) -> Column:
    """The department or service that a value names, else the whole value."""
    found = F.regexp_extract(_spaced(value), r"(?i)\b((?:el )?departamento de [^.,;:]+|(?:the )?[a-z ]*\bdepartment\b)", 1)
    return F.when(found != "", F.trim(found)).otherwise(_spaced(value))


def extracted(value: Column, answer_mode: Column) -> Column:
    """What a value says in a mode: null where it says nothing of the kind."""
    some = lambda c: F.when(c != "", c)
    take = lambda p, g=0: some(F.regexp_extract(value, p, g))
    first = some(F.trim(F.get(F.split(value, r"(?<=[.!?])\s"), 0)))
    return (
        F.when(answer_mode == "email", take(r"[A-Za-z0-9._-]+@[A-Za-z0-9-]+\.[A-Za-z0-9.-]*[A-Za-z0-9]"))
        .when(answer_mode == "directive", take(r"\b[0-9]{4}/[0-9]{2}/[A-Z]{2}\b"))
        .when(answer_mode == "figure", take(r"(?i)\bfig(?:ure|ura|\.)? ?([0-9]+(?:[.-][0-9]+)*)", 1))
        .when(answer_mode == "address", postal_address(value))
        .when(answer_mode == "count", take(r"\b[0-9]+\b"))
        .when(answer_mode == "purpose", F.coalesce(take(r"(?i)\b(?:used|serves|sirve) (?:to|for|para) ([^.;]+)", 1), first))
        .otherwise(first)
    )


def score(n_shared: Column, predicate: Column, length: Column) -> Column:
    """Weight of an evidence row: words shared with the question, the predicate's rank, less for long values."""
    rank = F.when(predicate == "label", 1.5).when(predicate == "identifier", 1.25).when(predicate == "value", 1.0).when(predicate == "extract", 0.75).otherwise(0.25)
    return F.round(2.0 * n_shared + rank - F.when(length > 220, 0.5).otherwise(0.0), 4)


def ranked(evidence: DataFrame, most: int = 3) -> DataFrame:
    """Evidence (id, s, p, o, shared) with score and rank: highest first, then shortest, then by content."""
    scored = evidence.withColumn("score", score(F.col("shared"), F.col("p"), F.length("o"))).where("score > 0")
    return patterns.top_by(scored, most, "id", F.desc("score"), F.length("o"), F.col("o"), F.col("s"), F.col("p"))


def trim_surface(c: Column, limit: int = 220) -> Column:
    """An answer's last polish: white space as single spaces, no dangling marks, clipped."""
    t = F.regexp_replace(F.trim(F.regexp_replace(c, r"\s+", " ")), r"[\s,;:|-]+$", "")
    return F.when(F.length(t) > limit, F.concat(F.rtrim(F.substring(t, 1, limit)), F.lit("..."))).otherwise(t)


def rendered(questions: DataFrame, evidence: DataFrame, most: int = 3) -> DataFrame:
    """(id, mode, answer, n_values, status): for each question (id, text) its evidence's distinct values, best first.

    Without a value of its mode a question is refused, not answered.
    """
    q = questions.select("id", mode(F.col("text")).alias("mode"))
    r = ranked(evidence, most).join(q, "id")
    values = r.select("id", "rank", extracted(F.col("o"), F.col("mode")).alias("value")).where("value IS NOT NULL")
    once = patterns.first_by(values.withColumn("key", text.normalize(F.col("value"))), ["id", "key"], F.col("rank"))
    joined = once.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "value"))), lambda x: x["value"]), "; ").alias("a"), F.count("*").alias("n_values"))
    out = q.join(joined, "id", "left")
    return out.select("id", "mode", trim_surface(F.coalesce("a", F.lit(""))).alias("answer"), F.coalesce("n_values", F.lit(0)).alias("n_values"), F.when(F.col("a").isNull(), "refused").otherwise("answered").alias("status"))


def classified(results: DataFrame) -> DataFrame:
    """Results (id, precision, recall, n_rows, n_expected, overlap) with ``category``: why a question did well or not."""
    category = (
        F.when(F.col("n_expected") == 0, "no_expectation")
        .when(F.col("n_rows") == 0, "no_evidence")
        .when(F.col("recall") == 0, "wrong_entities")
        .when((F.col("recall") == 1) & (F.col("precision") >= 0.5), "ok")
        .when(F.col("recall") == 1, "too_broad")
        .when(F.col("overlap") >= 0.75, "ok_by_text")
        .otherwise("partial")
    )
    return results.withColumn("category", category)


def gate(results: DataFrame, group: str, least: float = 0.9) -> DataFrame:
    """(group, n, n_ok, share, passed): whether enough of each group's results are ok."""
    ok = F.col("category").isin("ok", "ok_by_text")
    agg = results.groupBy(group).agg(F.count("*").alias("n"), F.count_if(ok).alias("n_ok"))
    return agg.withColumn("share", F.round(F.col("n_ok") / F.col("n"), 4)).withColumn("passed", F.col("n_ok") >= least * F.col("n"))
