"""Surfaces of entities and terms: shape tests, keys, guesses, hashes of content, placeholders."""

from __future__ import annotations

import uuid
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text

#: Surfaces too general to name an entity (fixed values).
GENERIC = ("table", "figure", "section", "chapter", "page", "note", "value", "type", "name", "list", "item", "general", "other", "entity", "parameter", "function", "error", "system", "machine", "component")


def generic(c: Column) -> Column:
    """Whether a surface is missing, general, or a single word in lower case."""
    n = text.normalize(F.coalesce(c, F.lit("")))
    return (n == "") | n.isin(*GENERIC) | (~F.contains(n, F.lit(" ")) & (c == F.lower(c)))


def code_like(c: Column) -> Column:
    """Whether a surface is a code: capitals, digits and code marks only."""
    return c.rlike(r"^[A-Z0-9_#.\-\[\]=]+$")


def numeric_variant(c: Column) -> Column:
    """Whether a surface is two words or more of which the last is a number."""
    return text.normalize(c).rlike(r"^\S+( \S+)* [0-9]+$")


def should_match(c: Column) -> Column:
    """Whether a surface may be searched in questions: three characters, or a digit or mark among fewer."""
    return (F.length(c) >= 3) | c.rlike(r"[0-9\W]")


def boundary_pattern(c: Column) -> Column:
    """A pattern that finds the surface as a whole: escaped, with word boundaries where it starts and ends in letters or digits."""
    escaped = F.regexp_replace(c, r"([.\\+*?\[\](){}^$|])", r"\\$1")
    left = F.when(c.rlike("^[A-Za-z0-9]"), r"(?<![A-Za-z0-9])").otherwise("")
    right = F.when(c.rlike("[A-Za-z0-9]$"), r"(?![A-Za-z0-9])").otherwise("")
    return F.concat(F.lit("(?i)"), left, escaped, right)


def replaced(c: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    """Phrases replaced in the rules' order, whatever their case."""
    return reduce(lambda x, r: F.regexp_replace(x, f"(?i){r[0]}", r[1]), rules, c)


def signal_tokens(c: Column) -> Column:
    """Words in capitals, numbers of three digits or more, and words with digits; in order, once each."""
    words = F.split(c, r"[^\p{L}\p{N}]+")
    return F.array_distinct(F.filter(words, lambda w: w.rlike(r"^(?:[A-Z]{2,}[A-Z0-9]*|[0-9]{3,}|[A-Za-z]+[0-9][A-Za-z0-9]*)$")))


def identifier_shaped(c: Column) -> Column:
    return c.rlike(r"^[A-Za-z]+[_#.\-]?[0-9]+[A-Za-z0-9_.\-]*$") | c.rlike(r"^[A-Z][a-z]+(?:[A-Z][a-z0-9]+)+$")


def shared_keys(a: Column, b: Column) -> Column:
    """Compact keys of five characters or more that two arrays of surfaces share."""
    keys = lambda x: F.filter(F.transform(x, text.compact_key), lambda k: F.length(k) >= 5)
    return F.array_intersect(keys(a), keys(b))


def detected_language(scores: dict[str, Column], default: str) -> Column:
    """(language, confidence) of stop word scores: no evidence gives the default at 0.51; ties go to the default, then by name."""
    order = sorted(scores, key=lambda k: (k != default, k))
    total = reduce(lambda a, b: a + b, scores.values())
    best = F.greatest(*scores.values())
    second = F.element_at(F.sort_array(F.array(*scores.values()), asc=False), 2)
    lang = F.coalesce(*[F.when(scores[k] == best, k) for k in order])
    confidence = F.when(total == 0, 0.51).otherwise(F.round(F.least(F.lit(0.99), 0.55 + (best - second) / total * 0.4), 4))
    return F.struct(F.when(total == 0, default).otherwise(lang).alias("language"), confidence.cast("double").alias("confidence"))


def uuid_suffix(c: Column, n: int = 10) -> Column:
    """The first characters of the name-based UUID (version 5, URL space) of a value."""

    @F.pandas_udf("string")
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None else uuid.uuid5(uuid.NAMESPACE_URL, v).hex[:n])

    return run(c)


def content_hash(**fields: Column) -> Column:
    """Hash of fields as JSON with sorted names; null fields count as left out."""
    return F.sha2(F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)])), 256)


def slug(c: Column) -> Column:
    """A file name as a prefix for artifacts: lower case words joined by underscores, without the extension."""
    return F.regexp_replace(text.normalize(F.regexp_replace(c, r"\.[A-Za-z0-9]+$", "")), " ", "_")


def placeholder(id_: Column, reason: str) -> Column:
    """A Turtle record for a chunk that says nothing."""
    return F.format_string(f'@prefix ex: <http://example.org/graph#> .\nex:chunk_%s a ex:Chunk ; ex:note "{reason}" .', id_.cast("string"))


def any_surface(*columns: Column) -> Column:
    """Distinct non-empty surfaces of several columns, in order."""
    return F.array_distinct(F.filter(F.array(*columns), lambda x: x.isNotNull() & (F.trim(x) != "")))
