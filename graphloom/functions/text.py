"""Text functions as Column expressions: they stay in whole-stage code generation."""

from __future__ import annotations

import unicodedata
from functools import reduce
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F



def _folds() -> tuple[dict[str, str], dict[str, str]]:
    """What compatibility decomposition (NFKD) without marks makes of letters and letter-like signs, ligatures and
    full-width forms: of those that become one character, and of those that become several ASCII letters or digits."""
    one, more = {}, {}
    for ch in map(chr, chain(range(0x80, 0x2184), range(0xFB00, 0xFB07), range(0xFF01, 0xFF5F))):
        plain = "".join(x for x in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(x))
        if plain != ch and len(plain) == 1:
            one[ch] = plain
        elif plain != ch and plain.isascii() and plain.isalnum():
            more[ch] = plain
    return one, more


_ONE, _MORE = _folds()

#: Words too common to tell entities apart (fixed values).
STOPWORDS = ("the", "and", "for", "with", "that", "this", "from", "was", "are", "una", "los", "las", "del", "por", "para", "con", "que", "der", "die", "das", "und", "les", "des", "est", "qui", "dans")

#: Patterns of literals worth matching exactly (fixed values): emails, amounts with units, directive numbers, codes.
KEY_LITERALS = (
    r"[A-Za-z0-9._-]+@[A-Za-z0-9-]+\.[A-Za-z0-9.-]+",
    r"\b[0-9]+(?:[.,][0-9]+)? ?(?:mm|cm|kg|hz|v|bar)\b",
    r"\b[0-9]{4}/[0-9]{2}/[A-Z]{2}\b",
    r"\b[A-Z]{2,}[0-9]+\b",
    r"\b[0-9]{1,3}(?:\.[0-9]{1,3}){3}\b",
)

#: Stop words that tell languages apart (fixed values).
LANGUAGE_WORDS = {
    "de": ("der", "die", "das", "und", "ist", "nicht", "mit", "den", "von", "zu"),
    "en": ("the", "and", "of", "to", "is", "that", "with", "was", "for", "it"),
    "es": ("el", "los", "las", "del", "que", "una", "por", "con", "para", "se"),
    "fr": ("le", "les", "des", "et", "est", "une", "dans", "pour", "qui", "du"),
}


def folded(c: Column) -> Column:
    """Letters without their marks, compatibility forms as plain ones. Texts of ASCII alone are left as they are."""
    several = F.aggregate(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in _MORE.items()]), c, lambda t, m: F.replace(t, m["a"], m["b"]))
    split = F.when(c.rlike(f"[{''.join(_MORE)}]"), several).otherwise(c)
    plain = F.regexp_replace(F.translate(split, "".join(_ONE), "".join(_ONE.values())), r"\p{Mn}+", "")
    return F.when(c.rlike(r"[^\x00-\x7F]"), plain).otherwise(c)


def strip_accents(c: Column) -> Column:
    """Lower case without accents."""
    return folded(F.lower(c))


def normalize(c: Column, keep: str = "") -> Column:
    """Lower case, no accents, runs of other characters as one space, trimmed. ``keep``: characters that stay, as in a
    regular expression's class."""
    return F.trim(F.regexp_replace(strip_accents(c), f"[^a-z0-9{keep}]+", " "))


#: Marks that technical values keep (fixed values).
TECHNICAL = r"@/_\-."


def normalize_technical(c: Column) -> Column:
    """Normalised with the marks of addresses, codes and paths."""
    return normalize(c, TECHNICAL)


def phrases(c: Column, lengths: tuple[int, ...]) -> Column:
    """Runs of so many words of the normalised text, in order."""
    words = F.filter(F.split(normalize(c), " "), lambda x: x != "")

    def runs(w: Column, n: int) -> Column:
        if n == 1:
            return w
        return F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.array_join(F.slice(w, i, n), " "))).otherwise(F.array().cast("array<string>"))

    # the words as a variable, so that they are made once for all runs
    return F.element_at(F.transform(F.array(words), lambda w: F.concat(*[runs(w, n) for n in lengths])), 1)


def surface_variant(c: Column) -> Column:
    """A surface as lower-case words: changes of case part them, marks of other kinds too."""
    parted = F.regexp_replace(F.regexp_replace(folded(c), "([a-z0-9])([A-Z])", "$1 $2"), "([A-Z])([A-Z][a-z])", "$1 $2")
    return F.trim(F.lower(F.regexp_replace(parted, "[^A-Za-z0-9]+", " ")))


def variant_key(c: Column) -> Column:
    """The variant's words without spaces."""
    return F.replace(surface_variant(c), F.lit(" "), F.lit(""))


#: Words that tell parts of one thing apart: a surface with one isn't merged by its spelling (fixed values).
CONTEXT_WORDS = ("version", "v", "seccion", "section", "canal", "channel", "cabezal", "head", "indice", "index", "pagina", "page", "capitulo", "chapter")


def context_blocked(c: Column) -> Column:
    """Whether a surface names a part, version or number, so that a like spelling isn't the same thing."""
    return F.exists(F.split(surface_variant(c), " "), lambda w: w.isin(*CONTEXT_WORDS) | w.rlike(r"^(?:v?[0-9]+(?:\.[0-9]+)*)$"))


def compact_key(c: Column) -> Column:
    """The normalised text without spaces: equal for spelling variants of one surface."""
    return F.replace(normalize(c), F.lit(" "), F.lit(""))


def identifier(c: Column) -> Column:
    """Upper case without white space, hyphens and slashes."""
    return F.upper(F.regexp_replace(c, r"[\s\-/]+", ""))


def tokens(c: Column, least: int = 1) -> Column:
    """Words of the normalised text of at least so many characters."""
    return F.filter(F.split(normalize(c), " "), lambda x: F.length(x) >= least)


def significant_tokens(c: Column) -> Column:
    """Distinct words of three characters or more that are no stop words, in order."""
    return F.array_distinct(F.filter(tokens(c, 3), lambda x: ~x.isin(*STOPWORDS)))


def local_name(c: Column) -> Column:
    """What follows the last slash, then the last hash."""
    return F.substring_index(F.substring_index(c, "/", -1), "#", -1)


def humanize(c: Column) -> Column:
    """A local name as words: underscores and changes of case or to digits part them."""
    parted = F.regexp_replace(F.regexp_replace(c, "_+", " "), "([a-z])([A-Z0-9])", "$1 $2")
    return F.trim(F.regexp_replace(parted, " +", " "))


def short_hash(c: Column, n: int = 10) -> Column:
    return F.substring(F.sha2(c, 256), 1, n)


def camel_case(c: Column) -> Column:
    """PascalCase of the normalised words; a leading digit gets the prefix Entity."""
    joined = F.array_join(F.transform(F.split(normalize(c), " "), lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1_000_000))), "")
    return F.when(joined.rlike("^[0-9]"), F.concat(F.lit("Entity"), joined)).otherwise(joined)


def key_literals(c: Column) -> Column:
    """Distinct key literals, lower case, in order of pattern and place."""
    found = [F.regexp_extract_all(c, F.lit(p), F.lit(0)) for p in KEY_LITERALS]
    return F.array_distinct(F.transform(F.concat(*found), lambda x: F.lower(x)))


def fragments(c: Column, low: int = 8, high: int = 220) -> Column:
    """Distinct trimmed sentences and clauses between the given lengths."""
    parts = F.transform(F.split(c, r"[\n;|.!?]+"), lambda x: F.trim(x))
    return F.array_distinct(F.filter(parts, lambda x: F.length(x).between(low, high)))


def hits(words: Column, vocabulary: tuple[str, ...]) -> Column:
    return F.size(F.filter(words, lambda w: w.isin(*vocabulary)))


def language_scores(c: Column) -> dict[str, Column]:
    """Stop word hits for each language."""
    words = F.split(F.lower(c), r"[\s.,!?]+")
    return {lang: hits(words, vocabulary) for lang, vocabulary in LANGUAGE_WORDS.items()}


def any_contains(c: Column, needles: list[str]) -> Column:
    """Whether the lower-cased text contains any of the needles."""
    return reduce(lambda a, b: a | b, [F.contains(F.lower(c), F.lit(n.lower())) for n in needles])


def structured_identifier_score(c: Column) -> Column:
    """How much a value looks like an identifier: a directive's number, a code, digits with marks, short with a digit, else 0 (also of null)."""
    v = F.trim(c)
    return (
        F.when(v.rlike(r"(?i)[0-9]{4}/[0-9]{2}/[A-Z]{2}"), 1.0)
        .when(v.rlike(r"[A-Z]{1,6}-?[0-9]{1,6}"), 0.85)
        .when(v.rlike("[0-9]") & v.rlike("[-/]"), 0.75)
        .when((F.length(v) <= 24) & v.rlike("[0-9]"), 0.55)
        .otherwise(0.0)
    )


def identifier_penalty(c: Column) -> Column:
    """How much a name reads like an identifier instead of words: mixed case, else an underscore or a digit."""
    name = local_name(c)
    return F.when(name.rlike("[A-Z][a-z]+[A-Z][A-Za-z0-9]+"), 0.35).when(name.rlike("[_0-9]"), 0.2).otherwise(0.0)


def token_overlap(a: Column, b: Column) -> Column:
    """Shared words over the words of the first."""
    return F.when(F.size(a) > 0, F.size(F.array_intersect(a, b)) / F.size(a)).otherwise(0.0)
