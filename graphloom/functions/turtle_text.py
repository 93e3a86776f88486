"""Repair of generated Turtle text, as Column expressions in a fixed order; what needs a state machine is one vectorised function."""

from __future__ import annotations

import re
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Prefixes that every text must declare (fixed values).
PREFIXES = {
    "ex": "http://example.org/graph#",
    "rdf": "http://www.w3.org/1999/02/22-rdf-syntax-ns#",
    "rdfs": "http://www.w3.org/2000/01/rdf-schema#",
    "xsd": "http://www.w3.org/2001/XMLSchema#",
}
#: Typographic marks and what they become (fixed values).
MARKS = {"“": '"', "”": '"', "„": '"', "’": "'", "‘": "'", "–": "-", "—": "-", " ": " "}


def fenced(c: Column) -> Column:
    """The text in the first code fence, or all of it without one."""
    inside = F.regexp_extract(c, r"(?s)```(?:turtle|ttl)?[ \t]*\n(.*?)```", 1)
    return F.regexp_replace(F.when(inside != "", inside).otherwise(c), r"^\s+|\s+$", "")


def with_prefixes(c: Column, prefixes: dict[str, str] = PREFIXES) -> Column:
    """The text with a declaration in front for each prefix it uses without declaring it."""
    parts = []
    for name, iri in prefixes.items():
        missing = c.rlike(rf"(?m)(^|[\s;,.(\[^]){name}:") & ~c.rlike(rf"(?mi)^\s*@?prefix\s+{name}:")
        parts.append(F.when(missing, f"@prefix {name}: <{iri}> .\n").otherwise(""))
    return F.concat(*parts, c)


def plain_marks(c: Column) -> Column:
    """Typographic quotes, dashes and spaces as plain ones."""
    return F.translate(c, "".join(MARKS), "".join(MARKS.values()))


def without_language_on(c: Column, predicate: str) -> Column:
    """Literals of a predicate lose their language tag."""
    return F.regexp_replace(c, rf'({predicate}\s+"(?:[^"\\]|\\.)*")@[A-Za-z-]+', "$1")


def valid_hex_types(c: Column) -> Column:
    """hexBinary on a literal that is no hexadecimal becomes string."""
    return F.regexp_replace(c, r'("(?!(?:[0-9A-Fa-f]{2})*")[^"\n]*")\^\^xsd:hexBinary', "$1^^xsd:string")


_NAME = re.compile(r"\bex:([^\s;,\[\]<>\"']+)")


def _inner_quotes(t: str) -> str:
    """Escape quotes inside short literals: a quote closes one only before white space and a mark, a tag or a type."""
    out, inside, i = [], False, 0
    while i < len(t):
        ch = t[i]
        if t.startswith('"""', i) and not inside:
            end = t.find('"""', i + 3)
            end = len(t) if end < 0 else end + 3
            out.append(t[i:end])
            i = end
            continue
        if ch == "\\" and inside:
            # a backslash that escapes nothing is one itself
            nxt = t[i + 1 : i + 2]
            out.append(t[i : i + 2] if nxt and nxt in "tnrbf\"'\\uU" else "\\\\" + nxt)
            i += 2
            continue
        if ch == '"':
            if not inside:
                inside = True
            elif re.match(r"\s*(?:[.;,\])]|@[A-Za-z]|\^\^|$)", t[i + 1 :]):
                inside = False
            else:
                out.append("\\")
        if ch == "\n" and inside:
            out.append("\\n")
        else:
            out.append(ch)
        i += 1
    return "".join(out)


def _name(m: re.Match) -> str:
    body, end = m[1], ""
    while body and (body[-1] == "." or body[-1] == ")" and body.count("(") < body.count(")")):  # these end a statement or a list
        body, end = body[:-1], body[-1] + end
    return "ex:" + re.sub(r"[^\w:%.-]+", "_", body).strip("_") + end


def _names(t: str) -> str:
    return _NAME.sub(_name, t)


def escaped_literals(c: Column) -> Column:
    """Quotes and backslashes inside literals escaped, and local names without marks that Turtle has no place for."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else _names(_inner_quotes(t)))

    return run(c)


#: Slips of generated vocabulary and what was meant, in this order (fixed values).
SLIPS = ((" a rdf:type ", " a "), (" rdf:type ", " a "), ("@xsd:string", "^^xsd:string"), ("@xsd:integer", "^^xsd:integer"), ("@xsd:decimal", "^^xsd:decimal"), ("@xsd:float", "^^xsd:float"), ("@xsd:double", "^^xsd:double"), (" a rdfs:label", " rdfs:label"))


def canonical_vocabulary(c: Column, renamed: tuple[tuple[str, str], ...] = ()) -> Column:
    """Slips of the type predicate, datatypes and labels put right, and names of a vocabulary that should be others."""
    return reduce(lambda x, r: F.replace(x, F.lit(r[0]), F.lit(r[1])), (*SLIPS, *renamed), c)


def unglued_properties(c: Column, properties: tuple[str, ...], classes: tuple[str, ...], default: str) -> Column:
    """'ex:<Name><property> "x"' as 'ex:<Name> a ex:<Class> ; ex:<property> "x"': the class is the first whose name the name begins with."""
    for p in properties:
        glued = rf'(?m)^(\s*)ex:(\w+?)(?i:{p})(\s+"[^"\n]*")'
        for k in classes:
            c = F.regexp_replace(c, rf'(?m)^(\s*)ex:({k}\w*?)(?i:{p})(\s+"[^"\n]*")', f"$1ex:$2 a ex:{k} ; ex:{p}$3")
        c = F.regexp_replace(c, glued, f"$1ex:$2 a ex:{default} ; ex:{p}$3")
    return c


def unbraced_blocks(c: Column) -> Column:
    """'ex:S a { a ex:C ; ... } .' as 'ex:S a ex:C ; ... .'"""
    return F.regexp_replace(c, r"(ex:\w+)\s+a\s*\{\s*a\s+(ex:\w+)\s*;?\s*([^{}]*?)\s*;?\s*\}\s*\.", "$1 a $2 ; $3 .")


def repaired(c: Column, untagged: tuple[str, ...] = ("ex:extract",)) -> Column:
    """All repairs in order; a text that is right already stays as it is, but for missing prefixes."""
    steps = [fenced, plain_marks, escaped_literals, valid_hex_types, *[lambda x, p=p: without_language_on(x, p) for p in untagged], with_prefixes]
    return reduce(lambda x, f: f(x), steps, c)


def mojibake_repaired(c: Column, rounds: int = 3) -> Column:
    """UTF-8 read as ISO Latin put right again, as often as it was done, while the result is valid."""
    for _ in range(rounds):
        back = F.encode(c, "ISO-8859-1")
        suspicious = c.rlike("[ÂÃ][\u0080-¿]") & ~c.rlike("[^\u0000-ÿ]")
        c = F.when(suspicious & F.is_valid_utf8(back.cast("string")), back.cast("string")).otherwise(c)
    return c
