"""Turtle and N-Triples: a parser over columns and files, and a writer.

``parse`` handles the part of Turtle that data files use: prefixes and base, IRIs, prefixed names, ``a``,
literals in short and long quotes with language or datatype, numbers and booleans, predicate and object
lists, blank nodes with labels and in brackets, collections, comments. A text that does not parse gives one
row with an error and no triples, so that a bad file is counted and never stops a scan.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
XSD = "http://www.w3.org/2001/XMLSchema#"
SCHEMA = "source string, s string, s_kind string, p string, o string, o_kind string, o_datatype string, o_lang string, error string"

_TOKEN = re.compile(
    r"""(?P<space>\s+|\#[^\n]*)
    |(?P<iri><[^<>"{}|^`\\\x00-\x20]*>)
    |(?P<long>\"\"\"(?:[^"\\]|\\.|"(?!""))*\"\"\"|'''(?:[^'\\]|\\.|'(?!''))*''')
    |(?P<short>"(?:[^"\\\n\r]|\\.)*"|'(?:[^'\\\n\r]|\\.)*')
    |(?P<prefix>@prefix\b|@base\b|PREFIX\b|BASE\b)
    |(?P<lang>@[A-Za-z]+(?:-[A-Za-z0-9]+)*)
    |(?P<mark>\^\^|[;,.\[\]()])
    |(?P<blank>_:[A-Za-z0-9_][A-Za-z0-9_.\-]*(?<!\.))
    |(?P<number>[+-]?(?:[0-9]+\.[0-9]*[eE][+-]?[0-9]+|[0-9]+[eE][+-]?[0-9]+|[0-9]*\.[0-9]+|[0-9]+)(?![A-Za-z_]))
    |(?P<name>[^\W\d_]?[\w\-.]*:(?:[\w\-:%]|\.(?=[\w\-:%.])|\\.)*|[a-z]+)""",
    re.VERBOSE,
)
_ESCAPE = re.compile(r"\\(u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8}|.)", re.S)
_PLAIN = {"t": "\t", "n": "\n", "r": "\r", "b": "\b", "f": "\f"}


def _unescape(s: str) -> str:
    return _ESCAPE.sub(lambda m: chr(int(m[1][1:], 16)) if m[1][0] in "uU" and len(m[1]) > 1 else _PLAIN.get(m[1], m[1]), s)


class _Parser:
    def __init__(self, text: str):
        self.text, self.out = text, []
        self.prefixes: dict[str, str] = {}
        self.base = ""
        self.fresh = 0
        self.tokens = list(self._scan(text))
        self.at = 0

    @staticmethod
    def _scan(text: str) -> Iterator[tuple[str, str, int]]:
        at = 0
        while at < len(text):
            m = _TOKEN.match(text, at)
            if not m or m.end() == at:
                raise ValueError(f"unexpected {text[at : at + 20]!r} at {at}")
            if m.lastgroup != "space":
                yield m.lastgroup, m[0], at
            at = m.end()

    def peek(self, i: int = 0) -> tuple[str, str, int]:
        return self.tokens[self.at + i] if self.at + i < len(self.tokens) else ("end", "", len(self.text))

    def take(self, value: str | None = None) -> tuple[str, str, int]:
        t = self.peek()
        if t[0] == "end" or value is not None and t[1] != value:
            raise ValueError(f"expected {value or 'a term'}, found {t[1] or 'the end'!r} at {t[2]}")
        self.at += 1
        return t

    def blank(self) -> tuple[str, str, None, None]:
        self.fresh += 1
        return f"_:b{self.fresh}", "bnode", None, None

    def resolve(self, kind: str, value: str) -> str:
        if kind == "iri":
            iri = _unescape(value[1:-1])
            return iri if re.match(r"[A-Za-z][\w+.-]*:", iri) else self.base + iri
        prefix, colon, local = value.partition(":")
        if not colon or prefix not in self.prefixes:
            raise ValueError(f"unknown name {value!r}")
        return self.prefixes[prefix] + re.sub(r"\\(.)", r"\1", local)

    def term(self) -> tuple[str, str, str | None, str | None]:
        kind, value, _ = self.take()
        if kind in ("short", "long"):
            n = 1 if kind == "short" else 3
            text = _unescape(value[n:-n])
            if self.peek()[0] == "lang":
                return text, "literal", None, self.take()[1][1:]
            if self.peek()[1] == "^^":
                self.take()
                k, v, _ = self.take()
                return text, "literal", self.resolve(k, v), None
            return text, "literal", None, None
        if kind == "number":
            which = "double" if "e" in value.lower() else "decimal" if "." in value else "integer"
            return value, "literal", XSD + which, None
        if kind == "name" and value in ("true", "false"):
            return value, "literal", XSD + "boolean", None
        if kind in ("iri", "name"):
            return self.resolve(kind, value), "iri", None, None
        if kind == "blank":
            return value, "bnode", None, None
        if value == "[":
            node = self.blank()
            if self.peek()[1] != "]":
                self.properties(node)
            self.take("]")
            return node
        if value == "(":
            items = []
            while self.peek()[1] != ")":
                items.append(self.term())
            self.take(")")
            rest = (RDF + "nil", "iri", None, None)
            for item in reversed(items):
                node = self.blank()
                self.out += [(node, RDF + "first", item), (node, RDF + "rest", rest)]
                rest = node
            return rest
        raise ValueError(f"unexpected {value!r}")

    def properties(self, subject) -> None:
        while True:
            kind, value, at = self.take()
            if kind == "name" and value == "a":
                p = RDF + "type"
            elif kind in ("iri", "name"):
                p = self.resolve(kind, value)
            else:
                raise ValueError(f"no predicate at {at}")
            while True:
                self.out.append((subject, p, self.term()))
                if self.peek()[1] != ",":
                    break
                self.take()
            while self.peek()[1] == ";":
                self.take()
            if self.peek()[1] in (".", "]") or self.peek()[0] == "end" or self.tokens[self.at - 1][1] != ";":
                return

    def parse(self) -> list:
        while self.peek()[0] != "end":
            kind, value, _ = self.peek()
            if kind == "prefix":
                self.take()
                if value.lower().endswith("prefix"):
                    name = self.take()[1]
                    k, v, _ = self.take()
                    self.prefixes[name.rstrip(":")] = self.resolve(k, v)
                else:
                    k, v, _ = self.take()
                    self.base = self.resolve(k, v)
                if value[0] == "@":
                    self.take(".")
                continue
            bracketed = value == "["
            subject = self.term()
            if subject[1] == "literal":
                raise ValueError(f"a literal is no subject: {subject[0][:40]!r}")
            if not (bracketed and self.peek()[1] == "."):
                self.properties(subject)
            self.take(".")
        return self.out


def parse_text(text: str) -> tuple[list[tuple], str | None]:
    """Triples ((s, kind, -, -), p, (o, kind, datatype, lang)) in order, without repeats, and an error or None."""
    try:
        return list(dict.fromkeys(_Parser(text or "").parse())), None
    except ValueError as e:
        return [], str(e)


def parse(texts: DataFrame, source: str = "source", text: str = "text") -> DataFrame:
    """Triples of Turtle texts, by source; one row with ``error`` for a text that doesn't parse. Blank nodes are named by source."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split(" ")[0] for f in SCHEMA.split(", ")]
        for batch in batches:
            rows = []
            for src, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found, error = parse_text(t)
                own = lambda x, src=src: f"_:{src}#{x[0][2:]}" if x[1] == "bnode" else x[0]
                rows += [(src, own(s), s[1], p, own(o), o[1], o[2], o[3], None) for s, p, o in found]
                if error:
                    rows.append((src, None, None, None, None, None, None, None, error))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(9)], names=names)

    return texts.select(F.col(source).cast("string"), text).mapInArrow(run, SCHEMA)


def read(spark: SparkSession, *paths: str) -> DataFrame:
    """Triples of Turtle files, each file one source; files are spread over the executors."""
    files = spark.read.format("binaryFile").load(list(paths))
    return parse(files.select(F.col("path").alias("source"), F.decode("content", "UTF-8").alias("text")))


def escaped(c: Column) -> Column:
    """A literal's content as it stands between quotes."""
    for raw, safe in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r")):
        c = F.replace(c, F.lit(raw), F.lit(safe))
    return c


def lines(triples: DataFrame) -> DataFrame:
    """N-Triples lines (column value) of triples as ``parse`` gives them."""
    node = lambda c, kind: F.when(F.col(kind) == "bnode", F.concat(F.lit("_:n"), F.md5(c))).otherwise(F.concat(F.lit("<"), c, F.lit(">")))
    quoted = F.concat(F.lit('"'), escaped(F.col("o")), F.lit('"'))
    literal = F.when(F.col("o_lang").isNotNull(), F.concat(quoted, F.lit("@"), F.col("o_lang"))).when(F.col("o_datatype").isNotNull(), F.concat(quoted, F.lit("^^<"), F.col("o_datatype"), F.lit(">"))).otherwise(quoted)
    o = F.when(F.col("o_kind") == "literal", literal).otherwise(node(F.col("o"), "o_kind"))
    return triples.where("error IS NULL").select(F.concat(node(F.col("s"), "s_kind"), F.lit(" <"), F.col("p"), F.lit("> "), o, F.lit(" .")).alias("value")).distinct()


def write(triples: DataFrame, path: str) -> None:
    lines(triples).write.mode("overwrite").text(path)
