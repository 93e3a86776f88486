"""The graph view of the star schema: entities, literals and links as (s, p, o, kind, lang)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = ("s", "p", "o", "kind", "lang")

#: (table, subject prefix, subject key, predicate, object prefix or None for a literal, object expression, language, distinct)
MAPPINGS = (
    ("region", "Region", "r_regionkey", "type", "", "'Region'", None),
    ("region", "Region", "r_regionkey", "label", None, "r_name", None),
    ("nation", "Nation", "n_nationkey", "type", "", "'Nation'", None),
    ("nation", "Nation", "n_nationkey", "label", None, "n_name", None),
    ("nation", "Nation", "n_nationkey", "inRegion", "Region_", "n_regionkey", None),
    ("customer", "Customer", "c_custkey", "type", "", "'Customer'", None),
    ("customer", "Customer", "c_custkey", "label", None, "c_name", None),
    ("customer", "Customer", "c_custkey", "inNation", "Nation_", "c_nationkey", None),
    ("customer", "Customer", "c_custkey", "segment", None, "c_mktsegment", None),
    ("supplier", "Supplier", "s_suppkey", "type", "", "'Supplier'", None),
    ("supplier", "Supplier", "s_suppkey", "label", None, "s_name", None),
    ("supplier", "Supplier", "s_suppkey", "inNation", "Nation_", "s_nationkey", None),
    ("part", "Part", "p_partkey", "type", "", "'Part'", None),
    ("part", "Part", "p_partkey", "label", None, "p_name", None),
    ("part", "Part", "p_partkey", "identifier", None, "p_brand", None),
    ("part", "Part", "p_partkey", "category", None, "p_type", None),
    ("orders", "Order", "o_orderkey", "type", "", "'Order'", None),
    ("orders", "Order", "o_orderkey", "placedBy", "Customer_", "o_custkey", None),
    ("orders", "Order", "o_orderkey", "status", None, "o_orderstatus", None),
    ("orders", "Order", "o_orderkey", "priority", None, "o_orderpriority", None),
    ("lineitem", "Order", "l_orderkey", "contains", "Part_", "l_partkey", None),
    ("lineitem", "Part", "l_partkey", "suppliedBy", "Supplier_", "l_suppkey", None),
    ("documents", "Document", "doc_id", "type", "", "'Document'", None),
    ("documents", "Document", "doc_id", "extract", None, "text", "lang"),
)

#: The small schema above the data: subclasses, domains, ranges, inverses and disjoint classes.
SUBCLASSES = (("Customer", "Party"), ("Supplier", "Party"), ("Party", "Agent"), ("Part", "Asset"), ("Asset", "Thing"), ("Agent", "Thing"), ("Order", "Record"), ("Document", "Record"), ("Record", "Thing"), ("Nation", "Place"), ("Region", "Place"), ("Place", "Thing"))
DOMAINS = (("inRegion", "Nation"), ("inNation", "Party"), ("segment", "Customer"), ("placedBy", "Order"), ("contains", "Order"), ("suppliedBy", "Part"), ("category", "Part"), ("extract", "Document"))
RANGES = (("inRegion", "Region"), ("inNation", "Nation"), ("placedBy", "Customer"), ("contains", "Part"), ("suppliedBy", "Supplier"))
INVERSES = (("placedBy", "places"), ("suppliedBy", "supplies"), ("inNation", "nationOf"))
DISJOINT = (("Asset", "Party"), ("Place", "Agent"), ("Record", "Asset"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def triples(spark: SparkSession, sf_dir: str, *predicates: str) -> DataFrame:
    """The triples of the given predicates (all by default). Only the columns they need are read."""
    parts, tables = [], {}
    for t, prefix, key, p, to, value, lang in MAPPINGS:
        if predicates and p not in predicates:
            continue
        if t not in tables:  # a table's files are listed once
            tables[t] = table(spark, sf_dir, t)
        o = F.expr(value)
        part = tables[t].select(
            F.concat(F.lit(f"{prefix}_"), F.col(key).cast("string")).alias("s"),
            F.lit(p).alias("p"),
            (o.cast("string") if to in (None, "") else F.concat(F.lit(to), o.cast("string"))).alias("o"),
            F.lit("literal" if to is None else "iri").alias("kind"),
            (F.col(lang) if lang else F.lit(None).cast("string")).alias("lang"),
        )
        parts.append(part.distinct() if t == "lineitem" else part)
    return reduce(DataFrame.unionByName, parts)


def whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All triples, with one scan a table: each row gives all that its table states. For what reads the whole graph;
    patterns with bound predicates are better off with ``triples``, which reads only their columns."""
    parts = []
    for t in dict.fromkeys(m[0] for m in MAPPINGS):
        said = []
        for _, prefix, key, p, to, value, lang in [m for m in MAPPINGS if m[0] == t]:
            o = F.expr(value).cast("string")
            said.append(F.struct(
                F.concat(F.lit(f"{prefix}_"), F.col(key).cast("string")).alias("s"), F.lit(p).alias("p"), (o if to in (None, "") else F.concat(F.lit(to), o)).alias("o"),
                F.lit("literal" if to is None else "iri").alias("kind"), (F.col(lang) if lang else F.lit(None).cast("string")).alias("lang"),
            ))
        part = table(spark, sf_dir, t).select(F.explode(F.array(*said)).alias("t")).select("t.*")
        parts.append(part.distinct() if t == "lineitem" else part)
    return reduce(DataFrame.unionByName, parts)


def triples_sql(*predicates: str) -> str:
    """The same view as SQL."""
    parts = []
    for t, prefix, key, p, to, value, lang in MAPPINGS:
        if predicates and p not in predicates:
            continue
        o = f"CAST({value} AS VARCHAR)" if to in (None, "") else f"'{to}' || CAST({value} AS VARCHAR)"
        kind = "literal" if to is None else "iri"
        distinct = "DISTINCT " if t == "lineitem" else ""
        parts.append(f"SELECT {distinct}'{prefix}_' || CAST({key} AS VARCHAR) AS s, '{p}' AS p, {o} AS o, '{kind}' AS kind, {lang or 'CAST(NULL AS VARCHAR)'} AS lang FROM {t}")
    return "\nUNION ALL\n".join(parts)


def relation(spark: SparkSession, rows: tuple[tuple, ...], *names: str) -> DataFrame:
    """A constant relation of strings, planned as a local relation."""
    values = ", ".join("(" + ", ".join(f"'{v}'" for v in r) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(names)})")


def relation_sql(rows: tuple[tuple, ...], *names: str) -> str:
    values = ", ".join("(" + ", ".join(f"'{v}'" for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {values}) AS t({', '.join(names)})"


def is_iri(c: str = "kind") -> Column:
    return F.col(c) == "iri"
