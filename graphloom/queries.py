"""Registry of the core queries: each as a Spark callable and, where SQL can express it, as DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import similarity, text
from .operators import evaluate, ingest, ontology, patterns, resolve, retrieve, validate
from .plans import triples as T
from .plans.triples import relation, relation_sql, table, triples, triples_sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def view(*predicates: str) -> str:
    return f"WITH RECURSIVE t AS ({triples_sql(*predicates)})"


CLOSURE_SQL = f"""edges AS ({relation_sql(T.SUBCLASSES, "child", "parent")}),
up AS (SELECT child, parent AS ancestor FROM edges UNION SELECT up.child, e.parent FROM up JOIN edges e ON e.child = up.ancestor),
refl AS (SELECT * FROM up UNION SELECT child, child FROM edges UNION SELECT parent, parent FROM edges),
types AS (SELECT DISTINCT s, o AS class FROM t WHERE p = 'type')"""
LINKS_SQL = "links AS (SELECT * FROM t WHERE kind = 'iri' AND p <> 'type')"


def subclasses(spark: SparkSession) -> DataFrame:
    return relation(spark, T.SUBCLASSES, "child", "parent")


def seeds(spark: SparkSession, *names: str) -> DataFrame:
    return relation(spark, tuple((n,) for n in names), "node")


def norm_sql(c: str) -> str:
    return f"trim(regexp_replace(strip_accents(lower({c})), '[^a-z0-9]+', ' ', 'g'))"


def tokens_sql(c: str, least: int) -> str:
    return f"list_filter(string_split({norm_sql(c)}, ' '), lambda x: length(x) >= {least})"


def words_sql(ws: tuple[str, ...]) -> str:
    return ", ".join(f"'{w}'" for w in ws)


# ---------------------------------------------------------------- patterns


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of a region, with label, nation and segment."""
    nations = patterns.traverse(triples(spark, sf_dir, "inRegion"), seeds(spark, "Region_1"), "inRegion", incoming=True)
    reached = patterns.traverse(triples(spark, sf_dir, "inNation"), nations, "inNation", incoming=True)
    customers = patterns.match(triples(spark, sf_dir, "type"), p="type", o="Customer").select("s")
    about = triples(spark, sf_dir, "label", "inNation", "segment").join(reached.join(customers, F.col("node") == F.col("s")).select("node"), F.col("s") == F.col("node"))
    return patterns.star(about, label="label", nation="inNation", segment="segment")


@query(view("inRegion", "inNation", "label", "segment", "type") + """,
c AS (SELECT a.s FROM t a JOIN t b ON a.o = b.s AND b.p = 'inRegion' AND b.o = 'Region_1' JOIN t k ON k.s = a.s AND k.p = 'type' AND k.o = 'Customer' WHERE a.p = 'inNation')
SELECT s, min(CASE WHEN p = 'label' THEN o END) AS label, min(CASE WHEN p = 'inNation' THEN o END) AS nation,
       min(CASE WHEN p = 'segment' THEN o END) AS segment FROM t WHERE s IN (SELECT s FROM c) GROUP BY s""")
def kg_region_customers(spark, sf_dir):
    return entry(spark, sf_dir)


@query(view() + " SELECT p, count(*) AS n, count(DISTINCT s) AS n_subjects FROM t GROUP BY p")
def kg_triples_count_by_predicate(spark, sf_dir):
    return T.whole(spark, sf_dir).groupBy("p").agg(F.count("*").alias("n"), F.count_distinct("s").alias("n_subjects"))


@query(view("inRegion") + " SELECT s, o FROM t")
def kg_pattern_bound_predicate(spark, sf_dir):
    return patterns.match(triples(spark, sf_dir), p="inRegion").select("s", "o")


@query(view("type", "label", "inRegion") + " SELECT p, o FROM t WHERE s = 'Nation_3'")
def kg_pattern_bound_subject(spark, sf_dir):
    return patterns.match(triples(spark, sf_dir, "type", "label", "inRegion"), s="Nation_3").select("p", "o")


@query(view("inNation") + " SELECT s, p FROM t WHERE o = 'Nation_7'")
def kg_pattern_bound_object(spark, sf_dir):
    return patterns.match(triples(spark, sf_dir, "inNation"), o="Nation_7").select("s", "p")


@query(view("label", "identifier", "category") + """ SELECT s, min(CASE WHEN p = 'label' THEN o END) AS label,
 min(CASE WHEN p = 'identifier' THEN o END) AS identifier, min(CASE WHEN p = 'category' THEN o END) AS category FROM t GROUP BY s""")
def kg_star_describe(spark, sf_dir):
    return patterns.star(triples(spark, sf_dir, "label", "identifier", "category"), label="label", identifier="identifier", category="category")


@query(view("contains", "type") + " SELECT s, min(o) AS first_part, count(*) AS n FROM t WHERE p = 'contains' GROUP BY s")
def kg_scalar_lookup(spark, sf_dir):
    return patterns.match(triples(spark, sf_dir, "contains"), p="contains").groupBy("s").agg(F.min("o").alias("first_part"), F.count("*").alias("n"))


@query(view("placedBy", "type") + " SELECT s FROM t WHERE p = 'type' AND o = 'Customer' AND s NOT IN (SELECT o FROM t WHERE p = 'placedBy')")
def kg_membership_anti(spark, sf_dir):
    t = triples(spark, sf_dir, "placedBy", "type")
    placed = patterns.match(t, p="placedBy").select(F.col("o").alias("s"))
    return patterns.match(t, p="type", o="Customer").join(placed, "s", "left_anti").select("s")


@query(view("inNation", "label") + " SELECT a.s, b.o AS nation FROM t a JOIN t b ON a.o = b.s AND b.p = 'label' WHERE a.p = 'inNation'")
def kg_bgp_join(spark, sf_dir):
    t = triples(spark, sf_dir, "inNation", "label")
    b = patterns.match(t, p="label").select(F.col("s").alias("o"), F.col("o").alias("nation"))
    return patterns.match(t, p="inNation").join(b, "o").select("s", "nation")


@query(view("type", "placedBy") + """ SELECT a.s, count(b.s) AS n_orders FROM t a LEFT JOIN t b ON b.o = a.s AND b.p = 'placedBy'
 WHERE a.p = 'type' AND a.o = 'Customer' GROUP BY a.s""")
def kg_optional_orders(spark, sf_dir):
    t = triples(spark, sf_dir, "type", "placedBy")
    n = patterns.match(t, p="placedBy").groupBy(F.col("o").alias("s")).agg(F.count("*").alias("n"))
    return patterns.match(t, p="type", o="Customer").join(n, "s", "left").select("s", F.coalesce("n", F.lit(0)).alias("n_orders"))


@query(view("type", "label", "extract", "status") + """ SELECT k.s, coalesce(a.o, b.o, 'none') AS surface FROM t k LEFT JOIN t a ON a.s = k.s AND a.p = 'label'
 LEFT JOIN t b ON b.s = k.s AND b.p = 'status' WHERE k.p = 'type' AND k.o <> 'Document'""")
def kg_optional_coalesce(spark, sf_dir):
    t = triples(spark, sf_dir, "type", "label", "status")
    first = patterns.match(t, p="label").select("s", F.col("o").alias("a"))
    second = patterns.match(t, p="status").select("s", F.col("o").alias("b"))
    base = patterns.match(t, p="type").where("o <> 'Document'").select("s")
    return base.join(first, "s", "left").join(second, "s", "left").select("s", F.coalesce("a", "b", F.lit("none")).alias("surface"))


@query(view("label", "inRegion", "type") + " SELECT DISTINCT s, p, o FROM t WHERE s IN ('Nation_1', 'Nation_5', 'Region_2') AND p IN ('label', 'inRegion')")
def kg_values_seed_describe(spark, sf_dir):
    return patterns.describe(triples(spark, sf_dir, "label", "inRegion", "type"), seeds(spark, "Nation_1", "Nation_5", "Region_2"), ["label", "inRegion"])


@query(view("contains") + " SELECT DISTINCT o AS node FROM t WHERE s IN ('Order_1', 'Order_2', 'Order_3')")
def kg_traverse_out(spark, sf_dir):
    return patterns.traverse(triples(spark, sf_dir, "contains"), seeds(spark, "Order_1", "Order_2", "Order_3"), "contains")


@query(view("inNation") + " SELECT DISTINCT s AS node FROM t WHERE o = 'Nation_2'")
def kg_traverse_in(spark, sf_dir):
    return patterns.traverse(triples(spark, sf_dir, "inNation"), seeds(spark, "Nation_2"), "inNation", incoming=True)


@query(view("placedBy", "contains") + """ SELECT DISTINCT b.o AS node FROM t a JOIN t b ON b.s = a.s AND b.p = 'contains'
 WHERE a.p = 'placedBy' AND a.o IN ('Customer_1', 'Customer_2')""")
def kg_two_hop_chain(spark, sf_dir):
    t = triples(spark, sf_dir, "placedBy", "contains")
    orders = patterns.traverse(t, seeds(spark, "Customer_1", "Customer_2"), "placedBy", incoming=True)
    return patterns.traverse(t, orders, "contains")


@query(view("label") + " SELECT s, o FROM t WHERE contains(lower(o), 'an')")
def kg_contains_filter(spark, sf_dir):
    return triples(spark, sf_dir, "label").where(text.any_contains(F.col("o"), ["an"])).select("s", "o")


@query(view("label", "category") + " SELECT s, p, o FROM t WHERE contains(lower(o), 'steel') OR contains(lower(o), 'brass') OR contains(lower(s), 'region')")
def kg_disjunctive_contains(spark, sf_dir):
    t = triples(spark, sf_dir, "label", "category")
    return t.where(text.any_contains(F.col("o"), ["steel", "brass"]) | text.any_contains(F.col("s"), ["region"])).select("s", "p", "o")


@query(view("label") + " SELECT s, o FROM t WHERE regexp_matches(lower(o), 'asia|eur|000[1-4]')")
def kg_regex_filter(spark, sf_dir):
    return triples(spark, sf_dir, "label").where(F.col("o").rlike("(?i)asia|eur|000[1-4]")).select("s", "o")


@query(view("extract") + " SELECT lang, count(*) AS n, max(length(o)) AS longest FROM t WHERE lang IN ('es', 'fr') AND length(o) > 3 GROUP BY lang")
def kg_lang_filter(spark, sf_dir):
    t = triples(spark, sf_dir, "extract")
    return t.where(F.col("lang").isin("es", "fr") & (F.length("o") > 3)).groupBy("lang").agg(F.count("*").alias("n"), F.max(F.length("o")).cast("long").alias("longest"))


@query(view("placedBy") + " SELECT count(*) > 0 AS answer FROM t WHERE o = 'Customer_1'")
def kg_ask(spark, sf_dir):
    return patterns.match(triples(spark, sf_dir, "placedBy"), o="Customer_1").agg((F.count("*") > 0).alias("answer"))


@query(view() + " SELECT count(*) AS n FROM t")
def kg_count(spark, sf_dir):
    return T.whole(spark, sf_dir).agg(F.count("*").alias("n"))


@query(view() + " SELECT p, count(*) AS n FROM t GROUP BY p ORDER BY n DESC, p LIMIT 5")
def kg_topk_predicates(spark, sf_dir):
    return triples(spark, sf_dir).groupBy("p").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "p").limit(5)


@query(view("label", "inNation", "type") + " SELECT DISTINCT s, p, o FROM t WHERE p = 'label' OR o = 'Nation_1' UNION SELECT s, p, o FROM t WHERE p = 'type' AND o IN ('Customer', 'Region')")
def kg_union_distinct(spark, sf_dir):
    t = triples(spark, sf_dir, "label", "inNation", "type").select("s", "p", "o")
    return patterns.union(t.where("p = 'label' OR o = 'Nation_1'"), t.where("p = 'type' AND o IN ('Customer', 'Region')"))


@query(view("type") + f" SELECT c AS class FROM (SELECT child AS c FROM ({relation_sql(T.SUBCLASSES, 'child', 'parent')}) UNION SELECT parent FROM ({relation_sql(T.SUBCLASSES, 'child', 'parent')})) EXCEPT SELECT o FROM t")
def kg_except_unused_classes(spark, sf_dir):
    declared = subclasses(spark).select("child").union(subclasses(spark).select("parent")).toDF("class")
    return declared.subtract(triples(spark, sf_dir, "type").select("o"))


@query(view("contains", "suppliedBy") + " SELECT o AS node FROM t WHERE p = 'contains' INTERSECT SELECT s FROM t WHERE p = 'suppliedBy'")
def kg_intersect_nodes(spark, sf_dir):
    t = triples(spark, sf_dir, "contains", "suppliedBy")
    return t.where("p = 'contains'").select(F.col("o").alias("node")).intersect(t.where("p = 'suppliedBy'").select("s"))


@query(view("inRegion", "label") + """ SELECT s, p, o FROM t WHERE NOT (p = 'inRegion' AND o = 'Region_0') AND p = 'inRegion' UNION SELECT 'Nation_900', 'inRegion', 'Region_0'
 UNION SELECT s, p, o FROM t WHERE p = 'label' AND s LIKE 'Region%'""")
def kg_delete_insert(spark, sf_dir):
    t = triples(spark, sf_dir, "inRegion", "label").where("p = 'inRegion' OR s LIKE 'Region%'").select("s", "p", "o")
    left = patterns.without(t, patterns.match(t, p="inRegion", o="Region_0"))
    return patterns.union(left, relation(spark, (("Nation_900", "inRegion", "Region_0"), ("Nation_900", "inRegion", "Region_0")), "s", "p", "o"))


@query(view("suppliedBy") + " SELECT s, count(DISTINCT o) AS n FROM t GROUP BY s HAVING count(DISTINCT o) > 3")
def kg_distinct_count_having(spark, sf_dir):
    return triples(spark, sf_dir, "suppliedBy").groupBy("s").agg(F.count_distinct("o").alias("n")).where("n > 3")


@query("SELECT o_orderpriority AS priority, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS n_finished, round(avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END), 4) AS share FROM orders GROUP BY 1")
def kg_conditional_count_mean(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    f = F.col("o_orderstatus") == "F"
    return o.groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count("*").alias("n"), F.count_if(f).alias("n_finished"), F.round(F.avg(f.cast("double")), 4).alias("share"))


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r = 1")
def kg_argmax_first(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return patterns.first_by(o, "o_custkey", F.desc("o_totalprice"), F.col("o_orderkey")).select("o_custkey", "o_orderkey")


@query(f"SELECT doc_id, len(list_distinct({tokens_sql('text', 3)})) AS n_distinct FROM documents")
def kg_ordered_dedup(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.size(F.array_distinct(text.tokens(F.col("text"), 3))).cast("long").alias("n_distinct"))


@query(view("inNation", "placedBy", "type") + f""", {LINKS_SQL}, k AS (SELECT s, o AS class FROM t WHERE p = 'type')
 SELECT l.p, a.class AS source, b.class AS target, count(*) AS n FROM links l JOIN k a ON a.s = l.s JOIN k b ON b.s = l.o GROUP BY 1, 2, 3""")
def kg_typed_endpoints(spark, sf_dir):
    t = triples(spark, sf_dir, "inNation", "placedBy", "type")
    return ontology.endpoint_pairs(t, ontology.types_of(t))


@query("SELECT what, value, count(*) AS n FROM (SELECT unnest(['priority', 'status']) AS what, unnest([o_orderpriority, o_orderstatus]) AS value FROM orders) GROUP BY 1, 2")
def kg_unpivot(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"))
    return o.unpivot([], ["priority", "status"], "what", "value").groupBy("what", "value").agg(F.count("*").alias("n"))


@query(view("inNation", "inRegion") + f""", {LINKS_SQL} SELECT node, CAST(sum(i) AS BIGINT) AS in_degree, CAST(sum(x) AS BIGINT) AS out_degree FROM
 (SELECT s AS node, 0 AS i, 1 AS x FROM links UNION ALL SELECT o, 1, 0 FROM links) GROUP BY node""")
def kg_degrees(spark, sf_dir):
    return patterns.degrees(triples(spark, sf_dir, "inNation", "inRegion"))


# ---------------------------------------------------------------- ontology


@query(f"WITH RECURSIVE t AS ({triples_sql('type')}), {CLOSURE_SQL} SELECT child, ancestor FROM up")
def onto_subclass_closure(spark, sf_dir):
    return ontology.closure(subclasses(spark))


EXTRA_TYPES = (("Part_1", "Thing"), ("Part_1", "Asset"), ("Customer_1", "Agent"), ("Customer_2", "Asset"), ("Supplier_1", "Document"))
EXTRA_SQL = f"t AS ({triples_sql('type', 'inNation', 'placedBy', 'contains', 'suppliedBy')} UNION ALL SELECT s, 'type', o, 'iri', NULL FROM ({relation_sql(EXTRA_TYPES, 's', 'o')}))"


def extended(spark, sf_dir, *predicates):
    """The view with some types stated besides."""
    more = relation(spark, EXTRA_TYPES, "s", "o").select("s", F.lit("type").alias("p"), "o", F.lit("iri").alias("kind"), F.lit(None).cast("string").alias("lang"))
    return triples(spark, sf_dir, "type", *predicates).unionByName(more)


@query(f"WITH RECURSIVE {EXTRA_SQL}, {CLOSURE_SQL} SELECT DISTINCT a.s, a.class FROM types a JOIN types b ON a.s = b.s JOIN up ON up.child = b.class AND up.ancestor = a.class")
def onto_redundant_types(spark, sf_dir):
    t = extended(spark, sf_dir)
    return ontology.redundant_types(ontology.types_of(t), ontology.closure(subclasses(spark)))


@query(f"""WITH t AS ({triples_sql('segment', 'category', 'placedBy', 'contains')}), dom AS ({relation_sql(T.DOMAINS, 'property', 'class')})
SELECT s, min(class) AS class FROM (SELECT DISTINCT t.s, dom.class FROM t JOIN dom ON t.p = dom.property) GROUP BY s HAVING count(DISTINCT class) = 1""")
def onto_infer_types_by_domain(spark, sf_dir):
    return ontology.infer_types(triples(spark, sf_dir, "segment", "category", "placedBy", "contains"), relation(spark, T.DOMAINS, "property", "class"))


@query(f"""WITH RECURSIVE {EXTRA_SQL}, {CLOSURE_SQL}, want AS (SELECT * FROM (VALUES ('inNation', 'Customer'), ('contains', 'Order')) v(property, class))
SELECT w.property, count(*) AS n FROM t JOIN want w ON t.p = w.property WHERE t.s IN (SELECT s FROM types)
 AND NOT EXISTS (SELECT 1 FROM types k JOIN refl r ON r.child = k.class WHERE k.s = t.s AND r.ancestor = w.class) GROUP BY 1""")
def onto_domain_violations(spark, sf_dir):
    t = extended(spark, sf_dir, "inNation", "placedBy", "contains", "suppliedBy")
    want = relation(spark, (("inNation", "Customer"), ("contains", "Order")), "property", "class")
    return ontology.violations(t, ontology.types_of(t), ontology.closure(subclasses(spark)), want, "s")


@query(view("placedBy", "suppliedBy", "inNation") + f""", inv AS ({relation_sql(T.INVERSES, 'property', 'inverse')}), c AS (SELECT p, count(*) AS n FROM t GROUP BY p)
SELECT property, inverse, coalesce(a.n, 0) AS n, coalesce(b.n, 0) AS n_inverse FROM inv LEFT JOIN c a ON a.p = property LEFT JOIN c b ON b.p = inverse""")
def onto_inverse_asymmetry(spark, sf_dir):
    return ontology.inverse_counts(triples(spark, sf_dir, "placedBy", "suppliedBy", "inNation"), relation(spark, T.INVERSES, "property", "inverse"))


@query(view("placedBy", "inNation") + f""", inv AS ({relation_sql(T.INVERSES, 'property', 'inverse')})
SELECT DISTINCT t.o AS s, inv.inverse AS p, t.s AS o FROM t JOIN inv ON t.p = inv.property""")
def onto_materialize_inverses(spark, sf_dir):
    return ontology.materialize_inverses(triples(spark, sf_dir, "placedBy", "inNation"), relation(spark, T.INVERSES, "property", "inverse"))


@query(view("type", "inNation", "contains", "suppliedBy") + f""", {LINKS_SQL}, k AS (SELECT s, o AS class FROM t WHERE p = 'type'),
e AS (SELECT l.p, unnest(['domain', 'range']) AS side, unnest([a.class, b.class]) AS class FROM links l JOIN k a ON a.s = l.s JOIN k b ON b.s = l.o),
c AS (SELECT p, side, class, count(*) AS n FROM e GROUP BY 1, 2, 3)
SELECT p, side, class, n FROM c JOIN (SELECT p, side, sum(n) AS total FROM c GROUP BY 1, 2) USING (p, side) WHERE n >= 3 AND n >= 0.8 * total""")
def onto_axiom_candidates(spark, sf_dir):
    t = triples(spark, sf_dir, "type", "inNation", "contains", "suppliedBy")
    return ontology.axiom_candidates(ontology.endpoint_pairs(t, ontology.types_of(t)))


@query(f"""WITH RECURSIVE {EXTRA_SQL}, {CLOSURE_SQL}, dis AS ({relation_sql(T.DISJOINT, 'l', 'r')}), cl AS (SELECT DISTINCT s, ancestor FROM types JOIN refl ON class = child)
SELECT a.s, l AS "left", r AS "right" FROM dis JOIN cl a ON a.ancestor = l JOIN cl b ON b.s = a.s AND b.ancestor = r""")
def onto_disjoint_conflicts(spark, sf_dir):
    t = extended(spark, sf_dir)
    return ontology.disjoint_conflicts(ontology.types_of(t), ontology.closure(subclasses(spark)), relation(spark, T.DISJOINT, "left", "right"))


@query(f"""SELECT DISTINCT d.c || ' -> ' || d.property || ' -> ' || coalesce(r.c, 'Literal') AS line
FROM (SELECT property, min(class) AS c FROM ({relation_sql(T.DOMAINS, 'property', 'class')}) GROUP BY 1) d LEFT JOIN (SELECT property, min(class) AS c FROM ({relation_sql(T.RANGES, 'property', 'class')}) GROUP BY 1) r USING (property)""")
def onto_condensed_schema(spark, sf_dir):
    return ontology.condensed_schema(relation(spark, T.DOMAINS, "property", "class"), relation(spark, T.RANGES, "property", "class"))


# ---------------------------------------------------------------- validation


@query(view("label", "segment", "category") + " SELECT DISTINCT s FROM t WHERE s NOT IN (SELECT s FROM t WHERE p IN ('segment', 'category'))")
def val_missing(spark, sf_dir):
    return validate.missing(triples(spark, sf_dir, "label", "segment", "category"), ["segment", "category"])


@query(view("type", "inNation", "placedBy") + f""", {LINKS_SQL}, d AS (SELECT s, count(*) AS n FROM (SELECT s FROM links UNION ALL SELECT o FROM links) GROUP BY s)
SELECT x.s, coalesce(n, 0) AS degree FROM (SELECT DISTINCT s FROM t) x LEFT JOIN d ON d.s = x.s WHERE coalesce(n, 0) <= 1""")
def val_weak_linkage(spark, sf_dir):
    return validate.weakly_linked(triples(spark, sf_dir, "type", "inNation", "placedBy"))


@query(view() + " SELECT p, count(*) AS n FROM t WHERE p NOT IN ('type', 'label', 'inNation', 'inRegion', 'contains') GROUP BY p")
def val_unknown_predicates(spark, sf_dir):
    allowed = relation(spark, tuple((p,) for p in ("type", "label", "inNation", "inRegion", "contains")), "property")
    return validate.unknown_predicates(triples(spark, sf_dir), allowed)


@query(f"""WITH RECURSIVE {EXTRA_SQL}, {CLOSURE_SQL} SELECT a.s, a.class AS "left", b.class AS "right" FROM types a JOIN types b ON a.s = b.s AND a.class < b.class
WHERE NOT EXISTS (SELECT 1 FROM up WHERE (child = a.class AND ancestor = b.class) OR (child = b.class AND ancestor = a.class))""")
def val_incomparable_types(spark, sf_dir):
    t = extended(spark, sf_dir)
    return validate.incomparable_types(ontology.types_of(t), ontology.closure(subclasses(spark)))


VOCABULARY = ("type", "label", "identifier", "extract", "inNation", "inRegion", "placedBy", "contains", "suppliedBy", "segment", "category")


@query(f"""WITH RECURSIVE t AS ({triples_sql()}), {CLOSURE_SQL}, {LINKS_SQL}, subj AS (SELECT DISTINCT s FROM t), d AS (SELECT s, count(*) AS n FROM (SELECT s FROM links UNION ALL SELECT o FROM links) GROUP BY s),
f AS (SELECT 'missing_type' AS category, s FROM subj WHERE s NOT IN (SELECT s FROM t WHERE p = 'type')
 UNION ALL SELECT 'missing_trace', s FROM subj WHERE s NOT IN (SELECT s FROM t WHERE p IN ('label', 'identifier', 'extract'))
 UNION ALL SELECT 'weak_linkage', x.s FROM subj x LEFT JOIN d ON d.s = x.s WHERE coalesce(n, 0) <= 1
 UNION ALL SELECT DISTINCT 'unknown_predicate', s FROM t WHERE p NOT IN ({words_sql(VOCABULARY)})
 UNION ALL SELECT DISTINCT 'dangling', o FROM links WHERE o NOT IN (SELECT s FROM subj))
SELECT c.category, count(f.s) AS n, min(f.s) AS sample FROM (SELECT unnest(['missing_type', 'missing_trace', 'weak_linkage', 'unknown_predicate', 'dangling', 'redundant_type', 'long_name']) AS category) c LEFT JOIN f ON f.category = c.category GROUP BY 1""")
def val_report(spark, sf_dir):
    allowed = relation(spark, tuple((p,) for p in VOCABULARY), "property")
    return validate.report(T.whole(spark, sf_dir), allowed, ontology.closure(subclasses(spark)))


# ---------------------------------------------------------------- minting and resolution


def parts(spark, sf_dir):
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), "p_name", "p_brand", "p_type", "p_mfgr" if "p_mfgr" in table(spark, sf_dir, "part").columns else F.lit("").alias("p_mfgr"))


MINT_SQL = f"""k AS (SELECT p_partkey AS id, 'Part|' || {norm_sql('p_name')} AS key,
 array_to_string(list_transform(string_split({norm_sql('p_name')}, ' '), lambda w: upper(w[1]) || w[2:]), '') AS b FROM part),
b AS (SELECT id, key, CASE WHEN b = '' THEN 'Part' WHEN regexp_matches(b, '^[0-9]') THEN 'Entity' || b ELSE b END AS base FROM k),
n AS (SELECT key, base, min(key) OVER (PARTITION BY base) AS f FROM (SELECT key, min(base) AS base FROM b GROUP BY key)),
m AS (SELECT id, b.key, CASE WHEN n.key = f THEN n.base ELSE n.base || '_' || sha256(n.key)[1:10] END AS name FROM b JOIN n ON b.key = n.key)"""


@query(f"WITH {MINT_SQL} SELECT id, key, name FROM m")
def mint_names(spark, sf_dir):
    return resolve.minted(parts(spark, sf_dir), F.lit("Part"), F.col("p_name"))


@query(f"WITH {MINT_SQL}, reg AS (SELECT DISTINCT 'Part|' || {norm_sql('p_name')} AS key, 'Known_' || sha256({norm_sql('p_name')})[1:10] AS name FROM part WHERE p_partkey % 3 = 0) SELECT m.id, m.key, coalesce(reg.name, m.name) AS name FROM m LEFT JOIN reg ON reg.key = m.key")
def mint_registry_reuse(spark, sf_dir):
    p = parts(spark, sf_dir)
    key = text.normalize(F.col("p_name"))
    registry = p.where("id % 3 = 0").select(F.concat(F.lit("Part|"), key).alias("key"), F.concat(F.lit("Known_"), text.short_hash(key)).alias("name")).distinct()
    return resolve.minted(p, F.lit("Part"), F.col("p_name"), registry)


@query("SELECT p_type AS class, upper(regexp_replace(p_brand, '[\\s\\-/]+', '', 'g')) AS ident, count(DISTINCT p_partkey) AS n, min(p_partkey) AS least FROM part GROUP BY 1, 2 HAVING count(DISTINCT p_partkey) > 1")
def er_identifier_collisions(spark, sf_dir):
    p = parts(spark, sf_dir).withColumn("ident", text.identifier(F.col("p_brand"))).withColumnRenamed("p_type", "class")
    return resolve.collisions(p, "class", "ident")


BLOCKS_SQL = f"""b AS (SELECT p_partkey AS id, replace({norm_sql('p_name')}, ' ', '') AS key FROM part),
d AS (SELECT l_partkey AS id, count(DISTINCT l_suppkey) AS degree FROM lineitem GROUP BY 1),
x AS (SELECT key, b.id, coalesce(degree, 0) AS degree FROM b LEFT JOIN d ON d.id = b.id WHERE length(key) >= 5),
pv AS (SELECT key, id AS pv_id FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY degree DESC, id) AS r FROM x) WHERE r = 1),
pr AS (SELECT x.key, pv_id, id FROM x JOIN pv ON pv.key = x.key WHERE id <> pv_id)"""


def surface_pairs(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    degree = li.groupBy(F.col("l_partkey").alias("id")).agg(F.count_distinct("l_suppkey").alias("degree"))
    return resolve.pivot_pairs(resolve.blocks(parts(spark, sf_dir), F.col("p_name")), degree)


@query(f"WITH {BLOCKS_SQL} SELECT key, pv_id AS \"pivot\", id FROM pr")
def er_surface_blocking_pairs(spark, sf_dir):
    return surface_pairs(spark, sf_dir)


@query("""SELECT 'Customer_' || c AS source, 'Part_' || p AS target, n AS score FROM (SELECT o_custkey AS c, l_partkey AS p, count(*) AS n,
 row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, 'Part_' || l_partkey) AS r FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2) WHERE r = 1""")
def er_select_canonical(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    name = lambda prefix, c: F.concat(F.lit(prefix), F.col(c).cast("string"))
    c = o.join(li, o.o_orderkey == li.l_orderkey).groupBy(name("Customer_", "o_custkey").alias("source"), name("Part_", "l_partkey").alias("target")).agg(F.count("*").alias("score"))
    return resolve.canonical(c)


@query(f"""WITH {BLOCKS_SQL}, t AS ({triples_sql('contains', 'label')}), mp AS (SELECT 'Part_' || id AS source, 'Part_' || min(pv_id) AS target FROM pr GROUP BY id)
SELECT DISTINCT coalesce(m1.target, t.s) AS s, p, CASE WHEN kind = 'iri' THEN coalesce(m2.target, t.o) ELSE t.o END AS o
FROM t LEFT JOIN mp m1 ON m1.source = t.s LEFT JOIN mp m2 ON m2.source = t.o""")
def er_rewrite_graph(spark, sf_dir):
    pairs = surface_pairs(spark, sf_dir).groupBy("id").agg(F.min("pivot").alias("pivot"))
    mapping = pairs.select(F.concat(F.lit("Part_"), "id").alias("source"), F.concat(F.lit("Part_"), "pivot").alias("target"))
    return patterns.rewrite(triples(spark, sf_dir, "contains", "label"), mapping).select("s", "p", "o")


@query("""WITH RECURSIVE m AS (SELECT 'Order_' || o_orderkey AS source, 'Order_' || nxt AS target FROM (SELECT o_orderkey, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS nxt FROM orders) WHERE nxt IS NOT NULL),
r AS (SELECT 'Order_' || o_orderkey AS source, 'Order_' || min(o_orderkey) OVER (PARTITION BY o_custkey) AS target FROM orders) SELECT source, target FROM r WHERE source <> target""")
def er_chain_resolution(spark, sf_dir):
    from pyspark.sql import Window

    o = table(spark, sf_dir, "orders").select("o_orderkey", F.lag("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderkey")).alias("nxt")).where("nxt IS NOT NULL")
    name = lambda c: F.concat(F.lit("Order_"), F.col(c).cast("string"))
    return resolve.resolve_chains(o.select(name("o_orderkey").alias("source"), name("nxt").alias("target")))


@query()
def er_string_similarity(spark, sf_dir):
    """Pairs of parts of one block with the matching-block ratio of their names and types (no SQL counterpart)."""
    pairs = surface_pairs(spark, sf_dir)
    p = parts(spark, sf_dir)
    a = p.select(F.col("id").alias("pivot"), F.concat_ws(" ", "p_name", "p_type").alias("x"))
    b = p.select("id", F.concat_ws(" ", "p_name", "p_type").alias("y"))
    return pairs.join(a, "pivot").join(b, "id").select("pivot", "id", F.round(similarity.ratio(F.col("x"), F.col("y")), 6).alias("ratio"))


@query(f"""WITH a AS (SELECT p_partkey AS id, {tokens_sql('p_name', 2)} AS x, {tokens_sql('p_type', 2)} AS y FROM part)
SELECT id, round(CASE WHEN len(x) > 0 THEN len(list_distinct(list_filter(x, lambda w: list_contains(y, w)))) / len(x) ELSE 0.0 END, 6) AS overlap FROM a""")
def er_token_overlap(spark, sf_dir):
    p = parts(spark, sf_dir)
    return p.select("id", F.round(text.token_overlap(text.tokens(F.col("p_name"), 2), text.tokens(F.col("p_type"), 2)), 6).alias("overlap"))


@query("""WITH x AS (SELECT vec_id AS id, label, generate_subscripts(embedding, 1) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings), c AS (SELECT label, i, avg(v) AS c FROM x GROUP BY 1, 2)
SELECT label, id, round(sum(v * c) / (sqrt(sum(v * v)) * sqrt(sum(c * c))), 4) AS cosine FROM x JOIN c USING (label, i) GROUP BY 1, 2""")
def er_cluster_cosine(spark, sf_dir):
    v = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "label", F.col("embedding").cast("array<double>").alias("embedding"))
    return resolve.clusters(v).withColumn("cosine", F.round("cosine", 4))


@query("""SELECT source, target, issue, max(score) AS score, CAST(sum(questions) AS BIGINT) AS questions FROM (
 SELECT o_custkey AS source, o_orderpriority AS target, o_orderstatus AS issue, length(o_orderpriority) AS score, 1 AS questions FROM orders UNION ALL SELECT c_custkey, c_mktsegment, 'S', length(c_name), 2 FROM customer) GROUP BY 1, 2, 3""")
def er_merge_candidates(spark, sf_dir):
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    a = o.select(F.col("o_custkey").alias("source"), F.col("o_orderpriority").alias("target"), F.col("o_orderstatus").alias("issue"), F.length("o_orderpriority").cast("long").alias("score"), F.lit(1).alias("questions"))
    b = c.select(F.col("c_custkey").alias("source"), F.col("c_mktsegment").alias("target"), F.lit("S").alias("issue"), F.length("c_name").cast("long").alias("score"), F.lit(2).alias("questions"))
    return resolve.merged(a, b)


PROPOSALS = (("Customer_1", "inNation", "Customer_1"), ("Customer_1", "inNation", "Nation_99999"), ("Customer_1", "likes", "Part_1"), ("Part_1", "suppliedBy", "Supplier_1"), ("Customer_1", "inNation", "Nation_1"), ("Customer_2", "inNation", "Nation_2"))


@query(f"""WITH t AS ({triples_sql('type', 'inNation', 'suppliedBy')}), pr AS ({relation_sql(PROPOSALS, 's', 'p', 'o')}), ty AS (SELECT s FROM t WHERE p = 'type')
SELECT s, p, o, CASE WHEN s = o THEN 'self_loop' WHEN s NOT IN (SELECT s FROM ty) OR o NOT IN (SELECT s FROM ty) THEN 'untyped' WHEN p NOT IN ('inNation', 'suppliedBy') THEN 'unknown_property'
 WHEN EXISTS (SELECT 1 FROM t WHERE t.s = pr.s AND t.p = pr.p AND t.o = pr.o) THEN 'present' ELSE 'added' END AS verdict FROM pr""")
def er_link_guards(spark, sf_dir):
    t = triples(spark, sf_dir, "type", "inNation", "suppliedBy")
    return resolve.guarded(relation(spark, PROPOSALS, "s", "p", "o"), t, relation(spark, (("inNation",), ("suppliedBy",)), "property"))


# ---------------------------------------------------------------- text


@query(f"SELECT doc_id, length({norm_sql('text')}) AS n, sha256({norm_sql('text')}) AS h FROM documents")
def txt_normalize(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", text.normalize(F.col("text")).alias("x"))
    return d.select("doc_id", F.length("x").cast("long").alias("n"), F.sha2("x", 256).alias("h"))


@query(f"SELECT doc_id, len({tokens_sql('text', 3)}) AS n, array_to_string(list_filter({tokens_sql('text', 3)}, lambda x: x NOT IN ({words_sql(text.STOPWORDS)}))[1:5], ' ') AS head FROM documents")
def txt_tokens(spark, sf_dir):
    ws = text.tokens(F.col("text"), 3)
    head = F.array_join(F.slice(F.filter(ws, lambda x: ~x.isin(*text.STOPWORDS)), 1, 5), " ")
    return table(spark, sf_dir, "documents").select("doc_id", F.size(ws).cast("long").alias("n"), head.alias("head"))


@query("SELECT doc_id, array_to_string(list_sort(list_distinct(list_transform(" + " || ".join(f"regexp_extract_all(text, '{p}')" for p in text.KEY_LITERALS) + ", lambda x: lower(x)))), ',') AS found FROM documents")
def txt_key_literals(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(F.array_sort(text.key_literals(F.col("text"))), ",").alias("found"))


@query("""SELECT doc_id, len(f) AS n, coalesce(f[1], '') AS first FROM (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(text, '[\n;|.!?]+'), lambda x: trim(x)), lambda x: length(x) BETWEEN 8 AND 220) AS g,
 [x FOR x, i IN g IF list_position(g, x) = i] AS f FROM documents)""")
def txt_fragments(spark, sf_dir):
    f = text.fragments(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.size(f).cast("long").alias("n"), F.coalesce(F.get(f, 0), F.lit("")).alias("first"))


@query("SELECT page_id, string_split(string_split(url, '/')[-1], '#')[-1] AS name FROM pages")
def txt_local_name(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.local_name(F.col("url")).alias("name"))


@query("SELECT c_custkey AS id, trim(regexp_replace(regexp_replace(replace(regexp_replace(c_name, '[#]+', '_', 'g'), '_', ' '), '([a-z])([A-Z0-9])', '\\1 \\2', 'g'), ' +', ' ', 'g')) AS name FROM customer")
def txt_humanize(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), text.humanize(F.regexp_replace("c_name", "[#]+", "_")).alias("name"))


LANGUAGE_SQL = ", ".join(f"len(list_filter(w, lambda x: x IN ({words_sql(v)}))) AS {k}_hits" for k, v in text.LANGUAGE_WORDS.items())


@query(f"SELECT doc_id, {LANGUAGE_SQL} FROM (SELECT doc_id, regexp_split_to_array(lower(text), '[\\s.,!?]+') AS w FROM documents)")
def txt_language_score(spark, sf_dir):
    scores = text.language_scores(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", *[c.cast("long").alias(f"{k}_hits") for k, c in scores.items()])


@query("SELECT p_partkey AS id, CASE WHEN regexp_matches(trim(p_brand), '(?i)[0-9]{4}/[0-9]{2}/[A-Z]{2}') THEN 1.0 WHEN regexp_matches(trim(p_brand), '[A-Z]{1,6}-?[0-9]{1,6}') THEN 0.85 WHEN regexp_matches(trim(p_brand), '[0-9]') AND regexp_matches(trim(p_brand), '[-/]') THEN 0.75 WHEN length(trim(p_brand)) <= 24 AND regexp_matches(p_brand, '[0-9]') THEN 0.55 ELSE 0.0 END::DOUBLE AS score FROM part")
def txt_identifier_score(spark, sf_dir):
    return parts(spark, sf_dir).select("id", text.structured_identifier_score(F.col("p_brand")).cast("double").alias("score"))


@query("SELECT item_id, sha256(text)[1:10] AS h FROM benchmark")
def txt_short_hash(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select("item_id", text.short_hash(F.col("text")).alias("h"))


# ---------------------------------------------------------------- ingest


TERMS_SQL = f"terms AS (SELECT DISTINCT unnest({tokens_sql('text', 5)}) AS term FROM benchmark)"
DENSITY_SQL = f"""{TERMS_SQL}, w AS (SELECT DISTINCT doc_id AS id, unnest({tokens_sql('text', 2)}) AS term FROM documents), c AS (SELECT id, count(*) AS n FROM w JOIN terms USING (term) GROUP BY id),
den AS (SELECT doc_id AS id, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) AS n_words, coalesce(c.n, 0) AS n_terms FROM documents LEFT JOIN c ON c.id = doc_id),
dd AS (SELECT *, CASE WHEN n_words > 0 THEN round(n_terms / n_words, 4) ELSE 0.0 END AS density FROM den)"""


def chunks(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text", "source")


def term_density(spark, sf_dir):
    terms = table(spark, sf_dir, "benchmark").select(F.explode(text.tokens(F.col("text"), 5)).alias("term")).distinct()
    return ingest.term_counts(chunks(spark, sf_dir), terms)


@query(f"WITH {DENSITY_SQL} SELECT id, n_words, n_terms, density FROM dd")
def ing_term_density(spark, sf_dir):
    return term_density(spark, sf_dir)


@query(f"WITH {DENSITY_SQL} SELECT CASE WHEN density >= 0.05 THEN 256 ELSE 512 END AS budget, CASE WHEN density >= 0.05 THEN 38 ELSE 77 END AS overlap, count(*) AS n FROM dd GROUP BY 1, 2")
def ing_chunk_config(spark, sf_dir):
    budget, overlap = ingest.chunk_config(F.col("density"))
    return term_density(spark, sf_dir).groupBy(budget.alias("budget"), overlap.alias("overlap")).agg(F.count("*").alias("n"))


@query()
def ing_split_parts(spark, sf_dir):
    """Parts of documents by sentences and token budget (an ordered fold; tested against a plain version)."""
    return ingest.split_parts(chunks(spark, sf_dir))


@query("SELECT doc_id AS id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS local_id, row_number() OVER (ORDER BY source, doc_id) - 1 AS global_id FROM documents")
def ing_global_chunk_ids(spark, sf_dir):
    return ingest.numbered(chunks(spark, sf_dir).select("id", "source"), "source", "id").select("id", "source", F.col("local_id").cast("long"), "global_id")


@query("""WITH m AS (SELECT doc_id AS id, CASE WHEN doc_id % 7 = 0 THEN 'old' ELSE sha256(text) END AS was, CASE WHEN doc_id % 11 = 0 THEN 'error' ELSE 'ok' END AS status FROM documents WHERE doc_id % 5 <> 0),
r AS (SELECT doc_id AS id, CASE WHEN was IS NULL THEN 'missing' WHEN status <> 'ok' THEN 'error' WHEN was <> sha256(text) THEN 'stale' ELSE 'ok' END AS reason FROM documents LEFT JOIN m ON m.id = doc_id)
SELECT id, CASE WHEN reason = 'ok' THEN 'reuse' ELSE 'regenerate' END AS action, reason FROM r""")
def ing_incremental_actions(spark, sf_dir):
    signed = chunks(spark, sf_dir).select("id", F.sha2("text", 256).alias("signature"))
    manifest = signed.where("id % 5 <> 0").select("id", F.when(F.col("id") % 7 == 0, "old").otherwise(F.col("signature")).alias("signature"), F.when(F.col("id") % 11 == 0, "error").otherwise("ok").alias("status"))
    return ingest.actions(signed, manifest)


@query(f"SELECT term, count(*) AS n FROM (SELECT unnest({tokens_sql('text', 4)}) AS term FROM documents) WHERE term NOT IN ({words_sql(text.STOPWORDS)}) GROUP BY 1 HAVING count(*) >= 2 ORDER BY n DESC, term LIMIT 100")
def ing_candidate_terms(spark, sf_dir):
    return ingest.candidate_terms(chunks(spark, sf_dir))


# ---------------------------------------------------------------- lexicon, plans, evidence


@query(f"SELECT {norm_sql('surface')} AS surface, count(DISTINCT id) AS n_entities, min(id) AS least FROM (SELECT 'Part_' || p_partkey AS id, p_name AS surface FROM part UNION ALL SELECT 'Customer_' || c_custkey, c_name FROM customer) x WHERE length({norm_sql('surface')}) >= 3 GROUP BY 1")
def lex_surface_index(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.concat(F.lit("Part_"), "p_partkey").alias("id"), F.col("p_name").alias("surface"))
    c = table(spark, sf_dir, "customer").select(F.concat(F.lit("Customer_"), "c_custkey").alias("id"), F.col("c_name").alias("surface"))
    return retrieve.surface_index(p.unionByName(c))


QUESTIONS_SQL = "q AS (SELECT conv_id * 1000 + turn AS id, text FROM conversations WHERE role = 'user')"


def questions(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    return c.where("role = 'user'").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text")


@query(f"""WITH {QUESTIONS_SQL}, {TERMS_SQL}, h AS (SELECT DISTINCT id, unnest({tokens_sql('text', 3)}) AS term FROM q)
SELECT id, term, rank FROM (SELECT id, term, row_number() OVER (PARTITION BY id ORDER BY length(term) DESC, term) AS rank FROM h JOIN terms USING (term)) WHERE rank <= 8""")
def lex_question_hits(spark, sf_dir):
    terms = table(spark, sf_dir, "benchmark").select(F.explode(text.tokens(F.col("text"), 5)).alias("term"))
    return retrieve.question_hits(questions(spark, sf_dir).distinct(), terms)


#: (intent, keyword, weight): the rules that questions are scored by.
INTENT_RULES = (("lookup", "what", 2), ("lookup", "which", 2), ("procedure", "how", 3), ("procedure", "to", 1), ("place", "where", 3), ("place", "in", 1), ("count", "many", 3), ("definition", "is", 1), ("definition", "the", 1))
RULES_SQL = "SELECT intent, keyword, CAST(weight AS INT) AS weight FROM (" + relation_sql(INTENT_RULES, "intent", "keyword", "weight") + ")"
INTENT_SQL = f"""{QUESTIONS_SQL}, r AS ({RULES_SQL}), w AS (SELECT DISTINCT id, unnest({tokens_sql('text', 2)}) AS keyword FROM q), sc AS (SELECT id, intent, sum(weight) AS score FROM w JOIN r USING (keyword) GROUP BY 1, 2),
it AS (SELECT q.id, coalesce(intent, 'generic') AS intent, coalesce(score, 0) AS score FROM (SELECT DISTINCT id FROM q) q LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, intent) AS k FROM sc) b ON b.id = q.id AND k = 1)"""


def question_intents(spark, sf_dir):
    rules = relation(spark, INTENT_RULES, "intent", "keyword", "weight").select("intent", "keyword", F.col("weight").cast("int").alias("weight"))
    q = questions(spark, sf_dir).groupBy("id").agg(F.min("text").alias("text"))
    return retrieve.intents(q, rules)


@query(f"WITH {INTENT_SQL} SELECT id, intent, CAST(score AS BIGINT) AS score FROM it")
def plan_intents(spark, sf_dir):
    return question_intents(spark, sf_dir)


@query(f"WITH {INTENT_SQL} SELECT intent, count(*) AS n, round(avg(score), 4) AS mean_score FROM it GROUP BY 1")
def plan_intent_summary(spark, sf_dir):
    return question_intents(spark, sf_dir).groupBy("intent").agg(F.count("*").alias("n"), F.round(F.avg("score"), 4).alias("mean_score"))


PLAN = retrieve.Plan(("Region_2",), (retrieve.Step("inRegion", True), retrieve.Step("inNation", True, 40)), ("label", "segment"))
PLAN_SQL = view("inRegion", "inNation", "label", "segment") + """, n1 AS (SELECT DISTINCT s FROM t WHERE p = 'inRegion' AND o = 'Region_2'), n2 AS (SELECT DISTINCT s FROM t WHERE p = 'inNation' AND o IN (SELECT s FROM n1))"""


@query(PLAN_SQL + ", n3 AS (SELECT s FROM n2 ORDER BY s LIMIT 40) SELECT DISTINCT s, p, o FROM t WHERE p IN ('label', 'segment') AND s IN (SELECT s FROM n3)")
def exec_plan(spark, sf_dir):
    return retrieve.run_plan(triples(spark, sf_dir, "inRegion", "inNation", "label", "segment"), PLAN)


@query(PLAN_SQL + " SELECT 0 AS step, 'inRegion' AS predicate, count(*) AS reached, CASE WHEN count(*) = 0 THEN 'too_narrow' ELSE 'bounded' END AS status FROM n1 UNION ALL SELECT 1, 'inNation', count(*), CASE WHEN count(*) = 0 THEN 'too_narrow' WHEN count(*) > 40 THEN 'too_broad' ELSE 'bounded' END FROM n2")
def exec_boundedness(spark, sf_dir):
    return retrieve.boundedness(triples(spark, sf_dir, "inRegion", "inNation", "label", "segment"), PLAN)


SIGNIFICANT_SQL = "list_distinct(list_filter({}, lambda x: x NOT IN (" + words_sql(text.STOPWORDS) + ")))"


@query(f"""WITH qw AS (SELECT item_id AS id, unnest({SIGNIFICANT_SQL.format(tokens_sql('text', 3))}) AS word FROM benchmark), rw AS (SELECT doc_id AS row, unnest({SIGNIFICANT_SQL.format(tokens_sql('text', 3))}) AS word FROM documents),
sh AS (SELECT id, row, count(*) AS shared FROM qw JOIN rw USING (word) GROUP BY 1, 2)
SELECT id, row, shared, rank FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY shared DESC, row) AS rank FROM sh) WHERE rank <= 3""")
def syn_evidence_topk(spark, sf_dir):
    q = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), "text")
    return retrieve.evidence(q, table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row"), "text"))


# ---------------------------------------------------------------- evaluation


@query("""WITH e AS (SELECT DISTINCT o_custkey AS id, l_partkey AS item FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P'),
f AS (SELECT DISTINCT o_custkey AS id, l_partkey AS item FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_quantity > 20),
b AS (SELECT coalesce(e.id, f.id) AS id, count(e.id) AS ne, count(f.id) AS nf, count(CASE WHEN e.id IS NOT NULL AND f.id IS NOT NULL THEN 1 END) AS n FROM e FULL JOIN f ON e.id = f.id AND e.item = f.item GROUP BY 1)
SELECT id, CASE WHEN nf > 0 THEN round(n / nf, 4) ELSE 0.0 END AS precision, CASE WHEN ne > 0 THEN round(n / ne, 4) ELSE 0.0 END AS recall FROM b""")
def eval_precision_recall(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    both = o.join(li, o.o_orderkey == li.l_orderkey).select(F.col("o_custkey").alias("id"), F.col("l_partkey").alias("item"), "o_orderstatus", "l_quantity")
    return evaluate.precision_recall(both.where("o_orderstatus <> 'P'").select("id", "item"), both.where("l_quantity > 20").select("id", "item"))


@query("SELECT what, value, count(*) AS n FROM (SELECT unnest(['lang', 'source']) AS what, unnest([lang, source]) AS value FROM documents) GROUP BY 1, 2")
def eval_histograms(spark, sf_dir):
    return evaluate.histograms(table(spark, sf_dir, "documents"), "lang", "source")


@query(f"""WITH a AS (SELECT p_partkey AS id, {norm_sql('p_name')} = {norm_sql('p_type')} AS eq, {tokens_sql('p_type', 2)} AS x, {tokens_sql("p_name || ' ' || p_type[1:9]", 2)} AS y FROM part),
b AS (SELECT id, eq, CASE WHEN len(x) > 0 THEN len(list_distinct(list_filter(x, lambda w: list_contains(y, w)))) / len(x) ELSE 0.0 END AS ov FROM a)
SELECT id, CASE WHEN eq THEN 'exact' WHEN ov >= 0.75 THEN 'high_partial' WHEN ov >= 0.4 THEN 'partial' WHEN ov > 0 THEN 'weak' ELSE 'none' END AS mode FROM b""")
def eval_match_mode(spark, sf_dir):
    p = parts(spark, sf_dir)
    given = F.concat_ws(" ", "p_name", F.substring("p_type", 1, 9))
    overlap = text.token_overlap(text.tokens(F.col("p_type"), 2), text.tokens(given, 2))
    return p.select("id", evaluate.match_mode(overlap, text.normalize(F.col("p_name")) == text.normalize(F.col("p_type"))).alias("mode"))


@query("SELECT source, doc_id, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_chars, doc_id) AS r FROM documents) WHERE r = 1")
def eval_exemplars(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("source", "doc_id", "n_chars")
    return evaluate.exemplars(d, "source", F.col("n_chars"), F.col("doc_id"))


@query(f"""WITH {INTENT_SQL}, pr AS (SELECT a.intent AS x, b.intent AS y, a.score AS p, b.score AS s FROM it a JOIN it b ON b.id = a.id + 2)
SELECT count(*) AS n_pairs, count(*) FILTER (x = y) AS same_intent, count(*) FILTER (p = s) AS same_plan, coalesce(round(avg(CASE WHEN x = y THEN 1.0 ELSE 0.0 END), 4), 0.0) AS share FROM pr""")
def eval_pair_alignment(spark, sf_dir):
    it = question_intents(spark, sf_dir)
    a = it.select("id", F.col("intent").alias("intent_a"), F.col("score").alias("plan_a"))
    b = it.select((F.col("id") - 2).alias("id"), F.col("intent").alias("intent_b"), F.col("score").alias("plan_b"))
    return evaluate.aligned(a.join(b, "id"))


@query("""WITH a AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_quantity > 25), b AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_discount > 0.05)
SELECT count(*) FILTER (b.k IS NULL) AS only_a, count(*) FILTER (a.k IS NULL) AS only_b, count(*) FILTER (a.k IS NOT NULL AND b.k IS NOT NULL) AS both,
 CASE WHEN count(*) FILTER (b.k IS NULL) = 0 AND count(*) FILTER (a.k IS NULL) = 0 THEN 'equivalent' WHEN count(*) FILTER (a.k IS NOT NULL AND b.k IS NOT NULL) > 0 THEN 'partial' ELSE 'failed' END AS status FROM a FULL JOIN b ON a.k = b.k""")
def eval_equivalence(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("k"), "l_quantity", "l_discount")
    return evaluate.equivalence(li.where("l_quantity > 25").select("k"), li.where("l_discount > 0.05").select("k"))


@query("SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract_string(props, '$.k') AS INT)) AS BIGINT) AS total FROM events GROUP BY 1")
def json_props_extract(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.groupBy("event_type").agg(F.count("*").alias("n"), F.sum(F.get_json_object("props", "$.k").cast("int")).alias("total"))


# ---------------------------------------------------------------- sources and streams


@query(f"SELECT s, p, o FROM ({triples_sql()}) WHERE o IS NOT NULL")
def src_turtle_roundtrip(spark, sf_dir):
    """All triples written as Turtle, a document a subject, and parsed again."""
    from .sources import turtle

    t = T.whole(spark, sf_dir).where("o IS NOT NULL")
    o = F.when(F.col("kind") == "iri", F.concat(F.lit("ex:"), "o")).otherwise(F.concat(F.lit('"'), turtle.escaped(F.col("o")), F.lit('"')))
    stated = t.groupBy("s").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(" ", F.concat(F.lit("ex:"), "p"), o))), " ; ").alias("po"))
    texts = stated.select(F.col("s").alias("source"), F.concat(F.lit("@prefix ex: <http://e.org/> . ex:"), "s", F.lit(" "), "po", F.lit(" .")).alias("text"))
    local = lambda c: text.local_name(F.col(c))
    return turtle.parse(texts).select(local("s").alias("s"), local("p").alias("p"), F.when(F.col("o_kind") == "iri", local("o")).otherwise(F.col("o")).alias("o"))


@query("SELECT source, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM (SELECT source, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS text FROM documents) GROUP BY 1")
def src_chunk_files(spark, sf_dir):
    """Documents as chunk files with headers, read back by the chunk parser."""
    from .sources import chunks as reader

    d = table(spark, sf_dir, "documents")
    head = F.concat(F.lit("preface\n--- Pages: [1, 2] | Section: "), "source", F.lit(" | Title: "), F.col("doc_id").cast("string"), F.lit(" ---\n"))
    files = d.select(F.col("doc_id").cast("string").alias("source"), F.concat(head, "text").alias("text"))
    return reader.parse(files).groupBy(F.col("section").alias("source")).agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("n_chars"))


@query("SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS hour, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_event_windows(spark, sf_dir):
    """Hourly counts over the event table as a stream that is read to its end."""
    import uuid

    from .streaming import ingest as streams

    schema = table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/events*.parquet")
    name = f"windows_{uuid.uuid4().hex}"
    counted = streams.windowed_counts(events, "ts", "event_type")
    counted.writeStream.format("memory").queryName(name).outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    return spark.table(name).select(F.date_format("start", "yyyy-MM-dd HH").alias("hour"), "event_type", "n")


from . import queries_depth, queries_links, queries_more  # noqa: E402, F401  they register their queries here
