"""Queries of phrases, judged merges, semantic categories, diagnosis and extraction."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import text, turtle_text
from .operators import acceptance, answer, diagnose, ingest, lexicon, ontology, patterns, plan, resolve, retrieve, stages, validate
from .plans.triples import relation, relation_sql, table, triples, triples_sql
from .queries import CLOSURE_SQL, LINKS_SQL, QUESTIONS_SQL, SIGNIFICANT_SQL, chunks, norm_sql, parts, query, questions, subclasses, tokens_sql, view, words_sql

# ---------------------------------------------------------------- phrases and text


def words_of_sql(c: str) -> str:
    return f"list_filter(string_split({norm_sql(c)}, ' '), lambda x: x <> '')"


def grams_sql(source: str, key: str, c: str) -> str:
    """(id, gram) of one to three words."""
    return f"""gw AS (SELECT {key} AS id, {words_of_sql(c)} AS ws FROM {source}),
grams AS (SELECT DISTINCT id, gram FROM (SELECT id, unnest(ws) AS gram FROM gw UNION ALL SELECT id, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) FROM gw
 UNION ALL SELECT id, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) FROM gw))"""


PHRASE_TERMS_SQL = f"pt AS (SELECT DISTINCT term FROM (SELECT unnest([ws[1], ws[1] || ' ' || ws[2], ws[3] || ' ' || ws[4] || ' ' || ws[5]]) AS term FROM (SELECT {words_of_sql('text')} AS ws FROM benchmark) WHERE len(ws) >= 5) WHERE length(term) >= 2)"


def phrase_terms(spark, sf_dir):
    b = table(spark, sf_dir, "benchmark").select(text.phrases(F.col("text"), (1,)).alias("ws")).where(F.size("ws") >= 5)
    some = F.array(F.col("ws")[0], F.array_join(F.slice("ws", 1, 2), " "), F.array_join(F.slice("ws", 3, 3), " "))
    return b.select(F.explode(some).alias("term"))


@query(f"""WITH {PHRASE_TERMS_SQL}, {grams_sql('documents', 'doc_id', 'text')}, c AS (SELECT id, count(*) AS n FROM grams JOIN pt ON term = gram GROUP BY id)
SELECT doc_id AS id, n_words, coalesce(n, 0) AS n_terms, CASE WHEN n_words > 0 THEN round(coalesce(n, 0) / n_words, 4) ELSE 0.0 END AS density
FROM (SELECT doc_id, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) AS n_words FROM documents) LEFT JOIN c ON c.id = doc_id""")
def ing_phrase_density(spark, sf_dir):
    """Density of terms of one, two and three words."""
    return ingest.term_counts(chunks(spark, sf_dir), phrase_terms(spark, sf_dir))


@query(f"""WITH {QUESTIONS_SQL}, q1 AS (SELECT id, min(text) AS text FROM q GROUP BY 1), {grams_sql('q1', 'id', 'text')}, pt AS (SELECT DISTINCT ws[1] || ' ' || ws[2] AS term FROM gw WHERE len(ws) >= 2)
SELECT id, term, rank FROM (SELECT id, gram AS term, row_number() OVER (PARTITION BY id ORDER BY length(gram) DESC, gram) AS rank FROM grams JOIN pt ON term = gram WHERE length(term) >= 3) WHERE rank <= 8""")
def lex_phrase_hits(spark, sf_dir):
    """Terms of two words in questions."""
    q = questions(spark, sf_dir).groupBy("id").agg(F.min("text").alias("text"))
    terms = q.select(text.phrases(F.col("text"), (1,)).alias("ws")).where(F.size("ws") >= 2).select(F.array_join(F.slice("ws", 1, 2), " ").alias("term"))
    return retrieve.question_hits(q, terms)


@query("SELECT doc_id, sha256(trim(regexp_replace(strip_accents(lower(text)), '[^a-z0-9@/_\\-.]+', ' ', 'g'))) AS h FROM documents")
def txt_technical_norm(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(text.normalize_technical(F.col("text")), 256).alias("h"))


def variant_sql(c: str) -> str:
    return f"trim(lower(regexp_replace(regexp_replace(regexp_replace(strip_accents({c}), '([a-z0-9])([A-Z])', '\\1 \\2', 'g'), '([A-Z])([A-Z][a-z])', '\\1 \\2', 'g'), '[^A-Za-z0-9]+', ' ', 'g')))"


def blocked_sql(c: str) -> str:
    return f"len(list_filter(string_split({variant_sql(c)}, ' '), lambda w: w IN ({words_sql(text.CONTEXT_WORDS)}) OR regexp_full_match(w, 'v?[0-9]+(\\.[0-9]+)*'))) > 0"


@query(f"SELECT page_id AS id, {variant_sql('url')} AS variant, {blocked_sql('url')} AS blocked FROM pages UNION ALL SELECT -c_custkey, {variant_sql('c_name')}, {blocked_sql('c_name')} FROM customer")
def txt_surface_variant(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), F.col("url").alias("x"))
    c = table(spark, sf_dir, "customer").select((-F.col("c_custkey")).alias("id"), F.col("c_name").alias("x"))
    return p.unionByName(c).select("id", text.surface_variant(F.col("x")).alias("variant"), text.context_blocked(F.col("x")).alias("blocked"))


LOCAL_SQL = "string_split(string_split({0}, '/')[-1], '#')[-1]"


@query(f"SELECT page_id AS id, CASE WHEN regexp_matches(l, '[A-Z][a-z]+[A-Z][A-Za-z0-9]+') THEN 0.35 WHEN regexp_matches(l, '[_0-9]') THEN 0.2 ELSE 0.0 END::DOUBLE AS penalty FROM (SELECT page_id, {LOCAL_SQL.format('url')} AS l FROM pages)")
def txt_identifier_penalty(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), text.identifier_penalty(F.col("url")).cast("double").alias("penalty"))


PREFIXES = ("Alarm", "Part", "Parameter")


@query("SELECT id, array_to_string(list_filter([n, CASE WHEN b <> n AND b <> '' THEN b END, CASE WHEN starts_with(b, 'Error') THEN b[6:] END], lambda x: x IS NOT NULL), ',') AS variants FROM (SELECT n_nationkey AS id, n, regexp_replace(n, '^(Alarm|Part|Parameter)_?', '') AS b FROM (SELECT n_nationkey, CASE n_nationkey % 3 WHEN 0 THEN 'Part_' ELSE 'AlarmError' END || replace(n_name, ' ', '') AS n FROM nation))")
def lex_search_variants(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    name = F.concat(F.lit("http://e.org/x#"), F.when(F.col("n_nationkey") % 3 == 0, "Part_").otherwise("AlarmError"), F.replace("n_name", F.lit(" "), F.lit("")))
    return n.select(F.col("n_nationkey").alias("id"), F.array_join(resolve.search_variants(name, PREFIXES), ",").alias("variants"))


@query("SELECT id, CASE WHEN length(x) <= 80 THEN x ELSE regexp_replace(x[1:69], '_+$', '') || '_' || sha256(CAST(id AS VARCHAR))[1:10] END AS name FROM (SELECT p_partkey AS id, repeat(replace(p_name || ' ' || p_type, ' ', '_'), CAST(1 + p_partkey % 4 AS INT)) AS x FROM part)")
def mint_limited_names(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.expr("repeat(replace(concat(p_name, ' ', p_type), ' ', '_'), int(1 + p_partkey % 4))").alias("x"))
    return p.select("id", resolve.limited_name(F.col("x"), F.col("id").cast("string")).alias("name"))


@query("SELECT n_nationkey AS id, 'ex:a' || n_nationkey || ' a ex:Nation ; rdfs:label \"x\"^^xsd:string .' || chr(10) || 'ex:Nation7 a ex:Nation ; ex:identifier \"' || n_name || '\" .' || chr(10) || 'ex:S a ex:Region ; ex:n \"1\" .' AS fixed FROM nation")
def ttl_vocabulary(spark, sf_dir):
    """Slips of vocabulary, a property glued to its subject, and a block in braces, put right."""
    raw = F.concat(F.lit("ex:a"), "n_nationkey", F.lit(' a rdf:type ex:Land ; rdfs:label "x"@xsd:string .\nex:Nation7Identifier "'), "n_name", F.lit('" .\nex:S a { a ex:Region ; ex:n "1" ; } .'))
    fixed = turtle_text.unbraced_blocks(turtle_text.unglued_properties(turtle_text.canonical_vocabulary(raw, (("ex:Land", "ex:Nation"),)), ("identifier",), ("Nation",), "Thing"))
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), fixed.alias("fixed"))


# ---------------------------------------------------------------- judged merges


def overlap(a, b):
    return F.round(text.token_overlap(text.tokens(a, 2), text.tokens(b, 2)), 6)


def overlap_sql(a: str, b: str) -> str:
    x, y = tokens_sql(a, 2), tokens_sql(b, 2)
    return f"round(CASE WHEN len({x}) > 0 THEN len(list_distinct(list_filter({x}, lambda w: list_contains({y}, w)))) / len({x}) ELSE 0.0 END, 6)"


KEY_SQL = "replace({0}, ' ', '')"
SCAN_SQL = f"""t AS ({triples_sql('type')}), {CLOSURE_SQL},
d AS (SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS label, p_type AS local, CASE p_size % 3 WHEN 0 THEN 'Part' WHEN 1 THEN 'Asset' ELSE 'Customer' END AS class, coalesce(n, 0) AS n_in
 FROM part LEFT JOIN (SELECT l_partkey, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1) ON l_partkey = p_partkey),
k AS (SELECT DISTINCT id, n_in, local, unnest([{KEY_SQL.format(variant_sql('label'))}, {KEY_SQL.format(variant_sql('local'))}]) AS key FROM d),
kk AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY n_in DESC, local, id) AS r FROM k WHERE length(key) >= 5),
pr AS (SELECT a.key, b.id AS source, a.id AS candidate FROM kk a JOIN kk b ON a.key = b.key AND b.r = 1 WHERE a.id <> b.id),
j AS (SELECT pr.*, a.class = b.class OR EXISTS (SELECT 1 FROM up WHERE (child = a.class AND ancestor = b.class) OR (child = b.class AND ancestor = a.class)) AS compatible,
 round(greatest({overlap_sql('a.label', 'b.label')}, {overlap_sql('a.local', 'b.local')}), 4) AS similarity, {blocked_sql('a.local')} OR {blocked_sql('b.local')} AS blocked FROM pr JOIN d a ON a.id = source JOIN d b ON b.id = candidate),
sc AS (SELECT key, source, candidate, similarity, CASE WHEN NOT compatible THEN 'incompatible_entity_types' WHEN similarity < 0.92 THEN 'surface_similarity_below_threshold' WHEN blocked THEN 'contextual_suffix_blocked' ELSE 'surface_variant_canonicalization' END AS verdict FROM j)"""


def scan(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("k")).agg(F.count_distinct("l_suppkey").alias("n"))
    p = table(spark, sf_dir, "part").join(li, F.col("p_partkey") == F.col("k"), "left")
    kind = F.when(F.col("p_size") % 3 == 0, "Part").when(F.col("p_size") % 3 == 1, "Asset").otherwise("Customer")
    described = p.select(
        F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("label"), F.lit(None).cast("string").alias("identifier"), F.col("p_name").alias("best"), F.col("p_type").alias("local"),
        F.array(kind).alias("classes"), F.lit(1).alias("n_surfaces"), F.coalesce("n", F.lit(0)).alias("n_in"),
    )
    compatible = ontology.closure(subclasses(spark)).select(F.col("child").alias("x"), F.col("ancestor").alias("y"))
    return acceptance.variant_scan(described, compatible, overlap)


@query(f"WITH RECURSIVE {SCAN_SQL} SELECT key, source, candidate, similarity, verdict FROM sc")
def er_variant_scan(spark, sf_dir):
    return scan(spark, sf_dir)


@query(f"WITH RECURSIVE {SCAN_SQL} SELECT verdict, count(*) AS n, count(DISTINCT source) AS n_sources FROM sc GROUP BY 1")
def er_variant_summary(spark, sf_dir):
    return acceptance.scan_summary(scan(spark, sf_dir))


@query(view("type", "label", "identifier", "contains") + f""", {LINKS_SQL}, i AS (SELECT o AS s, count(*) AS n FROM links GROUP BY 1),
o AS (SELECT s, min(CASE WHEN p = 'label' THEN o END) AS label, min(CASE WHEN p = 'identifier' THEN o END) AS identifier, count(*) FILTER (p IN ('label', 'identifier')) AS n_surfaces FROM t GROUP BY 1)
SELECT o.s AS id, coalesce(identifier, label, o.s) AS best, n_surfaces, coalesce(n, 0) AS n_in FROM o LEFT JOIN i ON i.s = o.s""")
def er_descriptions(spark, sf_dir):
    return acceptance.descriptions(triples(spark, sf_dir, "type", "label", "identifier", "contains")).select("id", "best", "n_surfaces", "n_in")


@query("""SELECT verdict, count(*) AS n FROM (SELECT CASE WHEN l_returnflag = 'A' THEN 'incompatible_entity_types'
 WHEN l_linenumber % 4 = 0 THEN CASE WHEN l_linenumber % 3 > l_linenumber % 2 AND l_quantity > 25 THEN 'expected_reference_key_literal_preferred' WHEN l_tax * 20 >= 1.05 AND l_discount * 5 >= 0.25 THEN 'strong_expected_alignment_improvement' ELSE 'insufficient_canonical_alignment_gain' END
 WHEN l_linenumber % 4 = 1 THEN CASE WHEN l_tax * 20 >= 0.9 AND l_linenumber % 3 >= l_linenumber % 2 THEN 'linkable_candidate_with_expected_alignment' ELSE 'insufficient_linking_alignment_gain' END
 WHEN l_linenumber % 4 = 2 THEN CASE WHEN l_tax * 20 >= 0.72 AND l_discount * 5 >= 0.12 THEN 'better_surface_literal_available' ELSE 'surface_gain_too_small' END ELSE 'unsupported_issue' END AS verdict FROM lineitem) GROUP BY 1""")
def er_candidate_decisions(spark, sf_dir):
    n = F.col("l_linenumber")
    issue = F.when(n % 4 == 0, "graph_canonicalization_gap").when(n % 4 == 1, "graph_linking_gap").when(n % 4 == 2, "missing_value_surface").otherwise("other")
    verdict = acceptance.decision(issue, F.col("l_returnflag") != "A", F.col("l_discount") * 5, F.col("l_tax") * 20, n % 2, n % 3, F.when(F.col("l_quantity") > 25, 0.85).otherwise(0.55))
    return table(spark, sf_dir, "lineitem").groupBy(verdict.alias("verdict")).agg(F.count("*").alias("n"))


MAPPED_SQL = """mp AS (SELECT 'Customer_' || c_custkey AS source, 'Customer_' || least_key AS target FROM customer JOIN (SELECT c_nationkey, c_mktsegment, min(c_custkey) AS least_key FROM customer GROUP BY 1, 2) USING (c_nationkey, c_mktsegment) WHERE c_custkey <> least_key),
ex AS (SELECT 'Customer_' || c_custkey AS source, 'Nation_' || c_nationkey AS extra FROM customer)"""


def mapped(spark, sf_dir):
    """Customers of one nation and segment as one, the one of least key; each with its nation as a link of its own."""
    c, same = table(spark, sf_dir, "customer"), ["c_nationkey", "c_mktsegment"]
    source = F.concat(F.lit("Customer_"), "c_custkey").alias("source")
    least = c.groupBy(*same).agg(F.min("c_custkey").alias("least_key"))
    mapping = c.join(least, same).where("c_custkey <> least_key").select(source, F.concat(F.lit("Customer_"), "least_key").alias("target"))
    return mapping, c.select(source, F.concat(F.lit("Nation_"), "c_nationkey").alias("extra"))


@query(view("type", "placedBy") + f""", {MAPPED_SQL}, rw AS (SELECT coalesce(m1.target, t.s) AS s, p, CASE WHEN kind = 'iri' AND p <> 'type' THEN coalesce(m2.target, t.o) ELSE t.o END AS o FROM t LEFT JOIN mp m1 ON m1.source = t.s LEFT JOIN mp m2 ON m2.source = t.o)
SELECT s, p, o FROM rw WHERE NOT (p <> 'type' AND s = o) UNION SELECT coalesce(m.target, t.s), t.p, extra FROM t JOIN ex ON ex.source = t.o AND kind = 'iri' AND p <> 'type' LEFT JOIN mp m ON m.source = t.s WHERE coalesce(m.target, t.s) <> extra""")
def er_supplemental_links(spark, sf_dir):
    mapping, extra = mapped(spark, sf_dir)
    return acceptance.with_supplements(triples(spark, sf_dir, "type", "placedBy"), mapping, extra).select("s", "p", "o")


@query(view("type", "placedBy") + f""", {MAPPED_SQL} SELECT count(m1.source) AS rewritten_subjects, count(*) FILTER (m2.source IS NOT NULL AND p <> 'type' AND kind = 'iri') AS rewritten_objects,
 count(*) FILTER (m1.source IS NOT NULL OR (m2.source IS NOT NULL AND p <> 'type' AND kind = 'iri')) AS rewritten_triples, 0::BIGINT AS skipped_loops FROM t LEFT JOIN mp m1 ON m1.source = t.s LEFT JOIN mp m2 ON m2.source = t.o""")
def er_rewrite_counts(spark, sf_dir):
    return acceptance.rewrite_counts(triples(spark, sf_dir, "type", "placedBy"), mapped(spark, sf_dir)[0])


@query("SELECT 'Customer_' || c_custkey AS source, 'Nation_' || c_nationkey AS target FROM customer WHERE c_acctbal >= 0")
def er_protected_anchors(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    candidates = c.select(F.concat(F.lit("Customer_"), "c_custkey").alias("source"), F.concat(F.lit("Nation_"), "c_nationkey").alias("target"))
    anchors = c.where("c_acctbal < 0").select(F.concat(F.lit("Customer_"), "c_custkey").alias("canonical"))
    return acceptance.protected(candidates, anchors)


@query("SELECT 'Nation_' || n_nationkey AS source, 'Region_' || n_regionkey AS target, 'absorbs' AS how FROM nation UNION ALL SELECT n_name, 'Region_' || n_regionkey, 'alias' FROM nation")
def merge_anchor_mappings(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    anchors = n.groupBy(F.concat(F.lit("Region_"), "n_regionkey").alias("canonical")).agg(F.collect_set(F.concat(F.lit("Nation_"), "n_nationkey")).alias("absorbs"), F.collect_set("n_name").alias("legacy_aliases"))
    return acceptance.anchor_mapping(anchors).withColumn("how", F.lit("absorbs")).unionByName(acceptance.anchor_mapping(anchors, "legacy_aliases").withColumn("how", F.lit("alias")))


ROLES = ("directive", "machine", "consumable", "maintenance", "interface", "component", "reference")
ROLE_SQL = "[" + ", ".join(f"'{r}'" for r in ROLES) + "]"


@query(f"""WITH r AS (SELECT l_linenumber AS a, l_suppkey % 7 AS b, l_orderkey % 3 AS q FROM lineitem), x AS (SELECT {ROLE_SQL}[1 + a % 7] AS s, {ROLE_SQL}[CAST(1 + b AS INT)] AS t, q FROM r),
y AS (SELECT CASE WHEN s = 'machine' AND t = 'directive' THEN 'complies' WHEN s = 'directive' AND t = 'machine' THEN '-complies' WHEN t = 'consumable' AND s <> 'consumable' AND q = 0 THEN 'requiresConsumable' WHEN s = 'consumable' AND t <> 'consumable' AND q = 0 THEN '-requiresConsumable'
 WHEN s = 'maintenance' AND t <> 'maintenance' THEN '-requiresMaintenance' WHEN t = 'maintenance' AND q = 1 THEN 'requiresMaintenance' WHEN s = 'interface' AND t = 'component' THEN 'hasComponent' WHEN s = 'component' AND t = 'interface' THEN '-hasComponent'
 WHEN s = 'reference' OR t = 'reference' THEN CASE WHEN q = 2 THEN 'detailedIn' ELSE 'shownIn' END END AS link FROM x) SELECT link, count(*) AS n FROM y GROUP BY 1""")
def enrich_link_relations(spark, sf_dir):
    role = lambda c: F.element_at(F.array(*map(F.lit, ROLES)), (c % 7 + 1).cast("int"))
    q = F.element_at(F.array(F.lit("which grease"), F.lit("what maintenance"), F.lit("on which plan")), (F.col("l_orderkey") % 3 + 1).cast("int"))
    rule = acceptance.link_relation(role(F.col("l_linenumber")), role(F.col("l_suppkey")), q)
    link = F.when(rule["flipped"], F.concat(F.lit("-"), rule["predicate"])).otherwise(rule["predicate"])
    return table(spark, sf_dir, "lineitem").groupBy(link.alias("link")).agg(F.count("*").alias("n"))


WANTED_SQL = f"wanted AS (SELECT n_nationkey AS key, {words_of_sql('n_name')} AS words FROM nation)"


def wanted(spark, sf_dir):
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("key"), text.phrases(F.col("n_name"), (1,)).alias("words"))


@query(view("label") + f""", {WANTED_SQL}, said AS (SELECT DISTINCT s, unnest({words_of_sql('o')}) AS w FROM t), need AS (SELECT key, unnest(list_distinct(words)) AS w, len(list_distinct(words)) AS n FROM wanted),
hit AS (SELECT key, s FROM need JOIN said USING (w) GROUP BY key, s, n HAVING count(*) = n), one AS (SELECT key, min(s) AS id FROM hit GROUP BY 1 HAVING count(*) = 1) SELECT key, id, o AS excerpt FROM one JOIN t ON t.s = id""")
def enrich_found_by_text(spark, sf_dir):
    """Entities that alone hold all words wanted, with the literal that does."""
    t, w = triples(spark, sf_dir, "label"), wanted(spark, sf_dir)
    return acceptance.excerpts(t, acceptance.found_by_text(t, w), w)


@query(f"WITH n AS (SELECT 'customer/' || split_part(c_name, '#', 2) AS id FROM customer UNION SELECT 'supplier/' || split_part(s_name, '#', 2) FROM supplier), l AS (SELECT {LOCAL_SQL.format('id')} AS local, id FROM n) SELECT local, min(id) AS id FROM l GROUP BY 1 HAVING count(*) = 1")
def enrich_unique_locals(spark, sf_dir):
    name = lambda t, c: table(spark, sf_dir, t).select(F.concat(F.lit(f"{t}/"), F.split_part(F.col(c), F.lit("#"), F.lit(2))).alias("s"))
    t = name("customer", "c_name").union(name("supplier", "s_name"))
    return acceptance.unique_local_names(t)


@query(view("label", "identifier") + f""", q AS (SELECT n_nationkey AS id, n_name || ' customer steel' AS text FROM nation), w AS (SELECT id, unnest({SIGNIFICANT_SQL.format(tokens_sql('text', 3))}) AS word FROM q), nm AS (SELECT DISTINCT s AS node, unnest({tokens_sql('o', 3)}) AS word FROM t),
h AS (SELECT id, node, 2 * count(*) AS score FROM w JOIN nm USING (word) GROUP BY 1, 2) SELECT id, node, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, node) AS rank FROM h) WHERE rank <= 10""")
def plan_generic_candidates(spark, sf_dir):
    """Candidates by words of any frequency: one of these words is held by every customer."""
    q = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.concat("n_name", F.lit(" customer steel")).alias("text"))
    return plan.generic_candidates(q, triples(spark, sf_dir, "label", "identifier"))


# ---------------------------------------------------------------- semantic categories

FAULTS = (
    ("Nation_1", "type", "Region_2", "iri"), ("Nation_2", "type", "Lake", "iri"), ("Customer_3", "type", "Party", "iri"), ("_:b1", "label", "x", "literal"), ("file:///a/b", "label", "y", "literal"),
    ("Part_1", "value", "Nation_1", "iri"), ("untyped", "label", "z", "literal"), ("Alone", "type", "Region", "iri"), ("L" + "o" * 110 + "ng", "type", "Nation", "iri"),
)
CLASSES = ("Region", "Nation", "Customer", "Party", "Part")
PROPERTIES = ("type", "label", "identifier", "inNation", "inRegion", "value")
FAULT_SQL = f"t AS ({triples_sql('type', 'label', 'identifier', 'inNation', 'inRegion', 'segment')} UNION ALL SELECT s, p, o, kind, NULL FROM ({relation_sql(FAULTS, 's', 'p', 'o', 'kind')}))"
NAME_SQL = LOCAL_SQL.format("s")
SEMANTIC_SQL = f"""{FAULT_SQL}, {CLOSURE_SQL},
own AS (SELECT s, bool_or(p = 'type' AND kind = 'iri') AS typed, bool_or(p = 'identifier') AS traced, bool_or(p IN ('label', 'identifier')) AS named, count(*) FILTER (kind = 'iri' AND p <> 'type') AS n_out, count(*) FILTER (p = 'value' AND kind = 'iri') AS n_value FROM t GROUP BY s),
inn AS (SELECT o AS s, count(*) AS n_in FROM t WHERE kind = 'iri' AND p <> 'type' GROUP BY 1),
nd AS (SELECT coalesce(own.s, inn.s) AS s, own.s IS NOT NULL AS subj, coalesce(typed, false) AS typed, coalesce(traced, false) AS traced, coalesce(named, false) AS named, coalesce(n_out, 0) AS n_out, coalesce(n_in, 0) AS n_in, coalesce(n_value, 0) AS n_value, starts_with(coalesce(own.s, inn.s), '_:') AS blank FROM own FULL JOIN inn ON own.s = inn.s),
unk AS (SELECT class AS s, count(*) AS n FROM types WHERE class NOT IN ({words_sql(CLASSES)}) GROUP BY 1),
f AS (SELECT 'missing_type' AS category, s, 1 AS n FROM nd WHERE subj AND NOT blank AND NOT typed UNION ALL SELECT 'missing_traceability', s, 1 FROM nd WHERE typed AND NOT blank AND NOT traced
 UNION ALL SELECT 'weak_linkage', s, 1 FROM nd WHERE typed AND NOT blank AND n_out + n_in = 0 UNION ALL SELECT 'blank_node_entity', s, 1 FROM nd WHERE subj AND blank AND (typed OR named)
 UNION ALL SELECT 'file_uri_entity', s, 1 FROM nd WHERE starts_with(s, 'file:///') UNION ALL SELECT DISTINCT 'redundant_type_assertion', a.s, 1 FROM types a JOIN types b ON a.s = b.s JOIN up ON up.child = b.class AND up.ancestor = a.class
 UNION ALL SELECT 'long_local_name', s, 1 FROM nd WHERE subj AND length({NAME_SQL}) > 100 UNION ALL SELECT 'value_used_as_object_property', s, n_value FROM nd WHERE n_value > 0
 UNION ALL SELECT 'non_canonical_class', s, n FROM unk UNION ALL SELECT 'individual_used_as_class', s, n FROM unk WHERE s IN (SELECT s FROM own WHERE typed OR named) OR regexp_matches({NAME_SQL}, '_[0-9a-f]{{10}}$|[A-Z][a-z]+[0-9]+|_[0-9]+$|[0-9]{{4,}}')
 UNION ALL SELECT 'non_canonical_property', p, count(*) FROM t WHERE p NOT IN ({words_sql(PROPERTIES)}) GROUP BY p)"""


def semantic(spark, sf_dir):
    wrong = relation(spark, FAULTS, "s", "p", "o", "kind").withColumn("lang", F.lit(None).cast("string"))
    t = triples(spark, sf_dir, "type", "label", "identifier", "inNation", "inRegion", "segment").unionByName(wrong)
    one = lambda names, c: relation(spark, tuple((n,) for n in names), c)
    return validate.semantic(t, one(CLASSES, "class"), one(PROPERTIES, "property"), ontology.closure(subclasses(spark)), traced="identifier")


@query(f"WITH RECURSIVE {SEMANTIC_SQL} SELECT category, CAST(sum(n) AS BIGINT) AS n, array_to_string(list_sort(list(DISTINCT {NAME_SQL}))[1:15], ',') AS samples FROM f GROUP BY 1")
def val_semantic(spark, sf_dir):
    return semantic(spark, sf_dir).select("category", "n", F.array_join("samples", ",").alias("samples"))


@query(f"WITH RECURSIVE {SEMANTIC_SQL}, h AS (SELECT coalesce(sum(n) FILTER (category IN ({words_sql(validate.HARD)})), 0) AS a, coalesce(sum(n) FILTER (category NOT IN ({words_sql(validate.HARD)})), 0) AS b FROM f) SELECT a = 0 AS ok, CAST(a AS BIGINT) AS n_hard, CAST(b AS BIGINT) AS n_soft FROM h")
def val_passed(spark, sf_dir):
    return validate.passed(semantic(spark, sf_dir))


DECLARED = ("label", "inNation", "inRegion", "neverUsed")


@query(view("type", "label", "inNation", "inRegion", "segment") + f""", u AS (SELECT p, count(*) AS n, array_to_string(list_sort(list(DISTINCT s))[1:3], ',') AS samples FROM t WHERE p <> 'type' GROUP BY 1), d AS ({relation_sql(tuple((x,) for x in DECLARED), 'property')})
SELECT coalesce(property, p) AS property, coalesce(n, 0) AS n, CASE WHEN property IS NULL THEN 'orphan' WHEN p IS NULL THEN 'dead' ELSE 'used' END AS status, coalesce(samples, '') AS samples FROM u FULL JOIN d ON p = property""")
def val_predicate_usage(spark, sf_dir):
    t = triples(spark, sf_dir, "type", "label", "inNation", "inRegion", "segment")
    return validate.predicate_usage(t, relation(spark, tuple((x,) for x in DECLARED), "property")).withColumn("samples", F.array_join("samples", ","))


# ---------------------------------------------------------------- answers and diagnosis

MANUAL_SQL = "(SELECT doc_id, 'Rights reserved to ' || source || ' works. Press [START] in AUTO or Jog mode. Address: ' || source || ' street 4. Phone: 55' AS x FROM documents)"


@query(f"""SELECT doc_id, trim(regexp_extract(x, '(?i)reserved to (.+?)(?:\\.|$)', 1)) AS owner, upper(regexp_extract(x, '\\[START\\]')) AS key, array_to_string(regexp_extract_all(x, '(?i)(Automatic mode|Jog mode|MDI/MDA mode|EDIT|AUTO|MANUAL|MDI)'), ', ') AS modes,
 regexp_replace(regexp_extract(x, '(?i)address\\s*:\\s*(.*?)\\bphone', 1), '[\\s.;,:]+$', '') AS address FROM {MANUAL_SQL}""")
def syn_extractors(spark, sf_dir):
    x = F.concat(F.lit("Rights reserved to "), "source", F.lit(" works. Press [START] in AUTO or Jog mode. Address: "), "source", F.lit(" street 4. Phone: 55"))
    return table(spark, sf_dir, "documents").select("doc_id", answer.ownership(x).alias("owner"), answer.control_key(x).alias("key"), answer.mode_literals(x).alias("modes"), answer.postal_address(x).alias("address"))


def count_sql(c: str) -> str:
    return f"greatest(len({SIGNIFICANT_SQL.format(tokens_sql(c, 3))}), 1)"


MODES = ("exact", "high_partial", "partial", "weak", "none")
MODE_SQL = "[" + ", ".join(f"'{m}'" for m in MODES) + "]"


@query(f"""WITH c AS (SELECT conv_id, turn, {MODE_SQL}[CAST(1 + conv_id % 5 AS INT)] AS mode, CASE conv_id % 4 WHEN 0 THEN text || ' ' || text || ' ' || reverse(text) WHEN 1 THEN 'User_' || conv_id WHEN 2 THEN '' ELSE 'the river of stone' END AS actual, text FROM conversations)
SELECT conv_id, turn, CASE WHEN {norm_sql('actual')} = '' THEN 'underspecified' WHEN regexp_matches(actual, 'https?://|_|[A-Z][a-z]+[A-Z][A-Za-z0-9]+') OR regexp_matches(actual, '^[A-Za-z]+([0-9]+|_[0-9]+)+(_[A-Za-z0-9]+)*$') THEN 'identifier_heavy'
 WHEN {count_sql('actual')} > greatest(2 * {count_sql('text')}, 20) AND mode IN ('partial', 'weak') THEN 'overspecified' WHEN mode IN ('exact', 'high_partial') THEN 'clean' ELSE 'acceptable' END AS quality FROM c""")
def eval_surface_quality(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    n = F.col("conv_id") % 4
    actual = F.when(n == 0, F.concat_ws(" ", "text", "text", F.reverse("text"))).when(n == 1, F.concat(F.lit("User_"), "conv_id")).when(n == 2, "").otherwise("the river of stone")
    mode = F.element_at(F.array(*map(F.lit, MODES)), (F.col("conv_id") % 5 + 1).cast("int"))
    return c.select("conv_id", "turn", diagnose.surface_quality(F.col("text"), actual, mode).alias("quality"))


QUALITIES = ("clean", "acceptable", "overspecified", "identifier_heavy")
GAP_SQL = f"""x AS (SELECT l_orderkey * 10 + l_linenumber AS id, l_discount > 0.01 AS bounded, l_linenumber - 1 AS n_rows, l_tax * 10 AS confidence, l_quantity > 25 AS fallback, CASE WHEN l_suppkey % 6 = 0 THEN 'graph_linking_gap' WHEN l_suppkey % 6 = 1 THEN 'graph_canonicalization_gap' ELSE '' END AS issue,
 [{words_sql(QUALITIES)}][CAST(1 + l_partkey % 4 AS INT)] AS quality, {MODE_SQL}[CAST(1 + l_orderkey % 5 AS INT)] AS mode, l_linenumber % 3 AS n_selected, l_returnflag = 'N' AS chosen, l_suppkey % 2 = 0 AS better, l_partkey % 3 AS n_lit, l_tax > 0.04 AS hit FROM lineitem),
y AS (SELECT *, CASE WHEN quality = 'identifier_heavy' THEN 'identifier_instead_of_surface' WHEN better THEN 'better_literal_exists' WHEN n_lit > 0 AND NOT hit THEN 'canonical_reference_missing' ELSE 'none' END AS reference FROM x),
g AS (SELECT *, CASE WHEN NOT bounded THEN 'boundedness_gap' WHEN n_rows = 0 AND confidence >= 0.55 AND NOT fallback THEN 'planner_gap' WHEN issue <> '' THEN issue WHEN quality = 'identifier_heavy' THEN 'missing_value_surface' WHEN reference = 'canonical_reference_missing' THEN 'answer_reference_mismatch'
 WHEN mode = 'none' AND n_selected > 0 THEN 'graph_linking_gap' WHEN mode = 'none' THEN 'planner_gap' WHEN n_selected > 0 AND mode IN ('partial', 'weak') AND quality IN ('acceptable', 'overspecified') THEN 'synthesis_surface_gap' WHEN n_selected > 0 AND mode IN ('exact', 'high_partial') AND chosen THEN 'needs_expected_uris_promotion' ELSE 'ok_structurally' END AS gap FROM y)"""


def gaps(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    at = lambda names, c: F.element_at(F.array(*map(F.lit, names)), (c % len(names) + 1).cast("int"))
    s = F.col("l_suppkey") % 6
    r = li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), (F.col("l_discount") > 0.01).alias("bounded"), (F.col("l_linenumber") - 1).alias("n_rows"), (F.col("l_tax") * 10).alias("confidence"), (F.col("l_quantity") > 25).alias("fallback"),
        F.when(s == 0, "graph_linking_gap").when(s == 1, "graph_canonicalization_gap").otherwise("").alias("issue"), at(QUALITIES, F.col("l_partkey")).alias("quality"), at(MODES, F.col("l_orderkey")).alias("mode"), (F.col("l_linenumber") % 3).alias("n_selected"),
        (F.col("l_returnflag") == "N").alias("chosen"), (F.col("l_suppkey") % 2 == 0).alias("better"), (F.col("l_partkey") % 3).alias("n_lit"), (F.col("l_tax") > 0.04).alias("hit"),
    )
    r = r.withColumn("reference", diagnose.reference_gap(F.col("quality"), F.col("better"), F.col("n_lit"), F.col("hit")))
    return r.withColumn("gap", diagnose.structural_gap({c: F.col(c) for c in r.columns}))


@query(f"WITH {GAP_SQL} SELECT reference, gap, count(*) AS n FROM g GROUP BY 1, 2")
def eval_gaps(spark, sf_dir):
    return gaps(spark, sf_dir).groupBy("reference", "gap").agg(F.count("*").alias("n"))


@query(f"WITH {GAP_SQL}, c AS (SELECT gap, count(*) AS n FROM g WHERE gap NOT IN ({words_sql(diagnose.FINE)}) GROUP BY 1), m AS ({relation_sql(tuple(diagnose.NEXT.items()), 'gap', 'work')}) SELECT work, c.gap FROM c JOIN m ON m.gap = c.gap ORDER BY n DESC, c.gap LIMIT 1")
def eval_next_change(spark, sf_dir):
    return diagnose.next_change(gaps(spark, sf_dir).select("gap"))


@query(f"WITH {GAP_SQL} SELECT id, chosen OR better AS promote, CASE WHEN chosen THEN 'A' || id WHEN better THEN 'B' || id END AS expected FROM g WHERE gap IN ({words_sql(diagnose.FINE)}) AND mode IN ('exact', 'high_partial')")
def eval_promotions(spark, sf_dir):
    g = gaps(spark, sf_dir)
    named = g.select("id", "gap", "mode", F.when(F.col("chosen"), F.concat(F.lit("A"), "id")).alias("chosen"), F.when(F.col("better"), F.concat(F.lit("B"), "id")).alias("candidate"))
    return diagnose.promotions(named)


@query("""SELECT planner, pair, count(*) AS n FROM (SELECT CASE WHEN l_linenumber = 7 THEN 'benchmark_runner_blocker' WHEN NOT l_suppkey % 2 = 0 THEN 'anchor_normalization_gap' WHEN NOT l_partkey % 3 > 0 THEN 'family_selection_gap' WHEN NOT l_tax > 0.02 THEN 'sparql_convergence_gap' WHEN NOT l_quantity > 10 THEN 'cross_family_missing' END AS planner,
 CASE WHEN l_linenumber = 7 THEN 'benchmark_runner_blocker' WHEN NOT l_partkey % 3 > 0 THEN 'cross_planner_gap' WHEN l_linenumber = 1 AND l_suppkey % 3 = 0 THEN 'cross_document_coverage_gap' WHEN NOT (l_tax > 0.02 AND l_quantity > 10) THEN 'cross_surface_gap' END AS pair FROM lineitem) GROUP BY 1, 2""")
def eval_failure_causes(spark, sf_dir):
    c = F.col
    planner = diagnose.planner_failure(c("l_linenumber") == 7, c("l_suppkey") % 2 == 0, c("l_partkey") % 3 > 0, c("l_tax") > 0.02, c("l_quantity") > 10)
    pair = diagnose.pair_failure(c("l_linenumber") == 7, c("l_partkey") % 3 > 0, c("l_linenumber") - 1, c("l_suppkey") % 3, c("l_tax") > 0.02, c("l_quantity") > 10)
    return table(spark, sf_dir, "lineitem").groupBy(planner.alias("planner"), pair.alias("pair")).agg(F.count("*").alias("n"))


CUE_SQL = " OR ".join(f"contains({{0}}, '{w}')" for w in diagnose.RUNTIME_CUES)


@query(f"WITH {QUESTIONS_SQL} SELECT id, bool_or({CUE_SQL.format('lower(text)')}) AS cue, bool_or({CUE_SQL.format('lower(text)')} OR id % 3 = 0) AS strict FROM q GROUP BY 1")
def qst_runtime_context(spark, sf_dir):
    q = questions(spark, sf_dir).select("id", diagnose.runtime_context((F.col("id") % 3 == 0).cast("int"), F.lit(0), F.col("text")).alias("c"))
    return q.groupBy("id").agg(F.max("c.cue").alias("cue"), F.max("c.strict").alias("strict"))


@query("SELECT source, count(*) AS n, round(count(*) FILTER (lang = 'en') / count(*), 4) AS share, count(*) FILTER (lang = 'en') >= 0.6 * count(*) AS mostly FROM documents GROUP BY 1")
def ing_mostly_english(spark, sf_dir):
    return diagnose.mostly_in(table(spark, sf_dir, "documents").select("source", F.col("lang").alias("language")), "source", "en")


@query("SELECT source AS stage, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS n_bytes, max(doc_id) AS latest FROM documents GROUP BY 1")
def orch_snapshot(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return diagnose.snapshot(d.select(F.col("source").alias("stage"), F.col("doc_id").alias("path"), F.col("n_chars").alias("n_bytes"), F.col("doc_id").alias("written")))


# ---------------------------------------------------------------- lexicon, cascade, decisions

LEXICON_SQL = f"""e AS (SELECT DISTINCT s AS uri, o AS surface, p AS kind FROM t WHERE p IN ('label', 'identifier')),
tm AS (SELECT DISTINCT replace({norm_sql('p_brand')}, ' ', '') AS key, p_type AS alias FROM part), en AS (SELECT uri, surface, kind FROM e UNION SELECT uri, alias, 'alias' FROM e JOIN tm ON key = replace({norm_sql('surface')}, ' ', '') WHERE kind = 'identifier')"""


def lexicon_entries(spark, sf_dir):
    terms = table(spark, sf_dir, "part").select(F.col("p_brand").alias("term"), F.col("p_type").alias("alias"))
    return lexicon.enriched(lexicon.entries(triples(spark, sf_dir, "type", "label", "identifier")), terms)


@query(view("label", "identifier") + f", {LEXICON_SQL} SELECT uri, surface, kind FROM en")
def lex_enriched(spark, sf_dir):
    return lexicon_entries(spark, sf_dir).select("uri", "surface", "kind")


@query(view("label", "identifier") + f""", {LEXICON_SQL}, k AS (SELECT DISTINCT {norm_sql('surface')} AS surface, uri FROM en), r AS (SELECT *, row_number() OVER (PARTITION BY surface ORDER BY uri) AS i, count(*) OVER (PARTITION BY surface) AS n_uris FROM k WHERE length(surface) >= 3)
SELECT surface, n_uris, array_to_string(list_sort(list(uri)), ',') AS uris FROM r WHERE i <= 10 GROUP BY 1, 2""")
def lex_index(spark, sf_dir):
    return lexicon.index(lexicon_entries(spark, sf_dir)).withColumn("uris", F.array_join("uris", ","))


@query(view("label", "identifier") + f", {LEXICON_SQL} SELECT count(DISTINCT uri) AS entry_count, count(DISTINCT {norm_sql('surface')}) AS surface_count, 0 AS n_languages FROM en")
def lex_payload(spark, sf_dir):
    return lexicon.payload(lexicon_entries(spark, sf_dir)).select("entry_count", "surface_count", F.size("languages").alias("n_languages"))


@query(f"WITH n AS (SELECT url AS uri FROM pages UNION SELECT 'http://e.org/' || n_name FROM nation) SELECT {LOCAL_SQL.format('uri')} AS local, min(uri) AS uri FROM n GROUP BY 1")
def lex_uri_map(spark, sf_dir):
    n = table(spark, sf_dir, "pages").select(F.col("url").alias("s")).union(table(spark, sf_dir, "nation").select(F.concat(F.lit("http://e.org/"), "n_name").alias("s")))
    return lexicon.uri_map(n)


STRICT = (("bulk", "large"), ("bulk", "cheap"), ("open_order", "open"), ("late", "late"))
STRICT_SQL = "st AS (" + relation_sql(STRICT, "family", "grp") + ")"


@query(f"""WITH {STRICT_SQL}, g AS (SELECT DISTINCT l_orderkey AS id, unnest([CASE WHEN l_quantity > 30 THEN 'large' END, CASE WHEN l_discount > 0.05 THEN 'cheap' END, CASE WHEN l_linestatus = 'O' THEN 'open' END]) AS grp FROM lineitem),
s AS (SELECT id, family, count(*) AS n FROM g JOIN st USING (grp) GROUP BY 1, 2 HAVING count(*) = (SELECT count(*) FROM st x WHERE x.family = any_value(st.family))),
f AS (SELECT id, family FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY n DESC, family) AS r FROM s WHERE id % 3 <> 0) WHERE r = 1)
SELECT o_orderkey AS id, coalesce(f.family, CASE WHEN o_totalprice > 100000 THEN 'costly' END, 'generic') AS family, CASE WHEN f.family IS NOT NULL THEN 'strict' WHEN o_totalprice > 100000 THEN 'scored' ELSE 'fallback' END AS how FROM orders LEFT JOIN f ON f.id = o_orderkey""")
def plan_cascade(spark, sf_dir):
    li, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_totalprice")
    has = F.array_compact(F.array(F.when(F.col("l_quantity") > 30, "large"), F.when(F.col("l_discount") > 0.05, "cheap"), F.when(F.col("l_linestatus") == "O", "open")))
    strict = plan.strict_families(li.select(F.col("l_orderkey").alias("id"), F.explode(has).alias("group")), relation(spark, STRICT, "family", "group"))
    scored = o.select("id", F.lit("costly").alias("family"), F.when(F.col("o_totalprice") > 100000, 2).otherwise(0).alias("score"))
    return plan.cascade(o, strict, scored, o.where("id % 3 <> 0"))


@query("""WITH c AS (SELECT 'orders' AS name, bool_and(o_totalprice > 0) AS ok FROM orders UNION ALL SELECT 'documents', bool_and(n_chars > 100) FROM documents) SELECT bool_and(ok) AS ready, array_to_string(list_sort(list(name) FILTER (NOT ok)), ',') AS blockers FROM c""")
def orch_decision(spark, sf_dir):
    checks = stages.checked(("orders", table(spark, sf_dir, "orders").select((F.col("o_totalprice") > 0).alias("ok"))), ("documents", table(spark, sf_dir, "documents").select((F.col("n_chars") > 100).alias("ok"))))
    return stages.decision(checks).withColumn("blockers", F.array_join("blockers", ","))


@query(view("type", "suppliedBy") + " SELECT s FROM t WHERE p = 'type' AND o = 'Part' AND s NOT IN (SELECT s FROM t WHERE p = 'suppliedBy' AND o = 'Supplier_1')")
def kg_anti_bound_object(spark, sf_dir):
    """Parts that one supplier doesn't supply: an anti-join that leaves rows at every scale."""
    t = triples(spark, sf_dir, "type", "suppliedBy")
    its = patterns.match(t, p="suppliedBy", o="Supplier_1").select("s")
    return patterns.match(t, p="type", o="Part").join(its, "s", "left_anti").select("s")
