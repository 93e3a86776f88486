"""Queries of clustering, counters of repairs, keys of names, remote terms and the completion of links."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import surfaces, text
from .operators import acceptance, ingest, linkage, ontology, resolve, sanitize
from .plans import triples as T
from .plans.triples import relation, relation_sql, table
from .queries import extended, norm_sql, query, subclasses, words_sql


@query()
def er_average_linkage(spark, sf_dir):
    """Parts whose brand, name and type are nearly the same words, as clusters (tested against pairwise merging)."""
    p = table(spark, sf_dir, "part")
    return linkage.average_linkage(p.select(F.concat(F.lit("Part_"), "p_partkey").alias("id"), F.concat_ws(" ", "p_brand", "p_name", "p_type").alias("label")))


@query()
def san_counters(spark, sf_dir):
    """What each repair did to the extended graph (tested on a small graph)."""
    from .queries_more import KEYWORDS

    t = extended(spark, sf_dir, "label", "identifier", "extract", "inNation")
    return sanitize.counted(t, relation(spark, T.DOMAINS, "property", "class"), ontology.closure(subclasses(spark)), rules=KEYWORDS)[1]


SURFACE_SQL = "CASE c_mktsegment WHEN 'MACHINERY' THEN 'table' WHEN 'BUILDING' THEN '' ELSE c_name END"
CONTEXT_SQL = "CASE WHEN c_nationkey < 5 THEN '' WHEN c_nationkey < 8 THEN '##' ELSE 'Nation ' || c_nationkey END"
GENERIC_SQL = "({0} = '' OR {0} IN (" + words_sql(surfaces.GENERIC) + ") OR (NOT contains({0}, ' ') AND {1} = lower({1})))"


@query(f"""WITH c AS (SELECT c_custkey AS id, {SURFACE_SQL} AS s, {CONTEXT_SQL} AS x FROM customer), n AS (SELECT *, {norm_sql('s')} AS own, {norm_sql('x')} AS said FROM c),
k AS (SELECT id, s, {GENERIC_SQL.format('own', 's')} AS weak, 'customer|' || own || CASE WHEN x = '' OR x = s THEN '' WHEN said <> '' THEN '|' || said[1:80] ELSE '|' || sha256(x)[1:10] END AS strong,
 'customer|' || CASE WHEN said <> '' THEN said WHEN x <> '' THEN sha256(x)[1:10] ELSE sha256('Customer')[1:10] END AS other FROM n)
SELECT id, CASE WHEN weak THEN other ELSE strong END AS key, CASE WHEN weak THEN 'Customer_' || sha256(other)[1:10] ELSE replace(s, '#', '') END AS name, weak FROM k""")
def mint_keys(spark, sf_dir):
    """Keys and names of customers, some of whom only their context tells apart."""
    c, sides = table(spark, sf_dir, "customer"), (SURFACE_SQL, CONTEXT_SQL)
    return c.select(F.col("c_custkey").alias("id"), resolve.mint_key(F.lit("Customer"), *map(F.expr, sides)).alias("m")).select("id", "m.*")


@query(f"""WITH p AS (SELECT p_partkey AS id, CASE WHEN p_type = 'ECONOMY' THEN 'Table' ELSE p_type END AS local, CASE WHEN p_size < 17 THEN p_brand WHEN p_size < 34 THEN upper(p_type) ELSE p_name || ' ' || p_size END AS s,
 CASE WHEN p_partkey % 3 = 0 THEN 'identifier' WHEN p_partkey % 3 = 1 THEN 'label' END AS said_by FROM part), n AS (SELECT *, {norm_sql('s')} AS ns, {norm_sql('local')} AS nl, coalesce(said_by = 'identifier', false) AS i FROM p)
SELECT id, (i AND regexp_matches(s, '^[A-Z0-9_#.\\-\\[\\]=]+$')) OR regexp_matches(ns, '^\\S+( \\S+)* [0-9]+$') OR ({GENERIC_SQL.format('nl', 'local')} AND (i OR (s <> '' AND ns <> nl))) OR (i AND {GENERIC_SQL.format('ns', 's')}) AS again FROM n""")
def mint_again(spark, sf_dir):
    """Which names should be minted anew, by what the preferred surface is and where it is from."""
    local = F.when(F.col("p_type") == "ECONOMY", "Table").otherwise(F.col("p_type"))
    s = F.when(F.col("p_size") < 17, F.col("p_brand")).when(F.col("p_size") < 34, F.upper("p_type")).otherwise(F.concat_ws(" ", "p_name", F.col("p_size").cast("string")))
    by = F.when(F.col("p_partkey") % 3 == 0, "identifier").when(F.col("p_partkey") % 3 == 1, "label")
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), resolve.should_remint(local, s, by).alias("again"))


def concepts(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    lang = F.when(F.col("p_size") < 25, "es").otherwise("en")
    return p.select(F.concat(F.lit("c"), "p_partkey").alias("concept"), F.concat_ws(" ", "p_name", "p_brand").alias("label"), lang.alias("lang"), F.col("p_type").alias("category"))


CONCEPTS_SQL = "k AS (SELECT 'c' || p_partkey AS concept, p_name || ' ' || p_brand AS label, CASE WHEN p_size < 25 THEN 'es' ELSE 'en' END AS lang, p_type AS category FROM part)"


@query(f"WITH {CONCEPTS_SQL}, w AS (SELECT DISTINCT lower(p_name || ' ' || p_brand) AS term FROM part WHERE p_retailprice > 950) SELECT category, count(*) AS n FROM (SELECT DISTINCT lower(trim(label)) AS term, concept, category FROM k) JOIN w USING (term) GROUP BY 1 ORDER BY n DESC, category LIMIT 7")
def ing_leading_categories(spark, sf_dir):
    terms = table(spark, sf_dir, "part").where("p_retailprice > 950").select(F.lower(F.concat_ws(" ", "p_name", "p_brand")).alias("term"))
    return ingest.leading_categories(terms, concepts(spark, sf_dir))


@query(f"""WITH {CONCEPTS_SQL}, g AS (SELECT category, row_number() OVER (ORDER BY category) AS rank FROM (SELECT DISTINCT category FROM k)), o AS (SELECT DISTINCT category, concept, lower(trim(label)) AS term FROM k WHERE lang = 'es' AND length(label) >= 4),
t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY term, concept) AS i FROM o) JOIN g USING (category) WHERE i <= 200 AND len(regexp_split_to_array(term, '\\s+')) <= 4)
SELECT term, concept, category FROM (SELECT *, row_number() OVER (PARTITION BY term ORDER BY rank, concept) AS f FROM t) WHERE f = 1""")
def ing_category_terms(spark, sf_dir):
    from pyspark.sql import Window

    k = concepts(spark, sf_dir)
    ranks = k.select("category").distinct().withColumn("rank", F.row_number().over(Window.orderBy("category")))  # a row a category
    return ingest.category_terms(k, ranks, "es")


@query("""WITH x AS (SELECT p_brand AS name, 'Part_' || min(p_partkey) AS entity FROM part WHERE p_type <> 'ECONOMY' GROUP BY 1), e AS (SELECT l_orderkey AS id, l_linenumber AS rank, p_brand AS name FROM lineitem JOIN part ON p_partkey = l_partkey)
SELECT id, entity FROM (SELECT id, entity, row_number() OVER (PARTITION BY id ORDER BY rank, entity) AS r FROM e JOIN x USING (name)) WHERE r = 1""")
def er_chosen_entities(spark, sf_dir):
    p, li = table(spark, sf_dir, "part"), table(spark, sf_dir, "lineitem")
    index = p.where("p_type <> 'ECONOMY'").groupBy("p_brand").agg(F.min("p_partkey").alias("k")).select(F.col("p_brand").alias("name"), F.concat(F.lit("Part_"), "k").alias("entity"))
    evidence = li.join(p, li.l_partkey == p.p_partkey).select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("rank"), F.col("p_brand").alias("name"))
    return acceptance.chosen_entities(evidence, index)


@query("""SELECT issue, count(*) AS n FROM (SELECT CASE WHEN l_linestatus = 'O' AND l_discount * 10 >= greatest(l_tax * 10 + 0.2, 0.85) THEN 'graph_canonicalization_gap'
 WHEN l_linenumber > 1 AND l_returnflag = 'N' AND l_linestatus = 'O' THEN 'graph_linking_gap' ELSE 'none' END AS issue FROM lineitem) GROUP BY 1""")
def er_resolution_issues(spark, sf_dir):
    best = F.when(F.col("l_linestatus") == "O", F.col("l_discount") * 10)
    issue = acceptance.resolution_issue(F.col("l_linenumber") - 1, F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")), F.col("l_tax") * 10, best)
    return table(spark, sf_dir, "lineitem").groupBy(F.coalesce(issue, F.lit("none")).alias("issue")).agg(F.count("*").alias("n"))


GAPS = (("F", "1"), ("O", "2"))


@query(f"""WITH g AS ({relation_sql(GAPS, 'gap', 'priority')}), b AS (SELECT * FROM (SELECT l_orderkey AS id, 'Part_' || l_partkey AS target, CAST(l_quantity AS DOUBLE) AS score, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, 'Part_' || l_partkey) AS r FROM lineitem) WHERE r = 1)
SELECT o_orderkey AS id, gap, CASE WHEN o_totalprice > 1000 THEN 'Customer_' || o_custkey END AS entity, target, coalesce(score, 0) AS score, CASE WHEN o_totalprice > 1000 THEN 'accepted' ELSE 'missing_entity' END AS status
FROM orders JOIN g ON gap = o_orderstatus LEFT JOIN b ON b.id = o_orderkey""")
def enrich_corpus(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    results = o.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("gap"), F.when(F.col("o_totalprice") > 1000, F.concat(F.lit("Customer_"), "o_custkey")).alias("entity"))
    targets = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), F.concat(F.lit("Part_"), "l_partkey").alias("target"), F.col("l_quantity").cast("double").alias("score"))
    return acceptance.enrichment_corpus(results, targets, relation(spark, GAPS, "gap", "priority"))


#: Families by words between white space, as word boundaries beside accented letters differ between engines.
FAMILIES = (("e-?mail|@", "contact"), (r"(^|\s)(how|what)(\s|$)", "procedure"), (r"(^|\s)(le|la|les|der|die|das)(\s|$)", "translated"))
FAMILY_SQL = "CASE " + " ".join(f"WHEN regexp_matches(text, '(?i){p}') THEN '{name}'" for p, name in FAMILIES) + " END"


@query(f"SELECT family, count(*) AS n, min(id) AS first FROM (SELECT conv_id * 1000 + turn AS id, {FAMILY_SQL} AS family FROM conversations) WHERE family IS NOT NULL GROUP BY 1")
def enrich_question_families(spark, sf_dir):
    return acceptance.question_families(table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text"), FAMILIES)


@query("""WITH f AS (SELECT r_name AS family, CASE WHEN r_regionkey <> 1 THEN 'covers' END AS predicate, CAST(96 - 3 * r_regionkey AS DOUBLE) / 100 AS confidence, r_regionkey <> 0 AS active FROM region),
e AS (SELECT r_name AS family, 'source' AS side, 'Region_' || r_regionkey AS entity FROM region UNION SELECT r_name, 'source', 'Region_0' FROM region WHERE r_regionkey = 3 UNION SELECT r_name, 'target', 'Customer_' || c_custkey FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey),
s AS (SELECT family, min(entity) AS s FROM e WHERE side = 'source' GROUP BY 1 HAVING count(DISTINCT entity) = 1)
SELECT family, s, predicate AS p, entity AS o, confidence FROM f JOIN s USING (family) JOIN e USING (family) WHERE side = 'target' AND active AND confidence >= 0.9 AND predicate IS NOT NULL""")
def enrich_residual_links(spark, sf_dir):
    r, n, c = (table(spark, sf_dir, t) for t in ("region", "nation", "customer"))
    key = F.col("r_regionkey")
    families = r.select(F.col("r_name").alias("family"), F.when(key != 1, "covers").alias("predicate"), ((F.lit(96) - 3 * key) / 100).alias("confidence"), (key != 0).alias("active"))
    end = lambda df, side, entity: df.select(F.col("r_name").alias("family"), F.lit(side).alias("side"), entity.alias("entity"))
    sold = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    ends = end(r, "source", F.concat(F.lit("Region_"), key)).union(end(r.where(key == 3), "source", F.lit("Region_0"))).union(end(sold, "target", F.concat(F.lit("Customer_"), "c_custkey")))
    return acceptance.residual_links(families, ends)
