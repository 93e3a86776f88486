"""Core queries against their SQL, and operators, sources and streams on small inputs."""

from __future__ import annotations

import glob
import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from graphloom import queries, store
from graphloom.functions import similarity, surfaces, text, turtle_text
from graphloom.operators import acceptance, diagnose, evaluate, ingest, ontology, orchestrate, patterns, plan, question, resolve, retrieve, sanitize, stages, validate
from graphloom.sources import chunks, datasets, reports, repository, turtle
from graphloom.streaming import ingest as streams

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def plain(x):
    return f"{x:.9g}" if isinstance(x, float) else str(x)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_against_sql(spark, con, name):
    df = queries.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    if name not in queries.ORACLE_SQL:
        assert got
        return
    r = con.execute(queries.ORACLE_SQL[name])
    names = [c[0] for c in r.description]
    assert sorted(names) == cols
    assert got == sorted(tuple(plain(x[names.index(c)]) for c in cols) for x in r.fetchall())


def graph(spark, rows):
    return spark.createDataFrame([(s, p, o, "iri" if p in ("type", "r", "q") else "literal", None) for s, p, o in rows], "s string, p string, o string, kind string, lang string")


def test_rewrite_drops_loops_and_repeats(spark):
    g = graph(spark, [("a", "r", "b"), ("b", "r", "c"), ("a2", "r", "b"), ("a", "type", "a2"), ("a2", "label", "x")])
    m = spark.createDataFrame([("a2", "a"), ("c", "b")], "source string, target string")
    got = {(r.s, r.p, r.o) for r in patterns.rewrite(g, m).collect()}
    assert got == {("a", "r", "b"), ("a", "type", "a2"), ("a", "label", "x")}


def test_chains_of_any_length(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    n = 70
    rows = [(f"n{i:03}", f"n{i - 1:03}") for i in range(1, n)] + [("x", "y"), ("y", "x")]
    got = {r.source: r.target for r in resolve.resolve_chains(spark.createDataFrame(rows, "source string, target string")).collect()}
    assert all(got[f"n{i:03}"] == "n000" for i in range(1, n))


def test_closure_with_a_cycle(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "a")], "child string, parent string")
    got = {(r.child, r.ancestor) for r in ontology.closure(e).collect()}
    assert got == {(x, y) for x in "abc" for y in "abc"} | {("d", y) for y in "abc"}


def test_mint_reuses_the_registry_and_tells_collisions_apart(spark):
    e = spark.createDataFrame([(1, "ENC 1", "Sensor"), (2, "enc-1", "Sensor"), (3, "ENC 1", "Motor"), (4, "", "Motor"), (5, "9 Volt", "Motor")], "id int, label string, t string")
    got = {r.id: r.name for r in resolve.minted(e, F.col("t"), F.col("label")).collect()}
    assert got[1] == got[2] != got[3] and got[4] == "Motor" and got[5] == "Entity9Volt"
    again = resolve.minted(e, F.col("t"), F.col("label"), spark.createDataFrame([("Sensor|enc 1", "Old")], "key string, name string"))
    assert {r.id: r.name for r in again.collect()}[2] == "Old"


def test_validation_summary(spark):
    g = graph(spark, [("a", "type", "C"), ("a", "label", "x"), ("b", "label", "y"), ("a", "r", "z")])
    allowed = spark.createDataFrame([("type",), ("label",)], "property string")
    closed = ontology.closure(spark.createDataFrame([("C", "D")], "child string, parent string"))
    got = {r.category: r.n for r in validate.report(g, allowed, closed).collect()}
    assert got["missing_type"] == 1 and got["unknown_predicate"] == 1 and got["dangling"] == 1 and got["redundant_type"] == 0


def test_split_parts_fold(spark):
    rng = random.Random(1)
    told = {i: [f"s{i}x{k} " + "w " * rng.randint(0, 28) + "end." for k in range(20)] for i in range(10)}
    rows = [(i, " ".join(s)) for i, s in told.items()] + [(99, None), (100, "")]
    got = ingest.split_parts(spark.createDataFrame(rows, "id long, text string"), 40, 8).collect()
    assert {r.id for r in got} == set(range(10))
    for i, sentences in told.items():
        done = 0
        for r in sorted((r for r in got if r.id == i), key=lambda r: r.part):
            assert len(r.text.split()) <= 40
            held = [k for k, s in enumerate(sentences) if s.split()[0] in r.text.split()]
            assert held == list(range(held[0], held[-1] + 1)) and held[0] <= done and held[-1] >= done
            done = held[-1] + 1
        assert done == 20


def test_similarity_and_text_functions(spark):
    df = spark.createDataFrame([("Válvula de Presión", "valvula presion", "http://x.org/a#TempSensor2", None)], "a string, b string, u string, n string")
    r = df.select(
        text.normalize(F.col("a")).alias("norm"), text.humanize(text.local_name(F.col("u"))).alias("h"), text.camel_case(F.col("a")).alias("cc"),
        text.identifier(F.lit("ab-1/ 2")).alias("i"), similarity.ratio(F.col("a"), F.col("b")).alias("ratio"), similarity.ratio(F.col("a"), F.col("n")).alias("null"),
    ).first()
    assert (r.norm, r.h, r.cc, r.i, r.null) == ("valvula de presion", "Temp Sensor 2", "ValvulaDePresion", "AB12", 0.0) and 0.5 < r.ratio < 1


def test_plan_bounds_each_step(spark):
    g = graph(spark, [(f"a{i}", "r", "root") for i in range(9)] + [(f"a{i}", "label", str(i)) for i in range(9)])
    plan = retrieve.Plan(("root",), (retrieve.Step("r", True, 4),))
    assert {r.s for r in retrieve.run_plan(g, plan).collect()} == {"a0", "a1", "a2", "a3"}
    assert [r.status for r in retrieve.boundedness(g, plan).collect()] == ["too_broad"]


def test_precision_and_recall_of_empty_sides(spark):
    e = spark.createDataFrame([(1, "a"), (1, "b"), (2, "x")], "id int, item string")
    f = spark.createDataFrame([(1, "b"), (1, "c"), (1, "d"), (3, "q")], "id int, item string")
    got = {r.id: (r.precision, r.recall) for r in evaluate.precision_recall(e, f).collect()}
    assert got == {1: (0.3333, 0.5), 2: (0.0, 0.0), 3: (0.0, 0.0)}


TTL = """@prefix ex: <http://e.org/> . # comment
@prefix xsd: <http://www.w3.org/2001/XMLSchema#> .
ex:a a ex:Sensor ; ex:label "uno"@es, "one"@en ; ex:n 5, 1.5, true ; ex:part [ a ex:Bolt ; ex:len "3"^^xsd:int ] .
ex:b ex:note \"\"\"long "quoted"
text\"\"\" ; ex:list ( ex:a "x" ) .
_:k ex:see ex:a.b .
"""


def test_turtle(spark, tmp_path):
    rows = [("f1", TTL), ("f2", "ex:a ex:b ."), ("f3", ""), ("f4", '<http://e.org/s> <http://e.org/p> "a\\"b\\u00e9" .')]
    df = turtle.parse(spark.createDataFrame(rows, "source string, text string")).cache()
    assert {r.source for r in df.where("error IS NOT NULL").collect()} == {"f2"}
    got = {(r.s, r.p.split("/")[-1].split("#")[-1], r.o, r.o_lang) for r in df.where("source = 'f1'").collect()}
    assert ("http://e.org/a", "label", "uno", "es") in got and ("http://e.org/a", "n", "true", None) in got
    assert any(o == 'long "quoted"\ntext' for _, _, o, _ in got) and len(got) == 16
    assert [r.o for r in df.where("source = 'f4'").collect()] == ['a"bé']
    turtle.write(df, str(tmp_path / "nt"))
    back = turtle.read(spark, str(tmp_path / "nt"))
    assert back.where("error IS NULL").select("p", "o_kind").count() == df.where("error IS NULL").select("s", "p", "o", "o_lang", "o_datatype").distinct().count()


def test_chunk_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("intro\n--- Pages: [1, 2] | Section: 3.1 | Title: Pumps ---\nbody one\n--- Pages: [] | Section: 4 | Title: Valves ---\nbody two")
    (tmp_path / "b.txt").write_bytes("niño sin cabecera".encode("latin-1"))
    got = sorted((os.path.basename(r.source), r.pos, r.pages, r.section, r.title, r.text) for r in chunks.read(spark, str(tmp_path / "*.txt")).collect())
    assert got == [("a.txt", 0, ["1", "2"], "3.1", "Pumps", "body one"), ("a.txt", 1, [], "4", "Valves", "body two"), ("b.txt", 0, [], "", "-", "niño sin cabecera")]


def test_manifest_and_terms(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"chunks": {"2": {"signature": "x", "status": "ok"}, "1": {"signature": "y", "status": "error"}}}')
    assert {(r.id, r.signature, r.status) for r in chunks.read_manifest(spark, str(tmp_path / "m.json")).collect()} == {(2, "x", "ok"), (1, "y", "error")}
    (tmp_path / "old.json").write_text('{"generated_at": "2001-01-01T00:00:00Z", "terms": [{"term": "a", "uri": "u"}]}')
    assert chunks.read_terms(spark, str(tmp_path / "old.json")).count() == 0
    assert chunks.read_terms(spark, str(tmp_path / "old.json"), 100_000).count() == 1


def test_streams(spark, tmp_path):
    src = spark.read.parquet(f"{SF}/events.parquet")
    src.write.parquet(str(tmp_path / "in"))
    events = spark.readStream.schema(src.schema).parquet(str(tmp_path / "in"))
    q = streams.windowed_counts(events, "ts", "event_type", "1 day").writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.table("counts").agg(F.sum("n")).first()[0] == src.count()
    signed = events.select(F.col("event_id").alias("id"), F.col("event_type").alias("signature"))
    got = []
    manifest = spark.createDataFrame([(0, src.first().event_type, "ok"), (1, "other", "ok")], "id long, signature string, status string")
    streams.run_incremental(signed, lambda: manifest, lambda df, n: got.extend(r.id for r in df.collect()), str(tmp_path / "cp")).awaitTermination(60)
    assert len(got) == src.count() - 1 and 1 in got


def test_sanitize_is_idempotent_and_mints(spark):
    rows = [
        ("_:a", "type", "Sensor", "iri", None, None), ("_:a", "label", "ENC 1", "literal", "en", None), ("x", "r", "_:a", "iri", None, None),
        ("x", "type", "Thing", "iri", None, None), ("x", "type", "Machine", "iri", None, None), ("x", "type", "Table", "iri", None, None), ("x", "value", "8", "literal", None, "xsd:hexBinary"),
        ("pump one", "label", "pump", "literal", None, None), ("x", "extract", "the machine\n" + "long line " * 60 + "\nx stands here", "literal", None, None),
        ("OneTwoThreeFourFiveSixSevenEightNine", "extract", "one two three four five six seven eight nine", "literal", None, None),
    ]
    t = spark.createDataFrame(rows, "s string, p string, o string, kind string, lang string, datatype string")
    domains = spark.createDataFrame([("r", "Machine")], "property string, class string")
    closed = ontology.closure(spark.createDataFrame([("Machine", "Thing")], "child string, parent string"))
    once = sanitize.sanitize(t, domains, closed, (("pump", "Pump"),))
    got = {tuple(r) for r in once.collect()}
    assert {tuple(r) for r in sanitize.sanitize(once, domains, closed, (("pump", "Pump"),)).collect()} == got
    assert not any(str(v).startswith("_:") for r in got for v in (r[0], r[2])) and ("x", "r", "Enc1", "iri", None, None) in got
    assert {r[2] for r in got if r[0] == "x" and r[1] == "type"} == {"Machine"} and {r[5] for r in got if r[1] == "value"} == {"string"}
    assert ("pump one", "type", "Pump", "iri", None, None) in got and not any(r[0].startswith("OneTwo") for r in got)
    assert all(len(r[2]) <= 320 for r in got if r[1] == "extract") and any(r[0] == "Enc1" and r[1] == "extract" for r in got)


def test_extractor_failures_stay_in_rows(spark):
    def work(t):
        if "limit" in t:
            raise RuntimeError("429 too many requests")
        if "bad" in t:
            raise ValueError("unexpected token")
        return t.upper()

    df = spark.createDataFrame([(1, "a plain chunk of text"), (2, "over the limit of calls"), (3, "a bad chunk of text"), (4, None), (5, "1 2 3 4 5 6 7 8 9")], "id long, text string")
    got = {r.id: (r.status, r.attempts) for r in orchestrate.extract(df, work, orchestrate.PROFILES["eager"]).collect()}
    assert got == {1: ("ok", 1), 2: ("error", 3), 3: ("error", 1), 4: ("skipped", 0), 5: ("skipped", 0)}
    report = {(r.status, r["class"]): r.n for r in orchestrate.status_report(orchestrate.extract(df, work, orchestrate.PROFILES["eager"])).collect()}
    assert report[("error", "rate_limit")] == 1 and report[("error", "syntax")] == 1


def test_repaired_turtle_parses(spark):
    raw = 'Sure!\n```ttl\nex:a(1) a ex:Sensor ; ex:label "the "big" one" ; ex:hex "8"^^xsd:hexBinary ; ex:extract "línea\\dos"@es .\n```'
    df = spark.createDataFrame([("f", raw)], "source string, text string").withColumn("text", turtle_text.repaired(F.col("text")))
    got = turtle.parse(df).collect()
    assert [r.error for r in got] == [None] * 4 and {r.o for r in got} >= {'the "big" one', "8", "línea\\dos"}
    assert {r.o_lang for r in got} == {None}


def test_store_answers_from_evidence(spark, tmp_path):
    rows = [("Pump_1", "type", "Pump", "iri"), ("Pump_1", "label", "feed pump", "literal"), ("Pump_1", "extract", "The feed pump serves to move water. It is red.", "literal"), ("Valve_1", "label", "relief valve", "literal")]
    g = spark.createDataFrame([(*r, None) for r in rows], "s string, p string, o string, kind string, lang string")
    s = store.GraphStore(g, g, view="kg_test")
    assert s.size() == 4 and s.ask("SELECT * FROM kg_test WHERE s = 'Pump_1'") and s.health()["available"]
    q = spark.createDataFrame([(1, "what is the purpose of the feed pump"), (2, "unrelated question")], "id long, text string")
    got = {r.id: r for r in s.answer(q).collect()}
    assert got[1].mode == "purpose" and "move water" in got[1].answer and got[2].status == "refused"
    assert s.publish(str(tmp_path / "kg")) == 4 and store.GraphStore.load(spark, str(tmp_path / "kg"), "kg_back").size() == 4
    s.remove(g.where("s = 'Valve_1'"))
    assert s.size() == 3


def test_reports_and_caches(spark, tmp_path):
    terms = spark.createDataFrame([("b", "u2"), ("a", "u1"), ("a", "u1")], "term string, uri string")
    reports.write_terms(terms, str(tmp_path / "terms"))
    assert sorted(r.term for r in chunks.read_terms(spark, str(tmp_path / "terms")).collect()) == ["a", "b"]
    reports.write_registry(spark.createDataFrame([("k", "N2"), ("k", "N1")], "key string, name string"), str(tmp_path / "reg"))
    assert [tuple(r) for r in reports.read_registry(spark, str(tmp_path / "reg")).collect()] == [("k", "N1")]
    for _ in range(2):
        reports.append_report(terms, str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).count() == 6
    assert reports.catalog(spark, [("f", queries.PLAN)]).count() == 2


def test_surfaces(spark):
    import uuid

    df = spark.createDataFrame([("M[1102]", "see m[1102] now", "xM[1102]"), ("pump", "the pump runs", "pumps")], "s string, yes string, no string")
    got = df.select(F.expr("yes").alias("y"), surfaces.boundary_pattern(F.col("s")).alias("p"), surfaces.uuid_suffix(F.col("s")).alias("u"), "yes", "no", surfaces.any_surface(F.col("s"), F.lit(""), F.lit(None).cast("string"), F.col("s")).alias("a"))
    rows = got.select("*", F.regexp_like("yes", F.col("p")).alias("hit"), F.regexp_like("no", F.col("p")).alias("miss")).collect()
    assert [(r.hit, r.miss, r.a) for r in rows] == [(True, False, ["M[1102]"]), (True, False, ["pump"])]
    assert rows[1].u == uuid.uuid5(uuid.NAMESPACE_URL, "pump").hex[:10]
    texts = spark.createDataFrame([(surfaces_id,) for surfaces_id in (1, 2)], "id long").select(F.col("id").cast("string").alias("source"), surfaces.placeholder(F.col("id"), "blank page").alias("text"))
    assert turtle.parse(texts).where("error IS NULL").count() == 4


def test_candidates_keep_all_where_no_word_fits(spark):
    c = spark.createDataFrame([(1, "Pump_1"), (1, "Valve_2"), (2, "Motor_1"), (2, "Motor_2")], "id int, node string")
    assert {(r.id, r.node) for r in question.filtered(c, ["pump"]).collect()} == {(1, "Pump_1"), (2, "Motor_1"), (2, "Motor_2")}


def test_question_record(spark):
    q = spark.createDataFrame([(1, "Â¿QuÃ© es el cÃ³digo E204 de la bomba?"), (2, "")], "id long, text string")
    rules = spark.createDataFrame([("pumps", "bomba")], "group string, phrase string")
    got = {r.id: r for r in question.normalized(q, (("bomba", "bomba hidraulica"),), rules).collect()}
    assert got[1].text == "¿Qué es el código E204 de la bomba?" and got[1].language == "es" and got[1].groups == ["pumps"] and got[1].signals == ["E204"]
    assert (got[2].language, got[2].confidence, got[2].groups) == ("en", 0.51, [])


def test_evidence_counts_frequent_words(spark):
    rows = spark.createDataFrame([(i, "granite harbour lantern") for i in range(5)] + [(9, "granite quarry"), (10, "nothing alike")], "row long, text string")
    asked = spark.createDataFrame([(1, "granite harbour"), (2, "quarry granite")], "id long, text string")
    got = sorted(tuple(r) for r in retrieve.evidence(asked, rows).select("id", "rank", "row", "shared").collect())
    assert got == [(1, 1, 0, 2), (1, 2, 1, 2), (1, 3, 2, 2), (2, 1, 9, 2), (2, 2, 0, 1), (2, 3, 1, 1)]


def test_candidates_of_a_word_that_many_hold(spark):
    g = graph(spark, [(f"n{i:03}", "label", "pump") for i in range(60)])
    q = spark.createDataFrame([(1, "which pump")], "id int, text string")
    assert [r.node for r in plan.generic_candidates(q, g).orderBy("rank").collect()] == [f"n{i:03}" for i in range(10)]


def test_evidence_of_a_few_rows(spark):
    rows = spark.createDataFrame([(1, "feed pump pressure"), (2, "a valve"), (3, "feed line")], "row int, text string")
    q = spark.createDataFrame([(7, "feed pump pressure")], "id int, text string")
    assert [(r.row, r.shared) for r in retrieve.evidence(q, rows).orderBy("rank").collect()] == [(1, 3), (3, 1)]


def test_closure_of_many_levels(spark):
    e = spark.createDataFrame([(f"c{i}", f"c{i + 1}") for i in range(100)], "child string, parent string")
    assert ontology.closure(e).count() == 100 * 101 // 2
    assert ontology.closure(e.limit(0)).count() == 0


def test_chains_with_cycles(spark):
    rows = [("a", "b"), ("b", "c"), ("c", "a"), ("t2", "t1"), ("t1", "b"), ("x", "y"), ("self", "self")] + [(f"n{i:03}", f"n{i + 1:03}") for i in range(300)]
    got = {r.source: r.target for r in resolve.resolve_chains(spark.createDataFrame(rows, "source string, target string")).collect()}
    assert {k: v for k, v in got.items() if k[0] != "n"} == {"b": "a", "c": "a", "t1": "a", "t2": "a", "x": "y"}
    assert all(got[f"n{i:03}"] == "n300" for i in range(300))


def test_letters_and_identifiers(spark):
    df = spark.createDataFrame([("Škoda Łódź Győr ﬁn x² Ｆｕｌｌ", "PP_177", "PP177", "2006/42/EC", "a@b.es/x_1-2")], "a string, b string, c string, d string, e string")
    r = df.select(
        text.normalize(F.col("a")).alias("n"), (text.identifier(F.col("b")) == text.identifier(F.col("c"))).alias("same"), text.structured_identifier_score(F.col("d")).alias("s"),
        text.normalize_technical(F.col("e")).alias("t"), text.normalize(F.lit("cafe\u0301")).alias("m"),
    ).first()
    assert (r.n, r.same, float(r.s), r.t, r.m) == ("skoda odz gyor fin x2 full", False, 1.0, "a@b.es/x_1-2", "cafe")


def test_terms_of_several_words(spark):
    chunks = spark.createDataFrame([(1, "The feed pump, and the valve."), (2, "feed the pump"), (3, None), (4, "")], "id long, text string")
    terms = spark.createDataFrame([("Feed Pump",), ("valve",), ("relief valve of the pump",)], "term string")
    assert {r.id: r.n_terms for r in ingest.term_counts(chunks, terms).collect()} == {1: 2, 2: 0, 3: 0, 4: 0}
    assert [(r.id, r.term) for r in retrieve.question_hits(chunks, terms).orderBy("rank").collect()] == [(1, "feed pump"), (1, "valve")]
    assert retrieve.phrase_hits(chunks, terms.limit(0)).count() == 0


def test_numbers_of_a_hot_group(spark):
    rows = [(i, "hot" if i % 3 else "cold") for i in range(500)]
    got = ingest.numbered(spark.createDataFrame(rows, "id int, source string").repartition(7), "source", "id").collect()
    for k, r in enumerate(sorted(got, key=lambda r: (r.source, r.id))):
        assert r.global_id == k and r.local_id == k - (0 if r.source == "cold" else 167)


def test_variant_scan_verdicts(spark):
    d = "id string, label string, identifier string, best string, local string, classes array<string>, n_surfaces int, n_in int"
    row = lambda i, label, kind, n: (i, label, None, label, i, [kind] if kind else [], 1, n)
    rows = [row("FeedPump", "feed pump", "P", 5), row("Feedpump", "feed-pump", "P", 1), row("Feed_Pump", "feed pump", "Q", 0), row("FeedPump_7", "feed pump", "P", 0), row("feed pump!", "feed pump", None, 0)]
    got = {(r.source, r.candidate): r.verdict for r in acceptance.variant_scan(spark.createDataFrame(rows, d), spark.createDataFrame([], "x string, y string")).where("key = 'feedpump'").collect()}
    assert got["FeedPump", "Feedpump"] == "surface_variant_canonicalization" and got["FeedPump", "Feed_Pump"] == "incompatible_entity_types"
    assert got["FeedPump", "FeedPump_7"] == "contextual_suffix_blocked" and got["FeedPump", "feed pump!"] == "incompatible_entity_types"


def test_supplements_and_anchors(spark):
    g = graph(spark, [("x", "r", "old"), ("old", "label", "a"), ("extra", "label", "b"), ("old", "type", "C")])
    m = spark.createDataFrame([("old", "new")], "source string, target string")
    got = {(r.s, r.p, r.o) for r in acceptance.with_supplements(g, m, spark.createDataFrame([("old", "extra"), ("old", "new")], "source string, extra string")).collect()}
    assert got == {("x", "r", "new"), ("x", "r", "extra"), ("new", "label", "a"), ("extra", "label", "b"), ("new", "type", "C")}
    a = spark.createDataFrame([("k", ["a", "b"], ["z"])], "canonical string, absorbs array<string>, legacy_aliases array<string>")
    assert {(r.source, r.target) for r in acceptance.anchor_mapping(a).collect()} == {("a", "k"), ("b", "k")}


def test_semantic_categories_of_clean_and_lonely_graphs(spark):
    one = lambda c, *v: spark.createDataFrame([(x,) for x in v], f"{c} string")
    closed = ontology.closure(spark.createDataFrame([("C", "D")], "child string, parent string"))
    lonely = graph(spark, [("a", "type", "C"), ("a", "extract", "x"), ("b", "type", "C"), ("b", "extract", "x")])
    got = {r.category: r.n for r in validate.semantic(lonely, one("class", "C"), one("property", "type", "extract"), closed).collect()}
    assert got == {"weak_linkage": 2, "no_useful_links": 2}
    clean = lonely.union(graph(spark, [("a", "r", "b")]))
    report = validate.semantic(clean, one("class", "C"), one("property", "type", "extract", "r"), closed)
    assert report.count() == 0 and validate.passed(report).first().ok


def test_next_change_without_gaps(spark):
    r = diagnose.next_change(spark.createDataFrame([("ok_structurally",)], "gap string")).first()
    assert r.work == "formalize_promotable_sandbox_questions"


def test_question_sets_of_three_shapes(spark, tmp_path):
    import json

    def read(payload):
        (tmp_path / "q.json").write_text(json.dumps(payload))
        return {(r.question_id, r.question, r.group_name, r.language) for r in datasets.read_questions(spark, str(tmp_path / "q.json")).collect()}

    q = {"question_id": "1", "question": "what", "answer": "x"}
    assert read([{"group": "g", "questions": [q, q | {"question_id": "2"}]}]) == {("1", "what", "g", None), ("2", "what", "g", None)}
    assert read({"pairs": [{"case_id": "c", "category": "k", "questions": {"es": "que", "en": "what"}, "expected_answer": "x"}]}) == {("c", "que", "k", "es"), ("c", "what", "k", "en")}
    assert read([q]) == {("1", "what", None, None)}
    rows = spark.createDataFrame([(2, "m", "t"), (1, "m", "u")], "chunk_id long, manual_id string, text string")
    datasets.write_input(rows, str(tmp_path / "in.jsonl"))
    assert [(r.chunk_id, r.text, r.section) for r in datasets.read_input(spark, str(tmp_path / "in.jsonl")).orderBy("chunk_id").collect()] == [(1, "u", None), (2, "t", None)]
    datasets.write_density(rows, str(tmp_path / "d.jsonl"))
    assert datasets.read_density(spark, str(tmp_path / "d.jsonl")).count() == 2
    path = str(tmp_path / "q.json")
    assert datasets.existing_paths(spark, [path, path + "/"]) == [path]
    with pytest.raises(FileNotFoundError):
        datasets.existing_paths(spark, [path, path + "x"])


def test_staged_run():
    steps = [stages.Stage("a", lambda r: 1), stages.Stage("b", lambda r: 1 / 0, optional=True), stages.Stage("c", lambda r: r["a"] + 1), stages.Stage("d", lambda r: r["nothing"]), stages.Stage("e", lambda r: 5)]
    run = stages.run_stages(steps)
    assert [r["status"] for r in run.records] == ["ok", "failed", "ok", "failed", "skipped"] and run.results["c"] == 2 and not run.complete
    assert "ZeroDivisionError" in run.records[1]["error"]


def test_models_in_order(spark):
    def broken(prompt):
        raise TimeoutError("timed out")

    ask = stages.with_fallback([("one", broken), ("two", lambda p: ""), ("three", lambda p: p + "!")])
    assert ask("x") == "x!"
    with pytest.raises(TimeoutError):
        stages.with_fallback([("one", broken)])("x")
    results = spark.createDataFrame([(1, None, "error", "request timed out", 3), (2, "t", "ok", None, 1)], "id int, output string, status string, error string, attempts int")
    assert [(r.chunk_id, r.error_class, r.model_chain) for r in stages.failure_records(results, "v1", ["one"]).collect()] == [(1, "timeout", ["one"])]


def test_plans_with_a_fallback(spark):
    g = graph(spark, [("a", "r", "root"), ("a", "label", "x")])
    empty, full = retrieve.Plan(("root",), (retrieve.Step("q", True),)), retrieve.Plan(("root",), (retrieve.Step("r", True, 5),))
    n, rows = retrieve.run_with_fallback(g, empty, full)
    assert n == 1 and [r.o for r in rows.collect()] == ["x"]
    assert [(r.family, r.bounded) for r in reports.policy_matrix(spark, [("f", full), ("e", empty)]).collect()] == [("f", True), ("e", False)]
    assert reports.rules(spark, value=[("a", "b")], surface=[("c", "d"), ("e", "f")]).count() == 3


def test_remote_repository(spark):
    import json
    import threading
    from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
    from urllib.parse import parse_qs

    made, held, lock = set(), set(), threading.Lock()

    class Server(BaseHTTPRequestHandler):
        def answer(self, status, body=b""):
            self.send_response(status)
            self.end_headers()
            self.wfile.write(body)

        def handle_any(self):
            body = self.rfile.read(int(self.headers.get("Content-Length") or 0)).decode()
            name = self.path.split("/")[2]
            with lock:
                if self.command == "PUT":
                    made.add(name)
                    return self.answer(204)
                if name not in made:
                    return self.answer(404, b"unknown")
                if self.command == "DELETE":
                    made.discard(name)
                    return self.answer(204)
                if self.path.endswith("/size"):
                    return self.answer(200, str(len(held)).encode())
                if self.path.endswith("/statements"):
                    if "update" in parse_qs(body):
                        held.clear()
                    else:
                        held.update(body.splitlines())
                    return self.answer(204)
                if "ASK" in body:
                    return self.answer(200, json.dumps({"head": {}, "boolean": True}).encode())
                self.answer(200, json.dumps({"head": {"vars": ["a", "b"]}, "results": {"bindings": [{"a": {"value": "x"}}]}}).encode())

        do_GET = do_POST = do_PUT = do_DELETE = handle_any

        def log_message(self, *args):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Server)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    r = repository.Repository(f"http://127.0.0.1:{server.server_port}", "g", "u", "p")
    assert not r.exists() and r.health()["status"] == 404 and r.create() and not r.create() and r.exists()
    g = graph(spark, [(f"n{i}", "label", f'say "{i}"\n') for i in range(30)] + [("a", "r", "http://e.org/b")]).repartition(3)
    assert r.publish(g, "http://e.org/", rows=4) == {"sent": 31, "size": 31}
    assert '<http://e.org/a> <http://e.org/r> <http://e.org/b> .' in held
    assert r.publish(g.limit(2), "http://e.org/", fresh=True)["size"] == 2 and r.health()["triples"] == 2
    assert r.select("SELECT ?a ?b {}") == [{"a": "x", "b": None}] and r.ask("ASK {}")
    r.delete()
    assert not r.exists() and 'config:rep.id "g"' in repository.config("g")
    server.shutdown()
    assert repository.Repository("http://127.0.0.1:9", "g", timeout=1).health()["available"] is False


def test_average_linkage_as_merging_one_pair_at_a_time(spark):
    import itertools
    import math
    import random

    import xxhash

    from graphloom.operators import linkage

    def mixed(a, b):
        h = xxhash.xxh64(b.encode(), seed=xxhash.xxh64(a.encode(), seed=42).intdigest()).intdigest()
        return h - (1 << 64) if h >> 63 else h

    r = random.Random(5)
    rows = [(f"n{i}", " ".join(r.sample("abcdefghi", r.randint(1, 5)))) for i in range(40)] + [("long name", "a b"), ("e1", ""), ("e2", None), ("e3", " - ")]
    words = {i: set((x or "").replace("-", "").split()) for i, x in rows}
    groups = [[i] for i in words if words[i]]
    cosine = lambda a, b: len(words[a] & words[b]) / math.sqrt(len(words[a]) * len(words[b]))
    while True:
        near = []
        for g, h in itertools.combinations(groups, 2):
            a, b = sorted((min(g), min(h)))
            mean = round(sum(cosine(x, y) for x in g for y in h) / (len(g) * len(h)), 12)
            if mean >= 0.65 - 1e-9:
                same = all(words[x] == words[y] for x in g for y in h)
                near.append((not same, -mean, mixed(a, b), a, b, g, h))
        if not near:
            break
        *_, g, h = min(near)
        groups = [x for x in groups if x is not g and x is not h] + [g + h]
    want = {i: i for i in words} | {i: min(g, key=lambda x: (len(x), x)) for g in groups for i in g}
    got = linkage.average_linkage(spark.createDataFrame(rows, "id string, label string"), 0.35).collect()
    assert {x.id: x.cluster for x in got} == want and len(got) == len(rows)
    assert linkage.average_linkage(spark.createDataFrame([], "id string, label string")).collect() == []


def test_counters_of_repairs(spark):
    t = graph(spark, [("a", "type", "Part"), ("a", "type", "Asset"), ("a", "label", "valve"), ("b", "label", "steel pump")])
    closed, domains = ontology.closure(spark.createDataFrame([("Part", "Asset")], "child string, parent string")), spark.createDataFrame([], "property string, class string")
    after, did = sanitize.counted(t, domains, closed, rules=(("steel", "Part"),), mint=False)
    assert set(after.collect()) == set(sanitize.sanitize(t, domains, closed, (("steel", "Part"),), mint=False).collect())
    found = {r.repair: (r.subjects, r.added, r.removed) for r in did.collect()}
    assert found["types_inferred"] == (1, 1, 0) and found["supertypes_dropped"] == (1, 0, 1) and found["trace_added"] == (2, 2, 0) and found["hex_downgraded"] == (0, 0, 0)
    assert {r.repair: r.added for r in sanitize.collected(did, did).collect()}["trace_added"] == 4


def test_keys_of_weak_surfaces(spark):
    rows_ = spark.createDataFrame([(1, "Valve A", "p. 4"), (2, "table", "p. 4"), (3, None, None), (4, "Valve A", "Valve A"), (5, "Valve A", "***")], "id int, s string, x string")
    k = {r.id: r.m for r in rows_.select("id", resolve.mint_key(F.lit("Part"), F.col("s"), F.col("x")).alias("m")).collect()}
    assert k[1].key == "part|valve a|p 4" and k[1].name == "ValveA" and not k[1].weak
    assert k[2].key == "part|p 4" and k[2].name.startswith("Part_") and k[2].weak and k[3].weak and k[3].key != k[2].key
    assert k[4].key == "part|valve a" and len({x.key for x in k.values()}) == 5


def test_profiles_of_sources():
    from graphloom.operators import stages

    p = stages.profile("m1", "/in/Quick Ref (v2).txt", "/out/")
    assert p["prefix"] == "quick_ref_v2" and p["manifest"] == "/out/quick_ref_v2_manifest.json" and p["graphs"] == "/out/quick_ref_v2_graphs"
    assert stages.profile("Manual 7", "/in/___", "/out")["prefix"] == "manual_7" and len(set(p.values())) == len(p)


def test_answer_modes_of_letters_outside_ascii(spark, tmp_path):
    from graphloom.operators import answer

    texts = ["para queñez", "para queen", "¿para qué sirve?", "PARA QUÉX", "CÓMO", "¿CuÁntos?", "DIRECCIÓN", "EMAİL", "ñemail", "emailñ", "éhowé how_many", "how\nmany", "e-mail", "normä", "the norm", "", None]
    rows_ = spark.createDataFrame([(i, 0, "user", t) for i, t in enumerate(texts)], "conv_id long, turn int, role string, text string")
    rows_.write.parquet(str(tmp_path / "conversations.parquet"))
    c = duckdb.connect()
    c.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    want = c.execute(queries.ORACLE_SQL["syn_answer_modes"]).fetchall()
    assert sorted(map(tuple, queries.QUERIES["syn_answer_modes"](spark, str(tmp_path)).collect())) == sorted(want)
    # the operator's own reading: a letter is a letter
    got = dict(rows_.select("text", answer.mode(F.col("text"))).collect())
    assert [got[t] for t in ("para queñez", "¿para qué sirve?", "CÓMO", "¿CuÁntos?", "DIRECCIÓN", "emailñ", "")] == ["literal", "purpose", "procedure", "count", "address", "literal", "literal"]
