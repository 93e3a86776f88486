"""Each operator against a brute-force version, and its defined cases."""

from __future__ import annotations

import base64
import hashlib
import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.llm import bpe, embed, langid, licenses, lm, packing, quality, queries, sadedup, simhash, toxicity
from graphloom.llm.common import components, partition_key

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("score", T.StringType()), T.StructField("block", T.IntegerType())])
WORDS = "the of and house river stone garden letter window winter summer mountain paper silver".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + (rng.choice(["", "", ",", "."])) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    base = [prose(rng, rng.randint(1, 120)) for _ in range(40)]
    long = prose(rng, 3000)
    passage = prose(rng, 40)
    out = [*base, *base[:6], None, "", " \t\n ", long, long[:9000] + " changed " + long[9000:], "été à l'école " * 30]
    out += [f"{prose(rng, 12)} {passage} {prose(rng, 9)}" for _ in range(12)]
    out += ["line one has words\n" * 6, "%%% ### $$$ " * 12, "SHOUTED WORDS HERE " * 9, "a", "x" * 500, "日本語の文章。 \U0001f600 mixed"]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i * 3, t, "en" if i % 4 else "fr", f"src{i % 5}", None, "clash", 7) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def by_id(df, key="doc_id"):
    return {r[key]: r.asDict() for r in df.collect()}


def union_find(ids, pairs):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(190)] + [(i, i + 1) for i in range(1000, 1080)] + [(5000, 5000 + i) for i in range(60)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    want = union_find({x for p in pairs for x in p}, pairs)
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {k: v for k, v in want.items() if k in linked}


def test_partition_keys_are_dealt_one_by_one(spark):
    keyed = spark.range(97).select("id", partition_key(F.col("id")).alias("key"))
    got = keyed.repartition(97, "key").select("id", F.spark_partition_id().alias("p")).collect()
    assert all(r.id == r.p for r in got) and keyed.where(F.pmod(F.hash("key"), F.lit(211)) != F.col("id")).count() == 0


# ---------------------------------------------------------------- 1


def test_embeddings_against_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 16))
    near = base[:30] + rng.normal(size=(30, 16)) * 0.07
    rows = [(i, v.tolist(), 0) for i, v in enumerate([*base, *near, *base[:5], base[7] * 3])]
    odd = [(900, None, 1), (901, [0.0] * 16, 1), (902, [1.0, None] + [0.0] * 14, 1), (903, [float("nan")] * 16, 1), (904, [float("inf")] * 16, 1), (905, [], 1), (906, [1.0] * 8, 1), (907, [1.0] * 8, 1)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, n_links int").repartition(4)
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    link = x @ x.T >= 0.95
    np.fill_diagonal(link, False)
    comp = union_find(range(len(rows)), [tuple(p) for p in np.argwhere(link)])
    got = by_id(embed.near_duplicates(df), "vec_id")
    for i in range(len(rows)):
        assert got[i] == {"vec_id": i, "n_links": int(link[i].sum()), "component_id": comp[i], "kept": comp[i] == i}
    for i in (900, 901, 902, 903, 904, 905):
        assert got[i] == {"vec_id": i, "n_links": 0, "component_id": i, "kept": True}
    assert got[907]["component_id"] == 906 and got[906]["n_links"] == 1
    assert embed.near_duplicates(df.limit(0)).count() == 0


def test_quantisation_bounds_hold():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 24))
    x /= np.linalg.norm(x, axis=1)[:, None]
    q = embed.quantise(x)
    bound = embed.upper_bounds(q, q)
    assert (bound >= x @ x.T).all() and (bound - x @ x.T).max() < 0.05


def test_tiles_meet_for_all_linked_blocks(spark, monkeypatch):
    monkeypatch.setattr(embed, "BLOCK", 8)
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(6, 8))
    x = np.concatenate([c + rng.normal(size=(25, 8)) * 0.15 for c in centres])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    u = x / np.linalg.norm(x, axis=1)[:, None]
    link = u @ u.T >= 0.95
    np.fill_diagonal(link, False)
    got = by_id(embed.near_duplicates(df), "vec_id")
    assert [got[i]["n_links"] for i in range(len(x))] == link.sum(1).tolist()


def test_tiles_of_several_blocks_a_task(spark, monkeypatch):
    """One cell of many blocks, so that tasks hold several tiles; ids may be null or repeated."""
    monkeypatch.setattr(embed, "BLOCK", 16)
    monkeypatch.setattr(embed, "PIVOTS", 2)
    rng = np.random.default_rng(10)
    x = np.concatenate([rng.normal(size=(300, 8)), np.repeat(rng.normal(size=(20, 8)), 6, 0) + rng.normal(size=(120, 8)) * 0.08])
    ids = [None if i % 50 == 7 else i for i in range(len(x))]
    ids[11] = ids[12]
    df = spark.createDataFrame([(i, v.tolist(), "clash") for i, v in zip(ids, x)], "vec_id long, embedding array<double>, node string").repartition(5)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    link = u @ u.T >= 0.95
    np.fill_diagonal(link, False)
    comp = union_find(range(len(x)), [tuple(p) for p in np.argwhere(link)])
    least = {}
    for i, c in comp.items():
        least[c] = min((y for y in (least.get(c), ids[i]) if y is not None), default=None)
    want = sorted(((ids[i], int(link[i].sum()), least[comp[i]]) for i in range(len(x))), key=str)
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in embed.near_duplicates(df).collect()), key=str) == want


# ---------------------------------------------------------------- 2


def test_toxicity_separates_and_tolerates_gaps(spark):
    rng = random.Random(2)
    insults = ["grobnik", "plaxtor", "vermulch"]
    rows, labels = [], []
    for i in range(400):
        ws = [rng.choice(WORDS) + rng.choice(["", "s", "ing", "er"]) for _ in range(rng.randint(8, 40))]
        toxic = int(i % 4 == 0)
        if toxic:
            ws.insert(rng.randrange(len(ws)), rng.choice(insults))
        rows.append((i, " ".join(ws)))
        labels.append((i, toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([x for x in labels if x[0] % 3], "doc_id long, toxic int"))
    got = by_id(toxicity.score(docs, model))
    held = [x for x in labels if x[0] % 3 == 0]
    assert np.mean([got[i]["predicted"] == y for i, y in held]) > 0.97
    probe = spark.createDataFrame([(1, "the g-r-o-b-n-i-k house"), (2, "the gro.bnik of stone"), (3, "the house of stone"), (4, "grobnnik river"), (5, None), (6, ""), (7, "g r o b n i k window")], "doc_id long, text string")
    p = {k: v["score"] for k, v in by_id(toxicity.score(probe, model)).items()}
    assert min(p[1], p[2], p[4], p[7]) > 0.7 and max(p[3], p[5], p[6]) < 0.3
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_toxicity_of_several_ordinary_words(spark):
    """What is toxic only as words together, with others between them."""
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(600):
        ws = [rng.choice(WORDS) + rng.choice(["", "s", "ing", "er"]) for _ in range(rng.randint(20, 60))]
        ws += [rng.choice(["drown", "kitten"])] * 2 if i % 4 else []  # either word alone is ordinary
        rng.shuffle(ws)
        toxic = int(i % 4 == 0)
        if toxic:
            at = rng.randrange(len(ws))
            ws[at:at] = ["kitten", *ws[: rng.randint(0, 2)], "drown"]
        rows.append((i, " ".join(ws)))
        labels.append((i, toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([x for x in labels if x[0] % 3], "doc_id long, toxic int"))
    got = by_id(toxicity.score(docs, model))
    assert np.mean([got[i]["predicted"] == y for i, y in labels if i % 3 == 0]) > 0.9


def test_toxicity_trained_with_odd_rows(spark):
    rng = random.Random(3)
    rows = [(i, prose(rng, 20) + (" grobnik" if i % 3 == 0 else ""), "x", 1) for i in range(200)]
    rows += rows[:20] + [(None, "grobnik", "x", 1), (900, None, "x", 1), (901, "", "x", 1), (902, prose(rng, 60_000) + " grobnik", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string, predicted int")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(200)] + [(None, 1), (900, 0), (5, None)], "doc_id long, toxic int")
    got = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert len(got) == len(rows) and {r.predicted for r in got if r.doc_id in (0, 3, 902)} == {1} and {r.predicted for r in got if r.doc_id in (1, 2, 900, 901)} == {0}


def test_kernel_is_a_normalised_subsequence_kernel():
    def features(word):
        w, out, size = f"^{word}^", Counter(), 0.0
        for n, span in ((3, toxicity.SPAN - 1), (4, toxicity.SPAN)):
            for places in itertools.combinations(range(len(w)), n):
                if places[-1] - places[0] < span:
                    weight = toxicity.DECAY ** (places[-1] - places[0] + 1)
                    out[tuple(w[i] for i in places)] += weight
                    size += weight**2
        return out, math.sqrt(size)

    for a, b in (("idiot", "idiot"), ("idiot", "idxiot"), ("moron", "morning"), ("stone", "stones"), ("ab", "abc")):
        (fa, na), (fb, nb) = features(a), features(b)
        want = sum(fa[x] * fb[x] for x in fa) / (na * nb)
        assert toxicity.kernel([a], [b])[0, 0] == pytest.approx(want, rel=1e-6)
        machine = toxicity.WordMachine(np.zeros(toxicity.FEATURES), 0.25)
        assert machine.margins([a, b]).tolist() == [0.25, 0.25]
    row, feature, value, owner = toxicity._sparse(["stone"])
    weights = np.bincount(feature, value, toxicity.FEATURES)
    assert toxicity.WordMachine(weights, 0).margins(["stones"])[0] == pytest.approx(toxicity.kernel(["stones"], ["stone"])[0, 0], rel=1e-5)


def test_untrained_scores_are_one_half(spark, docs, empty):
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r["score"] for r in toxicity.score(docs, model).collect()} == {0.5}


# ---------------------------------------------------------------- 3


def plain_fingerprint(text, size):
    ws = (text or "").encode().lower().split()
    sh = [b" ".join(ws[i : i + size]) for i in range(len(ws) - size + 1)] or ([b" ".join(ws)] if ws else [])
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


@pytest.mark.parametrize("size", [3, 5])
def test_simhash_against_brute_force(spark, docs, texts, size):
    fp = {i * 3: plain_fingerprint(t, size) for i, t in enumerate(texts)}
    comp = union_find(fp, [(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= 3])
    got = by_id(simhash.near_duplicates(docs, size=size))
    assert got == {i: {"doc_id": i, "fingerprint": f"{fp[i]:016x}", "component_id": comp[i]} for i in fp}


def test_simhash_links_between_families_of_one_key(spark):
    """One key held by a large family and a few others: each pair of different families, however uneven."""
    rng = random.Random(14)
    base = rng.getrandbits(64)
    fps = sorted({base ^ sum(1 << b for b in rng.sample(range(20), rng.randint(0, 3))) for _ in range(200)})
    family = {f: 0 if i % 10 else i for i, f in enumerate(fps)}
    df = spark.createDataFrame([(simhash.signed(f), family[f]) for f in fps], "fp long, family long")
    got = {(r.u, r.v) for r in simhash.links(df, family_col="family").collect()}
    ss = [(simhash.signed(f), f) for f in fps]
    want = {(min(a, b), max(a, b)) for a, x in ss for b, y in ss if a < b and family[x] != family[y] and (x ^ y).bit_count() <= 3}
    assert got == want and want


def test_simhash_links_are_complete(spark):
    rng = random.Random(4)
    fps = []
    for _ in range(80):
        f = rng.getrandbits(64)
        fps += [f, *(f ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))) for _ in range(3))]
    signed = [f - (1 << 64) if f >> 63 else f for f in dict.fromkeys(fps)]
    got = {(r["u"], r["v"]) for r in simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long")).collect()}
    assert got == {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 3}


def test_simhash_families_are_the_components(spark):
    rng = random.Random(14)
    fps = set()
    for _ in range(6):
        base = rng.getrandbits(64)
        for _ in range(60):  # dense families, some members only reached through others
            f = base
            for b in rng.sample(range(64), rng.randint(0, 5)):
                f ^= 1 << b
            fps.add(f)
    signed = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    nodes = spark.createDataFrame([(f,) for f in signed], "fp long")
    unsigned = lambda f: f & (2**64 - 1)
    want = union_find(signed, [(a, b) for a in signed for b in signed if a < b and unsigned(a ^ b).bit_count() <= 3])
    forest = simhash.block_links(nodes)
    for r in forest.collect():
        assert want[r["u"]] == want[r["v"]]
    families = {r["node"]: r["component"] for r in components(forest).collect()}
    known = spark.createDataFrame([(f, families.get(f, f)) for f in signed], "fp long, family long")
    pairs = simhash.links(known, family_col="family")
    assert pairs.count() < simhash.links(nodes).count()
    got = {r["node"]: r["component"] for r in components(forest.unionByName(pairs)).collect()}
    assert {f: got.get(f, f) for f in signed} == want


def test_simhash_empty(empty):
    assert simhash.near_duplicates(empty).count() == 0


def plain_shingles(text, size):
    ws = (text or "").encode().lower().split()
    return {b" ".join(ws[i : i + size]) for i in range(len(ws) - size + 1)} or ({b" ".join(ws)} if ws else set())


def alike(a, b, similarity=0.8):
    return not (a or b) or bool(a or b) and len(a & b) >= similarity * len(a | b)


def edited(rng, text, share):
    return " ".join(rng.choice(WORDS) + "x" if rng.random() < share else w for w in text.split())


def test_similar_documents_against_brute_force(spark, texts):
    rng = random.Random(6)
    base = [prose(rng, rng.randint(20, 300)) for _ in range(30)]
    rows = [*texts, *base, *(edited(rng, t, share) for t in base for share in (0.005, 0.02, 0.03, 0.06))]
    hot = prose(rng, 150)
    rows += [edited(rng, hot, 0.01) for _ in range(150)] + [hot] * 40
    footer = prose(rng, 60)  # much in common, but not enough
    rows += [f"{prose(rng, 30)} {footer}" for _ in range(40)]
    sets = {i * 2: plain_shingles(t, 5) for i, t in enumerate(rows)}
    comp = union_find(sets, [(a, b) for a in sets for b in sets if a < b and alike(sets[a], sets[b])])
    df = spark.createDataFrame([(i * 2, t, "clash") for i, t in enumerate(rows)], "doc_id long, text string, node string").repartition(6)
    assert {r.doc_id: r.component_id for r in simhash.similar_documents(df).collect()} == comp
    assert len(set(comp.values())) < len(rows) - 150


def test_similar_documents_by_fingerprints_and_first_shingles():
    """The named steps: sign bits of the set's hashes, blocks as keys; what shares no block still meets."""
    rng = random.Random(12)
    text = prose(rng, 900)
    h = simhash.shingles(text, 5)
    fp = simhash.wide_fingerprint(h)
    wide = simhash._mixed((h[:, None] ^ simhash._SEEDS) * simhash._MIX)
    bits = [2 * sum(int(x) >> (8 * (i % 64 // 8) + 7 - i % 8) & 1 for x in wide[:, i // 64]) > len(h) for i in range(768)]
    assert np.unpackbits(fp).tolist() == bits
    assert simhash.wide_keys(fp)[0].tolist() == [(k << 24) | int("".join(str(int(b)) for b in bits[24 * k : 24 * k + 24]), 2) for k in range(32)]
    order = np.sort(rng.sample(h.tolist(), 200)).astype(np.uint64)
    for share in (0.005, 0.01, 0.02, 0.03):
        other = simhash.shingles(edited(rng, text, share), 5)
        both = len(np.intersect1d(h, other))
        if both >= 0.8 * (len(h) + len(other) - both):
            a, b = (simhash.first_shingles(x, order, np.arange(200), 0.8) for x in (h, other))
            t = int(np.ceil(0.8 / 1.8 * (len(h) + len(other)) - 1e-6))
            assert len(np.intersect1d(a, b)) >= t - int(np.ceil(0.8 * max(len(h), len(other)) - 1e-9)) + 1 >= 1
        apart = sum((int(x) ^ int(y)).bit_count() for x, y in zip(simhash.parities(h).view(np.uint64), simhash.parities(other).view(np.uint64)))
        assert apart <= len(h) + len(other) - 2 * both


def test_similar_documents_of_long_texts_and_a_family(spark, monkeypatch):
    """Also without any block in common, all links are found."""
    rng = random.Random(13)
    long, hot = prose(rng, 900), prose(rng, 145)
    rows = [edited(rng, t, share) for t in (long, prose(rng, 700)) for share in (0, 0.01, 0.02, 0.024, 0.04)] + [edited(rng, hot, rng.choice((0.01, 0.02, 0.03))) for _ in range(60)]
    sets = {i: plain_shingles(t, 5) for i, t in enumerate(rows)}
    comp = union_find(sets, [(a, b) for a in sets for b in sets if a < b and alike(sets[a], sets[b])])
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(3)
    for far in (simhash.FAR_BITS, -1):
        monkeypatch.setattr(simhash, "FAR_BITS", far)
        assert {r.doc_id: r.component_id for r in simhash.similar_documents(df).collect()} == comp


def test_similar_documents_shared_passages_come_last(spark, monkeypatch):
    """Texts that share a passage, each with only one other of all the rows, don't meet by its shingles."""
    rng = random.Random(15)
    rows = []
    for _ in range(80):
        passage = prose(rng, 100)
        rows += [f"{' '.join(f'{w}{rng.getrandbits(40)}' for w in prose(rng, 100).split())} {passage}" for _ in range(2)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(4)
    held, first_pairs = [], simhash._first_pairs

    def seen(made, nodes, similarity):
        held.extend(np.frombuffer(r.first, np.uint64) for r in made.select("first").collect())
        return first_pairs(made, nodes, similarity)

    monkeypatch.setattr(simhash, "_first_pairs", seen)
    assert {r.doc_id: r.component_id for r in simhash.similar_documents(df).collect()} == {i: i for i in range(len(rows))}
    assert len(held) == len(rows) and len(np.unique(np.concatenate(held))) == sum(map(len, held))


def test_first_shingles_are_those_that_fewest_texts_hold_whatever_their_number(spark, monkeypatch):
    """Far more shingles than places to count them in, in many parts: each is counted by itself all the same."""
    for name, n in (("PLACES", 1 << 10), ("PART", 1 << 6), ("COUNTED", 600)):
        monkeypatch.setattr(simhash, name, n, raising=False)
    rng = random.Random(17)
    shared = [prose(rng, 110) for _ in range(3)]
    own = lambda n: " ".join(f"{w}{rng.getrandbits(40)}" for w in prose(rng, n).split())
    rows = [f"{own(rng.choice((8, 20, 60)))} {shared[i % 3][: rng.choice((300, 10**6))]}" for i in range(60)]
    rows += [rows[0], rows[4], "one two", "one two three"]
    found, first_pairs = [], simhash._first_pairs

    def seen(made, nodes, similarity):
        found.extend(made.collect())
        return first_pairs(made, nodes, similarity)

    monkeypatch.setattr(simhash, "_first_pairs", seen)
    df = spark.createDataFrame(spark.sparkContext.parallelize(list(enumerate(rows)), 4), "doc_id long, text string")
    sets = {i: plain_shingles(t, 5) for i, t in enumerate(rows)}
    comp = union_find(sets, [(a, b) for a in sets for b in sets if a < b and alike(sets[a], sets[b])])
    assert {r.doc_id: r.component_id for r in simhash.similar_documents(df).collect()} == comp
    hashed = [simhash.shingles(t, 5) for t in rows]
    rows_of, texts_of = (Counter(x for h in some for x in h.tolist()) for some in (hashed, [simhash.shingles(t, 5) for t in dict.fromkeys(rows)]))
    bits = 32 + max(6, (sum(map(len, hashed)) // 600).bit_length())
    want = {}
    for h in hashed:
        order = sorted((x for x in h.tolist() if rows_of[x] > 1), key=lambda x: (texts_of[x], x >> (64 - bits)))
        skipped = len(h) - len(order)
        want[simhash._node(h)] = (skipped, [x >> (64 - bits) for x in order[: max(0, len(h) - math.ceil(0.8 * len(h) - 1e-9) + 1 - skipped)]])
    assert {r.node: (r.skipped, np.frombuffer(r.first, np.int64).tolist()) for r in found} == want
    assert 0 < sum(len(first) for _, first in want.values()) and any(not first for _, first in want.values())


def test_shingles_are_counted_in_all_rows(spark):
    rng = random.Random(16)
    rows = [prose(rng, rng.randint(0, 200)) for _ in range(60)] * 2
    df = spark.createDataFrame([(t,) for t in [*rows, None, ""]], "text string")
    want = np.zeros(simhash.PLACES, np.int64)
    for t in dict.fromkeys(rows):
        np.add.at(want, simhash.places(simhash.shingles(t, 5)), 1)
    assert (simhash._levels(df.coalesce(1), 5) == np.round(8 * np.log2(1 + want))).all()
    want *= 2  # each row's copy in another task
    halves = spark.createDataFrame(spark.sparkContext.parallelize([(t,) for t in rows], 2), "text string")
    assert (simhash._levels(halves, 5) == np.round(8 * np.log2(1 + want))).all()


def test_similar_documents_defined_cases(spark, empty):
    assert simhash.similar_documents(empty).count() == 0
    t = "a b c d e f g h i j k l"
    rows = [(None, t), (4, t), (4, t), (2, t.upper()), (7, None), (6, " "), (9, "one two"), (8, "one  two"), (None, None)]
    got = sorted(((r.doc_id or 0, r.component_id) for r in simhash.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == sorted([(0, None), (0, None), (4, 2), (4, 2), (2, 2), (7, 6), (6, 6), (9, 8), (8, 8)], key=str)


# ---------------------------------------------------------------- 4


def test_bpe_round_trip_and_reference(docs, texts):
    import tiktoken

    path = f"{queries.TOKENIZERS}/byte_bpe_multi_50k.tiktoken"
    content = open(path, "rb").read()
    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in content.splitlines())}
    ref = tiktoken.Encoding("ref", pat_str=queries.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(8)
    marks = ["'re", "'s", " ", "  ", "\n", "\n\n", "\t", " ", "abc", "12", "!!", "été", "'", "x ", " ", "<|endoftext|>", "'l", "l"]
    hard = ["".join(rng.choice(marks) for _ in range(rng.randint(0, 200))) for _ in range(200)] + [t or "" for t in texts]
    for leaf in (2, 7, 64):
        tree = bpe.TreeBPE(content, queries.PATTERN, leaf)
        for t in hard:
            ids = tree.encode(t)
            assert ids == ref.encode_ordinary(t)
            assert tree.decode(ids) == t.encode()
    got = by_id(bpe.digests(docs, path, queries.PATTERN))
    for i, t in enumerate(texts):
        ids = np.array(ref.encode_ordinary(t or ""), "<u4")
        assert got[3 * i] == {"doc_id": 3 * i, "n_tokens": len(ids), "ids_sha256": hashlib.sha256(ids.tobytes()).hexdigest(), "decoded_sha256": hashlib.sha256((t or "").encode()).hexdigest()}
    whole = by_id(bpe.encode_documents(docs, path, queries.PATTERN))
    assert bytes(whole[0]["decoded"]).decode() == texts[0] and whole[0]["score"] == "clash"


# ---------------------------------------------------------------- 5


def plain_repeats(ws, n=8):
    seen = Counter(tuple(ws[i : i + n]) for i in range(len(ws) - n + 1))
    hit = {p for i in range(len(ws) - n + 1) if seen[tuple(ws[i : i + n])] > 1 for p in range(i, i + n)}
    return len(hit)


def test_quality_measures(docs, texts):
    got = by_id(quality.ledger(docs))
    for i, t in enumerate(texts):
        ws = (t or "").split() if (t or "").isascii() else quality.words(t)
        r = got[3 * i]
        assert (r["n_words"], r["word_chars"], r["n_repeat_words"]) == (len(ws), sum(map(len, ws)), plain_repeats(ws))
        assert bool(r["fail_bits"] & quality.BIT["few_words"]) == (len(ws) < 20)
    rng = random.Random(1)
    for _ in range(200):
        ws = [rng.choice("abc") for _ in range(rng.randint(0, 40))]
        assert quality.repeated_window_words(ws, 3) == plain_repeats(ws, 3)
        assert quality.repeated_window_words(ws) == plain_repeats(ws)


def test_quality_policies_and_ablation(docs, texts, empty):
    led = quality.ledger(docs)
    bits = [r["fail_bits"] for r in led.collect()]
    rows = {(r["policy"], r["rule"]): r for r in quality.ablation(led).collect()}
    for p in quality.POLICIES:
        for rule in p.rules:
            assert rows[p.name, rule]["n_failed"] == sum(b & quality.BIT[rule] > 0 for b in bits)
            assert rows[p.name, rule]["n_alone"] == sum(b & p.mask == quality.BIT[rule] for b in bits)
    kept = quality.keep_passing(docs)
    assert kept.columns == docs.columns and kept.count() == sum(b & quality.STRICT.mask == 0 for b in bits)
    assert quality.ledger(empty).count() == quality.keep_passing(empty).count() == 0


# ---------------------------------------------------------------- 6


def test_license_scan(spark, empty):
    rows = [
        (1, "prose\nLicensed under the Apache License, Version 2.0.\nmore", "Apache-2.0"),
        (2, "This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
        (3, "This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
        (4, "Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
        (5, "Licensed under CC BY 4.0.", "CC-BY-4.0"),
        (6, "the license of the river was long", ""),
        (7, None, ""),
        (8, "", ""),
        (9, "Released under the MIT License.\n\nAll rights reserved.", "All-Rights-Reserved,MIT"),
        (10, "Licensed under the Apache License, Version 1.1.", ""),
        (11, licenses.TEMPLATES["MIT"][2].replace("free of charge, ", ""), "MIT"),
        (12, "x " * 30000 + "\nReleased under the MIT License.\n" + "y " * 30000, "MIT"),
    ]
    df = spark.createDataFrame([(a, b, "clash") for a, b, _ in rows], "doc_id long, text string, found string")
    got = {k: ",".join(sorted({f["license"] for f in v["found"]})) for k, v in by_id(licenses.scan(df)).items()}
    assert got == {a: c for a, _, c in rows}
    assert licenses.scan(empty).count() == 0
    assert "-free" in by_id(licenses.scan(df))[11]["found"][0]["differences"]


def test_license_templates_wrapped():
    import textwrap

    scanner = licenses.Scanner()
    for name, of in licenses.TEMPLATES.items():
        for t in of:
            want = licenses.wording(t)
            assert sum(bool(licenses._CUE.match(w)) for w in want) > (1 - licenses.COVERAGE) * len(want), (name, t)
            for lines in ([t], textwrap.wrap(t, 70), textwrap.wrap(t, 80), ["", *textwrap.wrap(t, 40)], [" * " + x for x in textwrap.wrap(t, 75)]):
                text = "\n".join(["a river of stone"] * 5 + lines + ["and winter came"] * 5)
                assert {f[1] for f in scanner.scan(text)[1]} == {name}, (name, lines)


def test_license_templates_in_one_block():
    text = "\n".join(of[0] for of in licenses.TEMPLATES.values())
    assert {f[1] for f in licenses.Scanner().scan(text)[1]} == set(licenses.TEMPLATES)


def test_license_siblings_are_told_apart():
    found = lambda t: sorted({f[1] for f in licenses.Scanner().scan(f"a river {t} and winter")[1]})
    gpl = "you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    for name, kind in (("GPL-3.0", "General Public License"), ("LGPL-3.0", "Lesser General Public License"), ("AGPL-3.0", "Affero General Public License")):
        assert found("This program is free software: " + gpl.format(kind)) == [name]
    three, two = licenses.TEMPLATES["BSD-3-Clause"][0], licenses.TEMPLATES["BSD-2-Clause"][0]
    assert found(three.replace("copyright holder nor", "Regents nor")) == ["BSD-3-Clause"] and found(two) == ["BSD-2-Clause"]
    assert found(licenses.TEMPLATES["ISC"][0]) == ["ISC"] and found(licenses.TEMPLATES["0BSD"][0]) == ["0BSD"]
    assert found(licenses.TEMPLATES["MIT-0"][0]) == ["MIT-0"]
    assert found("under the Apache License, Version 2.0 or MIT license") == ["Apache-2.0", "MIT"]


def test_license_is_the_template_that_compresses_best():
    """Both wordings are confirmed at one place; the one with fewer words makes it smaller."""
    said = "permission granted hereby distribute software copies freely among harbours without warrant notice nor retained domain rights so".split()
    wide = said[:5] + ["perpetually"] + said[5:11] + ["universally"] + said[11:]
    scanner = licenses.Scanner({"Wide": (" ".join(wide),), "Exact": (" ".join(said[:-1]),)})
    text = f"a river {' '.join(said)} and winter"
    assert all(scanner._places(i, licenses.wording(text)) for i in (0, 1))
    saved = scanner.reductions(text)
    assert len(saved) == 2 and saved[1] > saved[0] > 0
    assert [(f[1], f[2]) for f in scanner.scan(text)[1]] == [("Exact", saved[1])]
    # every template is tried on a block, and the licenses found come in the order of what they save
    block = f"{licenses.TEMPLATES['ISC'][0]} {licenses.TEMPLATES['MIT'][2]} All rights reserved."
    whole = licenses.Scanner()
    found = whole.scan(block)[1]
    assert len(whole.reductions(block)) == len(whole.entries) and [f[2] for f in found] == sorted((f[2] for f in found), reverse=True)
    assert {f[1] for f in found} == {"ISC", "MIT", "All-Rights-Reserved"}


def test_license_scan_equals_a_comparison_of_all_templates():
    """Against every template at every place of the whole text, without blocks, word counts or memory."""
    rng = random.Random(8)
    scanner = licenses.Scanner()
    for _ in range(12):
        picked = rng.sample(sorted(licenses.TEMPLATES), 2)
        parts = [prose(rng, 40), rng.choice(licenses.TEMPLATES[picked[0]]), prose(rng, 90), rng.choice(licenses.TEMPLATES[picked[1]]), prose(rng, 30)]
        text = " ".join(parts)
        words = licenses.wording(text)
        places = []
        for i, (name, _, want) in enumerate(scanner.entries):
            for s in range(len(words)):
                if words[s] in want:
                    got = scanner._compare(i, tuple(words[s : s + licenses.reach(len(want))]))
                    if got:
                        places.append((-round(got[0] * len(want)), -got[0], name, s + got[1], s + got[2]))
        taken, want_names = [], set()
        for _, _, name, lo, hi in sorted(places):
            if not any(lo < z and a < hi for a, z in taken):
                taken.append((lo, hi))
                want_names.add(name)
        assert {f[1] for f in scanner.scan(text)[1]} == want_names == set(picked)


def plain_languages(rows):
    """What (id, text, declared, host) rows are identified as, step by step on one machine."""
    slots = {i: langid.trigram_slots(t or "") for i, t, _, _ in rows}
    counts = {}
    for i, _, d, _ in rows:
        if d:
            counts[d] = counts.get(d, 0) + np.bincount(slots[i], minlength=langid.SLOTS)
    codes = sorted(c for c in counts if counts[c].sum() >= langid.MIN_TRIGRAMS)
    logs = {}
    for i, _, _, _ in rows:
        n = len(slots[i])
        if n:
            w = [np.log((counts[c] + 0.5) / (counts[c] + 0.5).sum()) for c in codes]
            logs[i] = np.array([x[slots[i]].sum() for x in w]) / n * (n * langid.TEXT_WEIGHT / (n + langid.TEXT_WEIGHT))
    seen = Counter((d, h, int(np.argmax(logs[i]))) for i, _, d, h in rows if i in logs)
    k = len(codes)
    whole = np.array([sum(n for (_, _, j), n in seen.items() if j == x) for x in range(k)])
    base = (whole + 1) / (whole.sum() + k)
    said = {d: np.ones(k) for d, _, _ in seen if d}
    for (d, _, j), n in seen.items():
        if d:
            said[d][j] += n
    out = {}
    for i, _, d, h in rows:
        at = np.array([sum(n for (_, y, j), n in seen.items() if y == h and j == x) for x in range(k)]) if h else np.zeros(k)
        prior = (at + langid.HOST_STRENGTH * base) / (at.sum() + langid.HOST_STRENGTH) if at.sum() else base
        post = np.log(prior) + logs.get(i, 0)
        if d in said:
            post = post + np.log(said[d] / sum(said.values()))
        out[i] = (codes[int(np.argmax(post))], 1 / np.exp(post - post.max()).sum())
    return out


def test_language_fusion_against_a_plain_version(spark):
    rng = random.Random(17)
    words = {"en": WORDS, "fr": "le jardin et la maison avec des fleurs dans une rue pour tous".split(), "de": "der garten und das haus mit den blumen auf einer strasse".split()}
    rows = []
    for i in range(240):
        true = rng.choice(["en", "en", "fr", "de"])
        text = " ".join(rng.choice(words[true]) for _ in range(rng.choice([1, 2, 5, 40])))
        declared = rng.choice([true, true, true, "en", None])
        rows.append((i, rng.choice([text] * 9 + [None, "", "12 34"]), declared, rng.choice([f"{true}.host", "mixed", None])))
    df = spark.createDataFrame(rows, "doc_id long, text string, declared string, host string").repartition(4)
    got = by_id(langid.identify(df, F.col("declared"), F.col("host")))
    for i, (code, confidence) in plain_languages(rows).items():
        assert got[i]["lang_id"] == code and got[i]["lang_confidence"] == pytest.approx(confidence, rel=1e-3), i


def test_language_columns_of_any_name(spark):
    """Rows' own columns may be named as those the operator makes."""
    texts = {"en": "the house and the river with the garden ", "fr": "le jardin et la maison avec les fleurs "}
    rows = [(i, texts["en" if i % 2 else "fr"] * 4, "en" if i % 2 else "fr", "h", "x", "y") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, `__declared` string, `__host` string, `__logs` string, `__suffix` string")
    got = by_id(langid.identify(df, F.col("__declared"), F.col("__host")))
    assert all(got[i]["lang_id"] == ("en" if i % 2 else "fr") and got[i]["__logs"] == "x" for i in range(60))
    pages = spark.createDataFrame([(1, "http://a.fr/x", "<html lang=fr>le jardin</html>", "mine", "d")], "page_id long, url string, html string, text string, declared string")
    r = langid.page_evidence(pages).first()
    assert (r["text"].strip(), r["declared"], r["host"], r["suffix"]) == ("le jardin", "fr", "a.fr", "fr")
    assert langid.identify(langid.page_evidence(pages.limit(0)), F.col("declared"), F.col("host"), F.col("suffix")).count() == 0
    clash = df.withColumnRenamed("__logs", "__settled").withColumn("id", F.lit(3))
    assert sadedup.deduplicated(clash).columns == clash.columns and sadedup.deduplicated(clash).where("`__settled` = 'x' AND id = 3").count() == 60


# ---------------------------------------------------------------- 7


def plain_removal(pairs, length):
    seen, out = set(), {}
    for key, t in sorted(pairs, key=lambda x: x[0]):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            w = b[i : i + length]
            if w in seen:
                gone[i : i + length] = True
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out[key] = {"doc_id": key, "n_bytes": len(b), "n_removed": int(gone.sum()), "n_spans": spans, "kept_sha256": hashlib.sha256(kept).hexdigest()}
    return out


@pytest.mark.parametrize("block,part,windows", [(16 << 20, 2 << 20, 150_000), (3000, 700, 200)])
def test_suffix_array_dedup(spark, docs, texts, monkeypatch, block, part, windows):
    monkeypatch.setattr(sadedup, "BLOCK", block)
    monkeypatch.setattr(sadedup, "PART", part)
    monkeypatch.setattr(sadedup, "WINDOWS", windows)
    more = [(10_000 + i, t) for i, t in enumerate(["z" * 99, "z" * 100, "z" * 450, "ab" * 200, texts[0], "q" * 30 + "ab" * 90])]
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string")).repartition(3)
    want = plain_removal([(3 * i, t) for i, t in enumerate(texts)] + more, 100)
    assert by_id(sadedup.digests(df)) == want
    left = by_id(sadedup.deduplicated(docs))
    assert left[0]["text"] == texts[0] and left[0]["score"] == "clash"


def test_suffix_array_dedup_random_small_alphabet(spark):
    rng = random.Random(6)
    pool = ["".join(rng.choice("ab") for _ in range(60)) for _ in range(4)]
    rows = [(i, "".join(rng.choice(pool) for _ in range(rng.randint(0, 7)))) for i in range(40)]
    assert by_id(sadedup.digests(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))) == plain_removal(rows, 100)


def test_deep_shallow_sorts_suffixes():
    rng = random.Random(7)
    text = "".join(rng.choice(["abab", "passage of words ", "x", "zz "]) for _ in range(300)).encode()
    places = np.array(sorted(rng.sample(range(len(text) - 100), 400)))
    order, equal = sadedup.deep_shallow(text, places)
    cut = [text[p : p + 100] for p in places.tolist()]
    assert [cut[i] for i in order] == sorted(cut)
    assert equal.tolist() == [False] + [a == b for a, b in zip(sorted(cut), sorted(cut)[1:])]
    assert all(a < b for a, b, e in zip(order, order[1:], equal[1:]) if e)


@pytest.mark.parametrize("block", [16 << 20, 900])
def test_suffix_array_dedup_of_repeated_rows(spark, monkeypatch, block):
    monkeypatch.setattr(sadedup, "BLOCK", block)
    rng = random.Random(11)
    passage = prose(rng, 30)
    pairs = [(1, prose(rng, 50) + passage), (2, prose(rng, 20) + passage * 2), (3, "ab" * 150), (4, prose(rng, 40))]
    want = plain_removal(pairs, 100)
    rows = spark.createDataFrame(pairs * 3 + [(None, passage)], "doc_id long, text string").repartition(5)
    got = [r.asDict() for r in sadedup.digests(rows).collect()]
    assert len(got) == 13 and all(r == want[r["doc_id"]] for r in got if r["doc_id"])
    assert next(r for r in got if r["doc_id"] is None)["n_removed"] == 0


def test_suffix_array_dedup_empty(empty, spark):
    assert sadedup.digests(empty).count() == sadedup.deduplicated(empty).count() == 0


# ---------------------------------------------------------------- 8


def test_packing(docs, texts, empty):
    from tokenizers import Tokenizer

    path = f"{queries.TOKENIZERS}/word_bpe_49k.json"
    ref = Tokenizer.from_file(path)
    for capacity in (64, 2048):
        rows = packing.pack(packing.pieces(docs, path, capacity=capacity), capacity).collect()
        ids = {3 * i: ref.encode(t or "", add_special_tokens=False).ids + [0] for i, t in enumerate(texts)}
        got, used = Counter(), {}
        for r in rows:
            part = ids[r["id"]][r["start"] : r["start"] + r["length"]]
            assert r["start"] == r["piece"] * capacity and len(part) == r["length"]
            assert zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]
            got[r["id"]] += r["length"]
            used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert got == {k: len(v) for k, v in ids.items()}
        for places in used.values():
            at = 0
            for offset, length in sorted(places):
                assert offset == at
                at += length
            assert at <= capacity
        assert len(used) <= math.ceil(sum(got.values()) / capacity * 1.1) + 1
    assert packing.pack_documents(empty, path).count() == 0


def test_packing_in_many_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 200)
    rng = random.Random(3)
    sizes = [rng.randint(1, 100) for _ in range(1500)]
    parts = spark.createDataFrame([(i, 0, 0, s, 0) for i, s in enumerate(sizes)], "id long, piece int, start long, length long, ids_crc32 long")
    rows = packing.pack(parts, 100).collect()
    assert sorted(r["id"] for r in rows) == list(range(1500))
    load = Counter()
    for r in rows:
        load[r["sequence_id"]] += r["length"]
    assert max(load.values()) <= 100 and len(load) <= math.ceil(sum(sizes) / 100) * 1.06 + 1


def test_sequences_hold_the_ids(docs, texts):
    path = f"{queries.TOKENIZERS}/word_bpe_49k.json"
    packed = packing.pack_documents(docs, path)
    toks = packing.tokens(docs, path)
    seqs = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(toks, packed).collect()}
    for r in packed.collect():
        part = seqs[r["sequence_id"]][4 * r["offset"] : 4 * (r["offset"] + r["length"])]
        assert zlib.crc32(part) == r["ids_crc32"]


def test_word_tokenizer_agrees_with_the_library():
    t = packing.WordTokenizer(open(f"{queries.TOKENIZERS}/word_bpe_49k.json").read())
    rng = random.Random(9)
    alphabet = "abcXYZ 012'’!?-_\n\téèÀßñœİſª²½ ́　日本😀\x1f\x85"
    for _ in range(800):
        s = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
        assert t.encode(s) == t._library(s), repr(s)


# ---------------------------------------------------------------- 9


def test_language_id(spark, empty):
    say = {"en": "the house and the river of stone with winter ", "fr": "la maison et le fleuve de pierre avec l'hiver ", "de": "das haus und der fluss aus stein mit winter "}
    rows = [(i, say[lang] * (1 + i % 3), lang, f"{lang}.example.org" if i % 5 else "mixed.example.org") for i, lang in enumerate(["en", "fr", "de"] * 40)]
    rows += [(500, say["fr"] * 4, "en", "fr.example.org"), (501, None, "de", "de.example.org"), (502, "", None, None), (503, "12 34 !!", "fr", None), (504, say["de"], "zz-bad-code", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, declared string, host string")
    got = by_id(langid.identify(df, F.col("declared"), F.col("host"), F.lit(None).cast("string")).withColumn("kept", langid.verdict()))
    assert all(got[i]["lang_id"] == lang for i, (_, _, lang, _) in enumerate(rows[:120]))
    assert got[500]["lang_id"] == "fr" and got[501]["lang_id"] == "de" and got[503]["lang_id"] == "fr" and got[504]["lang_id"] == "de"
    assert got[501]["lang_text"] is None and not got[502]["kept"] and got[0]["kept"]
    assert langid.identify(empty, F.col("lang"), F.col("source")).count() == 0


def test_language_verdict_rejects(spark):
    say = {"en": "the house and the river of stone with winter ", "fr": "la maison et le fleuve de pierre avec l'hiver "}
    rows = [(i, say[lang] * (1 + i % 3), lang, f"{lang}.example.org") for i, lang in enumerate(["en", "fr"] * 200)]
    planted = [(500, "le r", "en", "en.example.org"), (501, "dom nad rzeką był zbudowany z kamienia zimą " * 3, "en", "en.example.org"), (502, "qzx vkj wqp zzkx jjqv xkcd pvvq " * 4, "fr", "fr.example.org")]
    df = spark.createDataFrame(rows + planted, "doc_id long, text string, declared string, host string")
    got = by_id(langid.identify(df, F.col("declared"), F.col("host")).withColumn("kept", langid.verdict()))
    assert got[500]["lang_id"] == "en" and got[500]["lang_text"] == "fr"  # declaration and host outweigh a short text
    assert all(got[i]["lang_confidence"] >= langid.MIN_CONFIDENCE and not got[i]["kept"] for i in (500, 501, 502))
    assert all(got[i]["kept"] for i in range(400))


def test_rare_language_among_many(spark):
    many = spark.range(30000).select(F.col("id").alias("doc_id"), F.lit("the house and the river of stone with winter ").alias("text"), F.lit("en").alias("declared"), F.lit("hot.example.org").alias("host"))
    rare = spark.createDataFrame([(90000 + i, "la maison et le fleuve de pierre avec l'hiver " * 6, "fr", None) for i in range(2)], "doc_id long, text string, declared string, host string")
    got = langid.identify(many.unionByName(rare), F.col("declared"), F.col("host")).withColumn("kept", langid.verdict())
    assert {(r.lang_id, r.kept, r["count"]) for r in got.groupBy("lang_id", "kept").count().collect()} == {("en", True, 30000), ("fr", True, 2)}


def test_language_of_pages(spark):
    html = "<html lang='{}'><script>var x = 'the of';</script><body><p>{}</p></body></html>"
    say = {"en": "the house and the river of stone", "fr": "la maison et le fleuve de pierre"}
    rows = [(i, f"http://u@host{i % 3}.example.{('com', 'fr')[i % 2]}:80/x", html.format(("en", "fr-FR")[i % 2], say[("en", "fr")[i % 2]] * 4)) for i in range(40)]
    rows += [(100, None, None), (101, "nonsense", "<p>la maison et le fleuve")]
    pages = langid.page_evidence(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = by_id(langid.identify(pages, F.col("declared"), F.col("host"), F.col("suffix")), "page_id")
    assert all(got[i]["lang_id"] == ("en", "fr")[i % 2] for i in range(40)) and got[101]["lang_id"] == "fr"
    assert got[0]["host"] == "host0.example.com" and got[1]["suffix"] == "fr" and "var" not in got[0]["text"]


# ---------------------------------------------------------------- 10


def plain_ctw(train, texts, depth):
    """Counts of every context and decision, then the recursive mixture, in the plainest way."""
    count = {}

    def decisions(s, i):
        ctx = tuple(s[i - d] if i - d >= 0 else 256 for d in range(1, depth + 1))
        bits = [s[i] >> (8 - j) & 1 for j in range(9)] if s[i] != 256 else [1]
        for j, b in enumerate(bits):
            yield ctx, ((1 << j) | (s[i] >> (9 - j))), b

    def symbols(t):
        return [*t.encode().lower(), 256]

    for t in train:
        s = symbols(t)
        for i in range(len(s)):
            for ctx, node, b in decisions(s, i):
                for d in range(depth + 1):
                    count.setdefault((ctx[:d], node), [0, 0])[b] += 1
    children = {}
    for ctx, node in count:
        if ctx:
            children.setdefault((ctx[:-1], node), []).append((ctx, node))

    def kt(n):
        return math.lgamma(n[0] + 0.5) + math.lgamma(n[1] + 0.5) - math.lgamma(sum(n) + 1) - math.log(math.pi)

    memo = {}

    def weighted(key):
        if key not in memo:
            own = kt(count[key])
            memo[key] = own if len(key[0]) == depth else float(np.logaddexp(own, sum(weighted(c) for c in children[key]))) - math.log(2)
        return memo[key]

    def one(ctx, node, d):
        n = count.get((ctx[:d], node))
        if n is None:
            return 0.5
        p = (n[1] + 0.5) / (sum(n) + 1)
        if d == depth:
            return p
        w = math.exp(kt(n) - math.log(2) - weighted((ctx[:d], node)))
        return w * p + (1 - w) * (one(ctx, node, d + 1) if (ctx[: d + 1], node) in count else p)

    out = []
    for t in texts:
        s = symbols(t)
        out.append(sum(math.log10(p if b else 1 - p) for i in range(len(s)) for ctx, node, b in decisions(s, i) for p in [one(ctx, node, 0)]))
    return out


def test_lm_against_brute_force(spark, docs, texts, empty, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK", 4000)
    train = {3 * i: zlib.crc32(str(3 * i).encode()) % 10 != 0 for i in range(len(texts))}
    marked = docs.withColumn("train", F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(10)) != 0)
    got = by_id(lm.score(marked, "train"))
    toks = {3 * i: [*(t or "").encode().lower().split(), None] for i, t in enumerate(texts)}
    c = Counter(w for k, ws in toks.items() if train[k] for w in ws)
    n, v = sum(c.values()), len(c)
    short = [(3 * i, t or "") for i, t in enumerate(texts) if len(t or "") < 900]
    model = dict(zip([k for k, _ in short], plain_ctw([t or "" for i, t in enumerate(texts) if train[3 * i]], [t for _, t in short], lm.DEPTH)))
    for k, ws in toks.items():
        r = got[k]
        assert (r["train"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (train[k], len(ws), sum(c[w] > 0 for w in ws), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), rel=1e-9)
        if k in model:
            assert r["score"] == pytest.approx(model[k], rel=1e-6)
    assert lm.score(empty.withColumn("train", F.lit(True)), "train").count() == 0


def test_lm_without_training_texts(docs):
    got = lm.score(docs.where("length(text) < 50").withColumn("train", F.lit(False)), "train").collect()
    for r in got:
        assert r["n_known"] == 0 and r["base_score"] == pytest.approx(0.0)


# ---------------------------------------------------------------- cases that all operators share


def test_repeated_rows_and_clashing_columns(spark, docs):
    twice = docs.unionByName(docs)
    for name in ("fp", "fail_bits", "found", "sequence_id", "component_id", "lang_id", "w1", "id"):
        twice = twice.withColumn(name, F.lit(3))
    n = docs.count()
    path = f"{queries.TOKENIZERS}/byte_bpe_multi_50k.tiktoken"
    words = f"{queries.TOKENIZERS}/word_bpe_49k.json"
    outs = {
        "ledger": quality.ledger(twice), "kept": quality.keep_passing(twice, quality.Policy("none", 1, ())), "simhash": simhash.near_duplicates(twice),
        "bpe": bpe.encode_documents(twice, path, queries.PATTERN), "licenses": licenses.scan(twice), "suffix": sadedup.digests(twice), "left": sadedup.deduplicated(twice),
        "language": langid.identify(twice, F.col("lang"), F.col("source")), "lm": lm.score(twice.withColumn("train", F.lit(True)), "train"), "toxicity": toxicity.score(twice, toxicity.ToxicityModel(None)),
    }
    for name, out in outs.items():
        rows = [tuple(sorted(r.asDict().items(), key=lambda x: x[0])) for r in out.collect()]
        assert len(rows) == 2 * n, name
        counts = Counter(str(r) for r in rows)
        assert all(c == 2 for c in counts.values()), name
    once = packing.pack_documents(docs, words).agg(F.sum("length")).first()[0]
    assert packing.pack_documents(twice, words).agg(F.sum("length")).first()[0] == 2 * once


def test_null_ids_and_null_columns(spark):
    text = "the river and the house of stone in winter " * 6
    rows = [(None, text, None, None, None, None, None), (None, None, None, None, None, None, None), (1, text, None, None, None, None, None)]
    df = spark.createDataFrame(rows, DOCS)
    words = f"{queries.TOKENIZERS}/word_bpe_49k.json"
    assert quality.ledger(df).count() == simhash.near_duplicates(df).count() == licenses.scan(df).count() == sadedup.digests(df).count() == 3
    assert langid.identify(df, F.col("lang"), F.col("source")).count() == lm.score(df.withColumn("train", F.lit(None).cast("boolean")), "train").count() == 3
    assert packing.pack_documents(df, words).count() == 3
    assert bpe.digests(df, f"{queries.TOKENIZERS}/byte_bpe_multi_50k.tiktoken", queries.PATTERN).count() == 3
