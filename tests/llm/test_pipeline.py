"""The pipeline's stages against plain versions, each on what its predecessor kept."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from graphloom.llm import langid, quality, queries
from test_llm_operators import DOCS, alike, plain_removal, plain_repeats, plain_shingles, prose, union_find

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(21)
    texts = [prose(rng, rng.randint(25, 90)) for _ in range(50)]
    passage = prose(rng, 60)
    texts += [texts[3], texts[4], texts[5] + " and", None, "", "too short", "%% ## $$ " * 20, "LOUD WORDS HERE NOW " * 10, "word " * 60]
    texts += [f"{prose(rng, 15)} {passage} {prose(rng, 10)}" for _ in range(6)]
    return [(i, t, "en", f"src{i % 3}", len(t) if t else None) for i, t in enumerate(texts)]


def passes(text):
    ws = (text or "").split()
    n = len(ws)
    lines = [x for x in (text or "").split("\n") if x.strip()]
    return not (
        n < 20
        or 100 * plain_repeats(ws) > 30 * n
        or 10 * sum((text or "").count(c) for c in "#*$%&|<>") > 3 * n
        or 2 * sum(len(w) > 1 and w.isupper() for w in ws) > n
        or 2 * (len(lines) - len(set(lines))) > len(lines)
        or not 2 <= sum(map(len, ws)) / n <= 14
        or 2 * sum(any(c.isalpha() for c in w) for w in ws) < n
        or 10 * sum(a == b for a, b in zip(ws, ws[1:])) > 3 * n
    )


def test_stages(spark, rows, tmp_path):
    rules, language, near, suffix, packing = [f for _, f in corpus_pipeline.STAGES]
    docs = spark.createDataFrame(rows, COLUMNS).repartition(3)
    a = rules(spark, docs, "")
    assert a.columns == docs.columns and {r.doc_id for r in a.collect()} == {r[0] for r in rows if passes(r[1])}
    b = language(spark, a, "")
    assert b.columns == docs.columns and {tuple(r) for r in b.collect()} == {tuple(r) for r in a.collect()}
    c = near(spark, b, "")
    kept = {r.doc_id: r.text for r in b.collect()}
    # the job asks stages on word shingles for five words and a similarity of 0.8 or more
    sets = {k: plain_shingles(t, 5) for k, t in kept.items()}
    comp = union_find(sets, [(x, y) for x in sets for y in sets if x < y and alike(sets[x], sets[y])])
    assert c.columns == docs.columns and {r.doc_id for r in c.collect()} == set(comp.values()) and len(kept) > len(set(comp.values()))
    d = suffix(spark, c, "")
    want = plain_removal([(r.doc_id, r.text) for r in c.collect()], 100)
    got = {r.doc_id: r for r in d.collect()}
    assert d.columns == docs.columns and all(len(got[k].text.encode()) == w["n_bytes"] - w["n_removed"] for k, w in want.items())
    assert sum(w["n_removed"] for w in want.values()) > 0 and all(r.n_chars == len(r.text) for r in got.values())
    from tokenizers import Tokenizer

    ref = Tokenizer.from_file(f"{queries.TOKENIZERS}/word_bpe_49k.json")
    ids = {k: ref.encode(r.text, add_special_tokens=False).ids + [0] for k, r in got.items()}
    packed = packing(spark, d, "").collect()
    assert sum(r.length for r in packed) == sum(map(len, ids.values()))
    assert all(zlib.crc32(np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32 for r in packed)

    docs.write.parquet(str(tmp_path / "documents.parquet"))
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {(r.doc_id, r.piece, r.length, r.ids_crc32) for r in whole} == {(r.doc_id, r.piece, r.length, r.ids_crc32) for r in packed}


def test_rows_without_id_stay_in_the_near_duplicate_stage(spark):
    text = prose(random.Random(3), 60)
    docs = spark.createDataFrame([(None, text, "en", "s", 1), (None, text, "en", "s", 1), (1, text, "en", "s", 1), (2, text, "en", "s", 1)], COLUMNS)
    assert sorted((r.doc_id or 0) for r in corpus_pipeline.simhash_near_dedup(spark, docs, "").collect()) == [0, 0, 1]
    left = corpus_pipeline.suffix_array_dedup(spark, docs, "").collect()
    assert sorted((r.doc_id or 0, len(r.text)) for r in left) == [(0, len(text)), (0, len(text)), (1, len(text)), (2, 0)]


def test_run_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_rules_have_bits_of_their_own():
    assert len({1 << i for i, _ in enumerate(quality.RULES)}) == len(quality.BIT) and DOCS and langid.MIN_CONFIDENCE < 1
