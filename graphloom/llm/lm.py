"""Language-model scoring by context-tree weighting over bytes, beside a smoothed unigram.

Text is its UTF-8 bytes with A-Z in lower case, and an end mark. A symbol has nine binary decisions (end
or not, then eight bits). For each context of 0 to ``DEPTH`` preceding symbols and each decision in it, the
training texts give counts of zeros and ones, from these the Krichevsky-Trofimov block probability of a
node, and bottom-up the weighted probability of its subtree: half that of the node, half the product of
its children's. A decision is predicted along the path of its context, at each depth mixing the node's
estimate and what lies deeper by their posterior weights; a context not seen in training ends the path.
The score is the log10 probability of all decisions: minus the code length.

At scale: (context, symbol) grams are counted in blocks of text before anything is shuffled, and trees are
built in partitions by the last two symbols. Only the counts of depths 0 and 1 reach the driver, at most
257 x 256 rows whatever the corpus. No vocabulary is broadcast: texts are dealt into blocks, the distinct
words and grams of all blocks meet by key, and what a block doesn't know goes back to its texts.

Defined cases: a null or empty text is its end mark; repeated rows count and are scored each for itself, whatever
their ids: rows are dealt by id and text; equal counts have equal estimates; texts of any length are scored whole;
an empty table gives an empty result; without training texts all counts are 0 and each decision has
probability 1/2; further columns don't matter.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, partition_key, release

#: Preceding symbols that a context holds at most (with the symbol, 9 bits each, they fill 45 bits).
DEPTH = 4
END = 256
#: Bytes of text in a block.
BLOCK = 12 << 20
#: Tables of fewer than so many blocks are dealt into smaller ones, so that a cluster is busy.
BUSY = 48
_STEP = 1 << 20
_DOC_BITS = 19


def lowered(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass").lower()


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All grams of the texts, nearest symbol of the context highest and the coded symbol lowest, and their text's place."""
    pad = np.full(DEPTH, END, np.uint64)
    parts = []
    for t in texts:
        parts += [pad, np.frombuffer(t, np.uint8).astype(np.uint64), pad[:1]]
    a = np.concatenate(parts)
    lens = np.array([len(t) + 1 for t in texts])
    key = a[DEPTH:].copy()
    for back in range(1, DEPTH + 1):
        key |= a[DEPTH - back : len(a) - back] << np.uint64(9 * (DEPTH + 1 - back))
    first = np.cumsum(lens + DEPTH) - lens - DEPTH  # of each text, in key
    doc = np.repeat(np.arange(len(texts)), lens)
    at = np.arange(int(lens.sum())) - np.repeat(np.cumsum(lens) - lens, lens) + first[doc]
    return key[at], doc


def _steps(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Runs of texts of about _STEP bytes, a longer text alone."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and (size + len(t) > _STEP or i - start >= 1 << _DOC_BITS - 1):
            yield start, i
            start = i
            size = 0
        size += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


def _counted(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    k, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return k, np.bincount(inverse, np.concatenate(counts), len(k)).astype(np.int64)


def gram_counts(texts: list[bytes], trains: list[bool]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams of all texts, and how often each is in those that train."""
    keys, counts = [], []
    for train in (True, False):
        some = [t for t, y in zip(texts, trains) if y is train]
        for a, b in _steps(some):
            k = np.sort(grams(some[a:b])[0])
            at = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
            keys.append(k[at])
            counts.append(np.diff(np.append(at, len(k))) * train)
    return _counted(keys, counts)


def word_digests(ws: list[bytes]) -> np.ndarray:
    """Two longs a word, of its 128-bit digest."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, ws)), ">i8").astype(np.int64).reshape(-1, 2)


END_WORD = (0, 0)
WORD, GRAM = 0, 1


def block_items(texts: list[bytes], trains: list[bool]) -> dict[str, np.ndarray]:
    """The distinct words and grams of a block: kind, k1, k2 and n, the number of the word in texts that train."""
    seen: Counter[bytes] = Counter()
    others: set[bytes] = set()
    for t, train in zip(texts, trains):
        if train:
            seen.update(t.split())
        else:
            others.update(t.split())
    ws = [*seen, *(others - seen.keys())]
    d = word_digests(ws)
    k, _ = gram_counts(texts, trains)
    zeros = np.zeros(len(k), np.int64)
    return {
        "kind": np.concatenate((np.full(len(ws) + 1, WORD), np.full(len(k), GRAM))).astype(np.int32),
        "k1": np.concatenate((d[:, 0], [END_WORD[0]], k.astype(np.int64))),
        "k2": np.concatenate((d[:, 1], [END_WORD[1]], zeros)),
        "n": np.concatenate((np.array([seen[w] for w in ws], np.int64), [sum(trains)], zeros)),
    }


def count_grams(docs: DataFrame, text_col: str, train_col: str) -> DataFrame:
    """(k1, n) for the grams of all texts, n in those that train: block counts, summed by gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: list[bytes] = []
        trains: list[bool] = []

        def flush() -> pa.RecordBatch:
            k, n = gram_counts(texts, trains)
            texts.clear()
            trains.clear()
            release()
            return pa.RecordBatch.from_pydict({"k1": k.astype(np.int64), "n": n})

        size = 0
        for batch in batches:
            for t, train in zip(batch.column(0), batch.column(1).to_pylist()):
                texts.append(lowered(t.as_py() or ""))
                trains.append(bool(train))
                size += len(texts[-1])
                if size > BLOCK:
                    yield flush()
                    size = 0
        if texts:
            yield flush()

    items = docs.select(F.col(text_col), F.col(train_col)).mapInArrow(run, "k1 long, n long")
    return items.groupBy("k1").agg(F.sum("n").alias("n"))


# ------------------------------------------------------------------ the tree


def _log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Natural logarithm of the Krichevsky-Trofimov probability of n0 zeros and n1 ones."""
    lg = np.vectorize(math.lgamma, otypes=[float])
    return (lg(n0 + 0.5) + lg(n1 + 0.5) - lg(n0 + n1 + 1.0) - math.log(math.pi)) if len(n0) else np.zeros(0)


def _heap(symbol: np.ndarray, j: int) -> np.ndarray:
    """The number of the node of decision j on the way to a symbol: a one, then the bits so far."""
    return (1 << j) | (symbol >> (9 - j))


def _decided(symbol: np.ndarray, j: int) -> np.ndarray:
    """Which symbols take decision j: after the end mark's first bit there is none."""
    return np.ones(len(symbol), bool) if j == 0 else symbol != END


class _Level:
    """Nodes of one depth over sorted grams: for each decision, counts and the node of each gram."""

    def __init__(self, keys: np.ndarray, n: np.ndarray, depth: int):
        context = keys >> np.uint64(9 * (DEPTH + 1 - depth)) if depth else np.zeros(len(keys), np.uint64)
        change = np.concatenate(([0], (context[1:] != context[:-1]).astype(np.int64)))
        where, symbol = np.cumsum(change), (keys & np.uint64(511)).astype(np.int64)
        self.node: list[np.ndarray] = []  # by decision: of each deciding gram
        self.first: list[np.ndarray] = []  # by decision: a gram (index) of each node
        self.n0: list[np.ndarray] = []
        self.n1: list[np.ndarray] = []
        for j in range(9):
            some = np.flatnonzero(_decided(symbol, j))
            code = where[some] * 512 + _heap(symbol[some], j)
            _, first, node = np.unique(code, return_index=True, return_inverse=True)
            bit = (symbol[some] >> (8 - j)) & 1
            full = np.full(len(keys), -1, np.int64)
            full[some] = node
            self.node.append(full)
            self.first.append(some[first])
            self.n0.append(np.bincount(node, n[some] * (1 - bit), len(first)))
            self.n1.append(np.bincount(node, n[some] * bit, len(first)))


def _subtrees(keys: np.ndarray, n: np.ndarray, top: int) -> tuple[list[_Level], list[list[np.ndarray]], list[list[np.ndarray]]]:
    """Levels from ``top`` to DEPTH, and by level and decision the log weighted probability and the node's own weight."""
    levels = [_Level(keys, n, d) for d in range(top, DEPTH + 1)]
    log_w: list[list[np.ndarray]] = [[] for _ in levels]
    own: list[list[np.ndarray]] = [[] for _ in levels]
    for at in range(len(levels) - 1, -1, -1):
        for j in range(9):
            kt = _log_kt(levels[at].n0[j], levels[at].n1[j])
            if at == len(levels) - 1:
                log_w[at].append(kt)
                own[at].append(np.ones(len(kt)))
                continue
            parent = levels[at].node[j][levels[at + 1].first[j]]
            deeper = np.bincount(parent, log_w[at + 1][j], len(kt))
            both = np.logaddexp(kt, deeper) + math.log(0.5)
            log_w[at].append(both)
            own[at].append(np.exp(kt + math.log(0.5) - both))
    return levels, log_w, own


def _load(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    ks, ns = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for b in batches:
        ks.append(b.column(0).to_numpy(zero_copy_only=False))
        ns.append(b.column(1).to_numpy(zero_copy_only=False))
    k, n = np.concatenate(ks).astype(np.uint64), np.concatenate(ns)
    order = np.argsort(k)
    return k[order], n[order]


def gram_scores(counted: DataFrame) -> DataFrame:
    """(k1, score): log10 probability of each gram's symbol after its context. ``counted``: k1, n."""
    dealt = counted.repartition(F.shiftright("k1", 9 * (DEPTH - 1)))

    def shallow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n = _load(batches)
        if len(keys):
            levels, log_w, _ = _subtrees(keys, n, 2)
            for j in range(9):
                g = keys[levels[0].first[j]]
                yield pa.RecordBatch.from_pydict({
                    "x": (g >> np.uint64(9 * DEPTH)).astype(np.int64),
                    "heap": _heap((g & np.uint64(511)).astype(np.int64), j),
                    "n0": levels[0].n0[j].astype(np.int64),
                    "n1": levels[0].n1[j].astype(np.int64),
                    "w": log_w[0][j],
                })

    # at most 257 x 256 rows: the decisions after one symbol
    rows = dealt.mapInArrow(shallow, "x long, heap long, n0 long, n1 long, w double").groupBy("x", "heap").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("w").alias("w")).toArrow()
    x, heap, n0, n1, w = (rows.column(i).to_numpy() for i in range(5))
    kt1 = _log_kt(n0, n1)
    w1 = np.logaddexp(kt1, w) + math.log(0.5)
    #: by symbol before (or, in the last row, none) and decision: the weight of the node, its chance of a one, whether it has counts
    weight, one, known = np.zeros((258, 512)), np.full((258, 512), 0.5), np.zeros((258, 512), bool)
    weight[x, heap], one[x, heap], known[x, heap] = np.exp(kt1 + math.log(0.5) - w1), (n1 + 0.5) / (n0 + n1 + 1), n0 + n1 > 0
    t0, t1, tw = (np.bincount(heap, v, 512) for v in (n0, n1, w1))
    kt0 = _log_kt(t0, t1)
    weight[257], one[257], known[257] = np.exp(kt0 - np.logaddexp(kt0, tw)), (t1 + 0.5) / (t0 + t1 + 1), t0 + t1 > 0

    def deep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n = _load(batches)
        if not len(keys):
            return
        levels, _, own = _subtrees(keys, n, 2)
        symbol, before = (keys & np.uint64(511)).astype(np.int64), (keys >> np.uint64(9 * DEPTH)).astype(np.int64)
        total = np.zeros(len(keys))
        for j in range(9):
            some = np.flatnonzero(_decided(symbol, j))
            h = _heap(symbol[some], j)
            path = [(weight[257, h], one[257, h], known[257, h]), (weight[before[some], h], one[before[some], h], known[before[some], h])]
            for level, o in zip(levels, own):
                at = level.node[j][some]
                c0, c1 = level.n0[j][at], level.n1[j][at]
                path.append((o[j][at], (c1 + 0.5) / (c0 + c1 + 1), c0 + c1 > 0))
            chance = path[-1][1]
            for d in range(len(path) - 2, -1, -1):
                wt, p, _ = path[d]
                deeper = np.where(path[d + 1][2], chance, p)
                chance = wt * p + (1 - wt) * deeper
            bit = (symbol[some] >> (8 - j)) & 1
            total[some] += np.log10(np.where(bit == 1, chance, 1 - chance))
        yield pa.RecordBatch.from_pydict({"k1": keys.astype(np.int64), "score": total})

    return dealt.mapInArrow(deep, "k1 long, score double")


# ------------------------------------------------------------------ scoring


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of keys in a sorted table, and which are there."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def block_scores(texts: list[bytes], trains: list[bool], told: dict[str, np.ndarray]):
    """For each text: tokens, known tokens, sum of log10(c + 0.1), log10 probability under the model; and the number
    of training words that are this block's to count.

    ``told`` has kind, k1, k2, value and lead for the block's items: counts of words that other blocks hold too,
    and the scores of grams. A word it lacks is in this block alone.
    """
    own: Counter[bytes] = Counter()
    every: set[bytes] = set()
    for t, train in zip(texts, trains):
        if train:
            own.update(t.split())
        else:
            every.update(t.split())
    ws = [*own, *(every - own.keys())]
    counts = np.array([own[w] for w in ws], np.float64)
    is_word = told["kind"] == WORD
    k1, k2, value, lead = (told[c][is_word] for c in ("k1", "k2", "value", "lead"))
    order = np.argsort(k1, kind="stable")
    k1, k2, value, lead = k1[order], k2[order], value[order], lead[order]
    d = word_digests(ws)
    at, found = _find(k1, d[:, 0])
    here = np.zeros(len(ws), bool)
    for shift in range(4):  # equal first halves of digests, of which there are hardly any
        there = np.minimum(at + shift, max(0, len(k1) - 1))
        hit = np.flatnonzero(found)
        hit = hit[(k1[there[hit]] == d[hit, 0]) & (k2[there[hit]] == d[hit, 1])]
        counts[hit] = value[there[hit]]
        here[hit] = True
    end = np.flatnonzero((k1 == END_WORD[0]) & (k2 == END_WORD[1]))
    mine = int((~here & (counts > 0)).sum()) + int(lead.sum()) + (not len(end) and any(trains))
    with np.errstate(divide="ignore"):
        logs = np.log10(counts + 0.1)
    logs[counts == 0] = -1.0
    of = dict(zip(ws, logs.tolist()))
    end_count = float(value[end[0]]) if len(end) else float(sum(trains))
    end_log = math.log10(end_count + 0.1) if end_count else -1.0
    del ws, own, every, d, counts, logs, k1, k2, value

    k1, value = told["k1"], told["value"]
    order = np.argsort(k1[~is_word])
    table, scores = k1[~is_word][order].astype(np.uint64), value[~is_word][order]
    out = []
    for a, b in _steps(texts):
        key, doc = grams(texts[a:b])
        both = np.sort(key << np.uint64(_DOC_BITS) | doc.astype(np.uint64))
        key, doc = both >> np.uint64(_DOC_BITS), (both & np.uint64((1 << _DOC_BITS) - 1)).astype(np.int64)
        change = np.concatenate(([True], key[1:] != key[:-1]))
        at, found = _find(table, key[change])
        if not found.all():
            raise ValueError("a gram of the block is not in the table")
        sums = np.bincount(doc, scores[at][np.cumsum(change) - 1], b - a)
        for t, score in zip(texts[a:b], sums.tolist()):
            ls = [of[w] for w in t.split()]
            known = len(ls) - ls.count(-1.0) + (end_count > 0)
            out.append((len(ls) + 1, known, math.fsum(ls) + end_log, score))
    return out, mine


def score(docs: DataFrame, train_col: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, train, n_tokens, n_known, train_tokens, base_score, score) for each row; trained on rows where ``train_col`` holds."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(F.col(train_col), F.lit(False)).alias("train"))
    n_rows, size = rows.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    blocks = max(1, math.ceil((size or 0) / BLOCK), math.ceil(n_rows / 100_000), min(BUSY, math.ceil((size or 0) / (BLOCK // 8))))

    counted = cut(count_grams(rows, "text", "train"))
    scored_grams = cut(gram_scores(counted))

    dealt = rows.withColumn("block", partition_key(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)))).repartition(blocks, "block")

    def items(t: pa.Table) -> pa.Table:
        texts = [lowered(x.as_py() or "") for x in t.column("text")]
        found = block_items(texts, t.column("train").to_pylist())
        del texts
        out = pa.table({"block": np.full(len(found["n"]), t.column("block")[0].as_py(), np.int32), **found})
        release()
        return out

    # words of all blocks and the table of grams meet by key: what a block doesn't know goes back to it
    asked = dealt.groupBy("block").applyInArrow(items, "block int, kind int, k1 long, k2 long, n long").withColumn("score", F.lit(None).cast("double"))
    table = scored_grams.select(F.lit(None).cast("int").alias("block"), F.lit(GRAM).alias("kind"), "k1", F.lit(0).cast("long").alias("k2"), F.lit(0).cast("long").alias("n"), "score")
    key = Window.partitionBy("kind", "k1", "k2")
    met = asked.unionByName(table).select(
        "block", "kind", "k1", "k2", "n",
        F.when(F.col("kind") == GRAM, F.max("score").over(key)).otherwise(F.sum("n").over(key).cast("double")).alias("value"),
        (F.col("block") == F.min(F.when(F.col("n") > 0, F.col("block"))).over(key)).alias("lead"),
    )
    told = met.where(f"block IS NOT NULL AND (kind = {GRAM} OR value > n)").select("block", "kind", "k1", "k2", "value", F.coalesce("lead", F.lit(False)).alias("lead"))

    id_type = rows.schema["id"].dataType.simpleString()

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        texts = [lowered(x.as_py() or "") for x in left.column("text")]
        trains = left.column("train").to_pylist()
        arrays = {c: right.column(c).to_numpy() for c in ("kind", "k1", "k2", "value", "lead")}
        out, mine = block_scores(texts, trains, arrays) if texts else ([], 0)
        cols = [pa.array([r[i] for r in out], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.float64(), pa.float64()))]
        cols.append(pa.array([mine] + [0] * (len(out) - 1) if out else [], pa.int64()))
        del texts, arrays, out
        release()
        return pa.Table.from_arrays([left.column("id").combine_chunks(), left.column("train").combine_chunks(), *cols], names=["id", "train", "n_tokens", "n_known", "known_log", "score", "new_words"])

    made = cut(
        dealt.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
            scored, f"id {id_type}, train boolean, n_tokens long, n_known long, known_log double, score double, new_words long"
        )
    )
    n_all, n_distinct = made.agg(F.coalesce(F.sum(F.when(F.col("train"), F.col("n_tokens"))), F.lit(0)), F.coalesce(F.sum("new_words"), F.lit(0))).first()
    unit = math.log10(n_all + 0.1 * (n_distinct + 1))
    return made.select(
        F.col("id").alias(id_col), "train", "n_tokens", "n_known", F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("known_log") - F.col("n_tokens") * F.lit(unit)).alias("base_score"), "score",
    )
