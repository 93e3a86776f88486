"""Toxicity by a subsequence string-kernel support vector machine with Nystroem landmarks.

Kernel: the gap-weighted subsequence kernel of orders 3 and 4 (Lodhi et al., 2002) between words, where a common
subsequence counts by decay to the power of its spans, up to ``SPAN`` characters, normalised to 1 for equal
words without repeated subsequences. Characters put between the letters of an insult, or letters doubled, cost some decay only.

Training looks at sentences of a bounded sample of labelled documents: units (words, beginnings of words, and
runs of four and five letters) that stand in toxic documents beyond chance give the positive words, which get gapped and
padded variants; words of clean documents, and again those that score highest, are the negative ones. The
kernel is mapped by the Nystroem method onto landmark words; a linear machine with squared hinge loss is
fitted there. As each landmark is a sum of subsequence features, machine and landmarks fold into one table of
weights a subsequence, about 1.3 million numbers: that table is all that travels.

A document's margin is that of its highest word, of all its words, whatever their number; a sigmoid with
Platt's slope, which is at ``THRESHOLD`` where the sample's documents are parted best, makes it a score. Copies of a word are scored once a task.

What the words of a toxic document don't tell may lie in several of them together: of the toxic documents of the sample
that score below ``THRESHOLD`` by their words, pairs of words in order, with up to ``GAP`` - 1 others between them, are
counted against all clean ones; pairs beyond chance are kept, and a text that holds one scores by the share of
toxic documents among the pair's, if that is more than its words give.

Defined cases: a null or empty text has the margin of no word and a score near 0; repeated rows are scored
each for itself; rows of one id train as one, with the least of their texts; rows without an id are scored but don't train;
without labelled training rows of both kinds every score is 0.5; words that tie are taken by name; texts of any length
are scored whole; an empty table gives an empty result; further columns don't matter. Labels are read for training only.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut

#: Bounds of the training sample, in documents of either label.
TOXIC_ROWS, CLEAN_ROWS = 2000, 6000
SPAN, DECAY = 6, 0.7
LANDMARKS = 500
#: Characters of a window over a longer word, and its step.
WINDOW, STEP = 16, 8
REMEMBERED = 200_000
THRESHOLD = 0.7
#: Bounds of what is trained on of the sample's words: positive ones, the units they share, those with variants, clean
#: ones to begin with, and clean ones added a round because they score highest.
POSITIVES, STEMS, VARIED, NEGATIVES, HARD = 2500, 150, 600, 6000, 2000
#: Words from the first to the second of a pair, at most, and least toxic documents that a pair is kept for.
GAP, LEAST = 4, 8

_EDGE = re.compile(r"^[^\w@$]+|\W+$")
#: Characters that stand for letters inside a word (fixed values).
_STANDS_FOR = str.maketrans("0134578@$!", "oieastbasi")
_NO_LETTER = re.compile(r"[\W\d_]+")

#: Places of a subsequence's characters after its first, and its weight: three within five characters, four within six.
_TRIPLES = [(i, j, DECAY ** (j + 1)) for j in range(2, SPAN - 1) for i in range(1, j)]
_QUADS = [(i, j, k, DECAY ** (k + 1)) for k in range(3, SPAN) for j in range(2, k) for i in range(1, j)]
#: Numbers of subsequences: 2**18 for three characters, then a hash for four.
_THREE, _FOUR = 1 << 18, 1 << 20
FEATURES = _THREE + _FOUR


def tokens(text: str) -> list[str]:
    """Words of a text in lower case, without what is no letter; runs of single letters are put together too."""
    out: list[str] = []
    letters: list[str] = []
    for raw in text.lower().split():
        if raw.isalpha():
            w = raw
        else:
            w = _EDGE.sub("", raw)
            if not w.isalpha():
                if any(map(str.isalpha, w)):
                    w = _NO_LETTER.sub("", w.translate(_STANDS_FOR))
                else:
                    w = ""
        if len(w) == 1:
            letters.append(w)
            continue
        if letters:
            if len(letters) > 2:
                out.append("".join(letters))
            letters = []
        if len(w) > 2:
            out.append(w)
    if len(letters) > 2:
        out.append("".join(letters))
    return out


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Six-bit character codes of windows over the words and their ends (0), -1 beyond, and the word of each window."""
    parts, owner = [], []
    for i, w in enumerate(words):
        w = f"^{w}^"
        for at in range(0, max(1, len(w) - WINDOW + STEP), STEP) if len(w) > WINDOW else (0,):
            parts.append(w[at : at + WINDOW])
            owner.append(i)
    flat = np.frombuffer("".join(p.ljust(WINDOW, "\0") for p in parts).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, WINDOW).astype(np.int64)
    ascii_letter = (flat >= 97) & (flat < 123)
    code = np.where(ascii_letter, flat - 96, 27 + flat % 37)
    code[flat == ord("^")] = 0
    code[flat == 0] = -1
    return code, np.array(owner, np.int64)


def _features(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Subsequence numbers of each window (FEATURES where there is none), and the weight of each column."""
    n = code.shape[1]
    code = code.astype(np.int32)
    pair = code << 6
    cols, weights = [], []
    for i, j, w in _TRIPLES:
        m = n - j
        f = ((pair[:, :m] | code[:, i : m + i]) << 6) | code[:, j:]
        cols.append(np.where(code[:, j:] < 0, FEATURES, f))
        weights += [w] * m
    for i, j, k, w in _QUADS:
        m = n - k
        f = ((((pair[:, :m] | code[:, i : m + i]) << 6) | code[:, j : m + j]) << 6) | code[:, k:]
        f = _THREE + (((f.astype(np.uint32) * np.uint32(0x9E3779B1)) >> np.uint32(12)).astype(np.int32))
        cols.append(np.where(code[:, k:] < 0, FEATURES, f))
        weights += [w] * m
    return np.concatenate(cols, 1), np.array(weights)


def _norms(f: np.ndarray, w: np.ndarray) -> np.ndarray:
    """What a window's features are divided by: the length they have if no subsequence repeats, so by the window's size alone."""
    return np.sqrt(np.maximum(((f < FEATURES) * (w * w)).sum(1), 1e-24))


def _sparse(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Normalised feature vectors of windows: row, feature, value (features of a row summed up), and the word of each row."""
    code, owner = _codes(words)
    f, w = _features(code)
    value = np.broadcast_to(w, f.shape) / _norms(f, w)[:, None]
    rows = np.repeat(np.arange(len(f)), f.shape[1])
    some = f.ravel() < FEATURES
    key, inverse = np.unique(rows[some] << 21 | f.ravel()[some], return_inverse=True)
    return key >> 21, key & ((1 << 21) - 1), np.bincount(inverse, value.ravel()[some], len(key)), owner


def kernel(a: list[str], b: list[str]) -> np.ndarray:
    """Normalised kernel between words; of a word longer than a window, its best window."""
    ra, fa, va, oa = _sparse(a)
    rb, fb, vb, ob = _sparse(b)
    used, cb = np.unique(fb, return_inverse=True)
    dense = np.zeros((len(used), int(rb.max(initial=-1)) + 1 if len(rb) else len(ob)))
    np.add.at(dense, (cb, rb), vb)
    at = np.minimum(np.searchsorted(used, fa), max(0, len(used) - 1))
    hit = used[at] == fa if len(used) else np.zeros(len(fa), bool)
    out = np.zeros((len(oa), dense.shape[1]))
    for lo in range(0, int(hit.sum()), 8192):
        part = np.flatnonzero(hit)[lo : lo + 8192]
        np.add.at(out, ra[part], dense[at[part]] * va[part, None])
    best = np.zeros((len(a), len(b)))
    first = np.zeros((len(a), out.shape[1]))
    np.maximum.at(first, oa, out)
    np.maximum.at(best.T, ob[: out.shape[1]], first.T)
    return best


class WordMachine:
    """Margins of words: weight of each subsequence, offset."""

    def __init__(self, weights: np.ndarray, offset: float):
        self.weights, self.offset = weights.astype(np.float32), float(offset)

    def margins(self, words: list[str]) -> np.ndarray:
        out = np.full(len(words), -np.inf)
        weights = np.append(self.weights, np.float32(0))
        for lo in range(0, len(words), 4096):
            some = words[lo : lo + 4096]
            code, owner = _codes(some)
            f, w = _features(code)
            dot = (weights[f] * w).sum(1)
            margin = dot / _norms(f, w) + self.offset
            np.maximum.at(out, lo + owner, margin)
        return out


def _fit_linear(x: np.ndarray, y: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Squared hinge loss with a ridge, by Newton's method; the last column of x is one and not penalised much."""
    w = np.zeros(x.shape[1])
    ridge = np.ones(x.shape[1])
    ridge[-1] = 1e-3
    value = lambda v: 0.5 * (ridge * v * v).sum() + (cost * np.maximum(0, 1 - y * (x @ v)) ** 2).sum()
    for _ in range(40):
        m = y * (x @ w)
        a = m < 1
        xa = x[a]
        grad = ridge * w - 2 * xa.T @ (cost[a] * (1 - m[a]) * y[a])
        hess = np.diag(ridge) + 2 * (xa * cost[a][:, None]).T @ xa
        step = np.linalg.solve(hess, grad)
        t, now = 1.0, value(w)
        while t > 1e-4 and value(w - t * step) > now:
            t /= 2
        w = w - t * step
        if np.abs(t * step).max() < 1e-6:
            break
    return w


def _variants(word: str, rng: np.random.Generator) -> list[str]:
    """The word with a letter between others, with one doubled, and between letters of two other words' ends."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    at = int(rng.integers(1, len(word)))
    extra = letters[int(rng.integers(26))]
    gapped = "".join(c + (extra if i < len(word) - 1 and i % 2 else "") for i, c in enumerate(word))
    return [word[:at] + extra + word[at:], word[:at] + word[at - 1] + word[at:], gapped]


def _units(word: str) -> set[str]:
    w = f"^{word}^"
    return {w} | {w[:n] for n in (4, 5, 6, 7)} | {w[i : i + n] for n in (4, 5) for i in range(1, len(w) - n)}


def fit_words(table: list[tuple[str, int, int]], n_toxic: int, n_clean: int, seed: int = 7) -> WordMachine | None:
    """The machine from (word, toxic documents, clean documents) of the sample; none if no unit stands out."""
    rng = np.random.default_rng(seed)
    table = sorted(table)
    # toxic and clean documents of each unit, by the unit's 64-bit digest
    owner, digest = [], []
    for i, (word, _, _) in enumerate(table):
        us = [xxhash.xxh3_64_intdigest(u) for u in _units(word)]
        digest.append(np.array(us, np.uint64))
        owner.append(np.full(len(us), i, np.int32))
    owner, digest = np.concatenate(owner), np.concatenate(digest)
    tox, clean_n = (np.array([x[k] for x in table], np.float64) for k in (1, 2))
    units, unit = np.unique(digest, return_inverse=True)
    del digest
    t, c = np.bincount(unit, tox[owner]), np.bincount(unit, clean_n[owner])
    share = n_toxic / (n_toxic + n_clean)
    q = t / (t + c)
    # beyond chance: the chance of so many toxic documents among the unit's is below one in the number of units
    with np.errstate(divide="ignore", invalid="ignore"):
        kl = np.where(t > 0, q * np.log(q / share), 0) + np.where(c > 0, (1 - q) * np.log((1 - q) / (1 - share)), 0)
    strong = (t >= 3) & (q >= max(0.9, 1 - share / 2)) & ((t + c) * kl > math.log(max(10, len(units))))
    telling = np.zeros(len(table), bool)
    telling[owner[strong[unit]]] = True
    strong_digests = set(units[strong].tolist())
    del owner, unit, units
    positive = [w for (w, a, b), yes in zip(table, telling) if yes and a > 0 and b <= a / 10]
    if not positive:
        return None
    df = {w: t + c for w, t, c in table}
    positive.sort(key=lambda w: (-df[w], w))
    taken = set(positive)
    clean = [w for w, t, c in table if c > 0 and w not in taken]
    clean_df = np.array([df[w] for w in clean], float)
    positive = positive[:POSITIVES]
    stems = sorted({u.strip("^") for w in positive for u in _units(w) if u[-1] != "^" and xxhash.xxh3_64_intdigest(u) in strong_digests})[:STEMS]
    landmarks = positive[: LANDMARKS // 2]
    common = [clean[i] for i in np.argsort(-clean_df, kind="stable")[: LANDMARKS // 4]]
    rare = [clean[i] for i in sorted(rng.permutation(len(clean))[: LANDMARKS // 4].tolist())]
    landmarks = list(dict.fromkeys([*landmarks, *stems, *common, *rare]))
    kmm = kernel(landmarks, landmarks)
    kmm = (kmm + kmm.T) / 2
    vals, vecs = np.linalg.eigh(kmm)
    good = vals > 1e-6 * vals.max()
    root = vecs[:, good] / np.sqrt(vals[good])
    made = [(v, w) for w in positive[:VARIED] for v in _variants(w, rng) if v not in df]
    varied, origin = [v for v, _ in made], [w for _, w in made]
    negative = list(dict.fromkeys(common + [clean[i] for i in sorted(rng.permutation(len(clean))[:NEGATIVES].tolist())]))
    machine = None
    lm_row, lm_feature, lm_value, lm_owner = _sparse(landmarks)
    for _ in range(6):
        xs = [*positive, *varied, *negative]
        y = np.array([1.0] * (len(positive) + len(varied)) + [-1.0] * len(negative))
        x = np.concatenate((kernel(xs, landmarks) @ root, np.ones((len(xs), 1))), 1)
        n_pos = len(positive) + len(varied)
        cost = np.full(len(xs), 10.0)
        # a word counts by the documents it decides: common insults as much as the many clean words near them
        cost[: len(positive)] = 12.0 * np.sqrt([df[w] for w in positive])
        cost[len(positive) : n_pos] = 2.0 * np.sqrt([df[v] for v in origin])
        w = _fit_linear(x, y, cost)
        alpha = root @ w[:-1]
        weights = np.bincount(lm_feature, lm_value * alpha[lm_owner[lm_row]], FEATURES)
        machine = WordMachine(weights, w[-1])
        m = machine.margins(clean)
        known = set(negative)
        hard = [clean[i] for i in np.argsort(-m, kind="stable")[:HARD] if clean[i] not in known and m[i] > -0.5]
        if not hard:
            break
        negative += hard
    return machine


def _platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of the sigmoid: the slope by Newton's method with Platt's smoothed targets, the intercept
    so that THRESHOLD lies where the documents are parted best."""
    pos, neg = (y > 0).sum(), (y <= 0).sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    weight = np.where(y > 0, 0.5 / pos, 0.5 / neg) * len(y)
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-(a * margin + b)))
        g = np.array([(weight * (p - target) * margin).sum() + 1e-3 * a, (weight * (p - target)).sum()])
        v = weight * p * (1 - p) + 1e-9
        h = np.array([[(v * margin**2).sum() + 1e-3, (v * margin).sum()], [(v * margin).sum(), v.sum()]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-7:
            break
    a = max(a, 1e-3)
    return a, math.log(THRESHOLD / (1 - THRESHOLD)) - a * _best_cut(margin, y)


def _best_cut(margin: np.ndarray, y: np.ndarray) -> float:
    """The margin that parts the labels best: most of the toxic above it, a clean document weighing as three; the middle of the widest gap among equals."""
    order = np.argsort(margin, kind="stable")
    m, pos = margin[order], y[order] > 0
    above = pos.sum() - np.cumsum(pos)  # toxic documents above each place
    clean = (~pos).sum() - np.cumsum(~pos)
    value = above / max(1, pos.sum()) - 3 * clean / max(1, (~pos).sum())
    gap = np.append(m[1:] - m[:-1], 0.0)
    value = np.where(gap > 0, value, -np.inf)
    best = np.flatnonzero(value == value.max())
    at = best[gap[best].argmax()]
    return float((m[at] + m[at + 1]) / 2) if at + 1 < len(m) else float(m[at])


def word_hashes(ws: list[str]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, ws), np.uint64, len(ws))


def pair_keys(ws: list[str]) -> np.ndarray:
    """The distinct pairs of words in order, at most GAP apart, as numbers."""
    h = word_hashes(ws)
    parts = [(h[:-d] * np.uint64(0x9E3779B97F4A7C15)) ^ (h[d:] + np.uint64(0xC2B2AE3D27D4EB4F)) for d in range(1, GAP + 1) if d < len(h)]
    return np.unique(np.concatenate(parts)).astype(np.int64) if parts else np.zeros(0, np.int64)


class Phrases:
    """Pairs of words that tell toxic texts, with the share of toxic documents among those that hold them."""

    def __init__(self, keys: np.ndarray, shares: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.shares = keys[order], shares[order]

    def score(self, ws: list[str]) -> float:
        k = pair_keys(ws)
        at = np.minimum(np.searchsorted(self.keys, k), len(self.keys) - 1)
        return float(self.shares[at[self.keys[at] == k]].max(initial=0.0))


class ToxicityModel:
    """Scores texts: the words' machine, slope and intercept, and telling pairs of words."""

    def __init__(self, machine: WordMachine | None, slope: float = 1.0, intercept: float = 0.0, phrases: Phrases | None = None):
        self.machine, self.slope, self.intercept, self.phrases = machine, slope, intercept, phrases

    def scorer(self):
        """A function from texts to scores that remembers words."""
        known: dict[str, float] = {}
        machine, phrases = self.machine, self.phrases

        def scores(texts: list[str]) -> list[float]:
            if not machine and not phrases:
                return [0.5] * len(texts)
            ws = [tokens(t) for t in texts]
            out = [0.0] * len(texts)
            if machine:
                if len(known) > REMEMBERED:
                    known.clear()
                new = list({w for x in ws for w in x} - known.keys())
                if new:
                    known.update(zip(new, machine.margins(new).tolist()))
                out = self.scores([max(map(known.__getitem__, x), default=-5.0) for x in ws])
            return [max(s, phrases.score(x)) for s, x in zip(out, ws)] if phrases else out

        return scores

    def scores(self, margins: list[float]) -> list[float]:
        z = np.clip(self.slope * np.array(margins, float) + self.intercept, -500, 500)
        return (1 / (1 + np.exp(-z))).tolist()


def _margins(docs: DataFrame, model: ToxicityModel, keep: list[str], text_col: str) -> DataFrame:
    src = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, text_col])])
    schema = src.select(*[F.col(f"`{c}`") for c in keep]).schema.add("score", T.DoubleType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = model.scorer()
        for batch in batches:
            texts, out = batch.column(batch.schema.get_field_index(text_col)), []
            for lo in range(0, batch.num_rows, 256):
                out += scores([t.as_py() or "" for t in texts[lo : lo + 256]])
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in keep), pa.array(out, pa.float64())], names=schema.names)

    return src.mapInArrow(run, schema)


def _pairs(sample: DataFrame, model: ToxicityModel, toxic: bool, only: np.ndarray | None = None) -> DataFrame:
    """(key, n): in how many documents of a label pairs stand; of the toxic ones, those that the model leaves below THRESHOLD."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = model.scorer() if model.machine else None
        for batch in batches:
            for text in batch.column(0):
                text = text.as_py() or ""
                if toxic and scores and scores([text])[0] >= THRESHOLD:
                    continue
                k = pair_keys(tokens(text))
                yield pa.RecordBatch.from_pydict({"key": k if only is None else k[np.isin(k, only)]})

    found = sample.where(F.col("toxic") == toxic).select("text").mapInArrow(run, "key long")
    return found.groupBy("key").agg(F.count("*").alias("n"))


def fit_phrases(sample: DataFrame, model: ToxicityModel, n_left: int, n_clean: int) -> Phrases | None:
    """Pairs of words beyond chance in the toxic documents of the sample (text, toxic) that the words don't tell."""
    if n_left < LEAST or not n_clean:  # no pair can stand in enough of them
        return None
    held = _pairs(sample, model, True)
    rows = held.where(F.col("n") >= LEAST).toArrow()  # a bounded sample's pairs
    if not rows.num_rows:
        return None
    keys, t = rows.column("key").to_numpy(), rows.column("n").to_numpy().astype(float)
    other = _pairs(sample, model, False, keys).toArrow()
    clean = dict(zip(other.column("key").to_pylist(), other.column("n").to_pylist()))
    c = np.array([clean.get(k, 0) for k in keys.tolist()], float)
    share, q = n_left / (n_left + n_clean), t / (t + c)
    with np.errstate(divide="ignore", invalid="ignore"):
        kl = q * np.log(q / share) + np.where(c > 0, (1 - q) * np.log((1 - q) / (1 - share)), 0)
    # twice the number of pairs in the exponent: a pair of common words that is toxic by chance would be in many clean texts
    strong = (q >= 0.9) & ((t + c) * kl > 2 * math.log(max(10, held.count())))
    return Phrases(keys[strong], ((t + 1) / (t + c + 2))[strong]) if strong.any() else None


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> ToxicityModel:
    """The model from labelled documents. At most TOXIC_ROWS + CLEAN_ROWS of them are looked at, chosen by a hash."""
    told = labels.where(F.col(label_col).isNotNull()).select(F.col(id_col).alias("id"), (F.col(label_col) == 1).alias("toxic"))
    picked = None
    for toxic, rows in ((True, TOXIC_ROWS), (False, CLEAN_ROWS)):
        some = told.where(F.col("toxic") == toxic).orderBy(F.xxhash64("id"), "id").limit(rows)
        picked = some if picked is None else picked.unionByName(some)
    # a row an id, whatever documents repeats; read by every pass below
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(picked), "id")
    sample = cut(named.groupBy("id", "toxic").agg(F.min("text").alias("text")).select("text", "toxic"))

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                ws = list(set(tokens(text.as_py() or "")))
                n = len(ws)
                yield pa.RecordBatch.from_pydict({"word": pa.array([*ws, ""], pa.string()), "toxic": pa.array([int(toxic)] * (n + 1), pa.int64()), "clean": pa.array([int(not toxic)] * (n + 1), pa.int64())})

    found = sample.select("text", "toxic").mapInArrow(distinct, "word string, toxic long, clean long").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches))
        table = list(zip(*(rows.column(i).to_pylist() for i in range(3)))) if rows.num_rows else []
        n_toxic, n_clean = next(((t, c) for w, t, c in table if w == ""), (0, 0))
        machine = fit_words([x for x in table if x[0]], n_toxic, n_clean) if n_toxic and n_clean else None
        if machine:
            yield pa.RecordBatch.from_pydict({"weights": [machine.weights.tobytes()], "shift": [machine.offset]})

    # the words of a bounded sample: one task, on an executor
    fit_row = found.coalesce(1).mapInArrow(fitted, "weights binary, shift double").collect()
    model = ToxicityModel(None)
    if fit_row:
        machine = WordMachine(np.frombuffer(fit_row[0]["weights"], np.float32), fit_row[0]["shift"])
        rows = _margins(sample, ToxicityModel(machine), ["toxic"], "text").toArrow()
        p = np.clip(np.array(rows.column("score")), 1e-12, 1 - 1e-12)
        y = np.array(rows.column("toxic").to_pylist(), float)
        margins = np.log(p / (1 - p))
        model = ToxicityModel(machine, *_platt(margins, y))
        low = np.array(model.scores(margins)) < THRESHOLD
        n_left, n_clean = int((low & (y > 0)).sum()), int((y <= 0).sum())
    else:
        n_left, n_clean = (int(x or 0) for x in sample.agg(F.count_if("toxic"), F.count_if(~F.col("toxic"))).first())
    model.phrases = fit_phrases(sample, model, n_left, n_clean)
    return model


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted) for each row."""
    out = _margins(docs, model, [id_col], text_col)
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
