"""Suffix-array deduplication of long repeated byte strings, by deep-shallow sorting.

Every byte covered by a ``length``-byte string that also starts earlier (in an earlier document, or earlier
in the same one) is removed. Equal strings share the k-gram that is least by hash in them, at the same
place, so windows fall into runs, one for each such k-gram (about one in 35 bytes), and only runs are moved:

1. In blocks of text, runs are found; of equal runs in a block all but the first are settled at once. A
   k-gram with different surroundings in one block gets a single token, its runs go on to step 3.
2. Runs meet by k-gram. A run whose digest of all its bytes was seen earlier is settled, windows and all;
   k-grams that occur once are done. Others of differing surroundings go on.
3. What is left is parted in windows that lean to the left and to the right of the k-gram. All windows of a
   part hold the same 65 bytes or more; parts whose bytes there occur once are done.
4. The windows of the other parts are suffix-sorted in blocks, deep-shallow: a multikey quicksort on eight-byte
   digits to ``SHALLOW`` bytes, then blind tries order each group with a longer common prefix and tell how far
   it goes. Windows with an equal one before them in the block are settled; of the others, a 128-bit digest
   meets its equals from other blocks.
5. Each document meets its settled windows and loses the bytes they cover.

No step gathers the occurrences of a string: a block sends one row for each k-gram or window, so a passage
held by a third of all documents meets in as many rows as there are blocks of text.

Defined cases: null texts stay null and empty ones empty; texts shorter than ``length`` stay; rows with one
id are one document, what they hold at the same place is there once, and all of them lose the same places;
rows without an id stay as they are; an empty table gives an empty result; further columns don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import cut, release

LENGTH = 100
GRAM = 32
#: Depth of the multikey quicksort, in bytes.
SHALLOW = 24
#: Bytes of text that a block of step 1 and its parts hold, and windows that a block of step 3 holds.
BLOCK, PART = 16 << 20, 2 << 20
WINDOWS = 150_000
_POSITION = 22  # bits for a place in a part


# ------------------------------------------------------------------ windows and runs


def _eights(b: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number."""
    two = b[:-1].astype(np.uint64) | b[1:].astype(np.uint64) << np.uint64(8)
    four = two[:-2] | two[2:] << np.uint64(16)
    return four[:-4] | four[4:] << np.uint64(32)


def gram_hashes(b: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each place on."""
    e = _eights(b)
    n = len(b) - GRAM + 1
    h = np.zeros(n, np.uint64)
    for i in range(0, GRAM, 8):
        h += e[i : i + n]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def runs(b: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(text, first window, number of windows, hash of the k-gram, its place after the first window) of the runs of windows that share their least k-gram.

    ``b`` holds texts of ``length`` bytes or more one after another, from ``starts`` on; windows are counted from a text's start.
    """
    h = gram_hashes(b)
    place = np.arange(len(h), dtype=np.uint64)
    low = np.uint64((1 << _POSITION) - 1)
    least = (h & ~low) | place
    width, have = length - GRAM + 1, 1
    while 2 * have <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < width:
        least = np.minimum(least[: len(least) - (width - have)], least[width - have :])
    at = (least & low).astype(np.int64)
    # windows that lie in one text
    ends = np.append(starts[1:], len(b))
    inside = np.zeros(len(at) + 1, np.int8)
    np.add.at(inside, starts, 1)
    np.add.at(inside, np.minimum(ends - length + 1, len(at)), -1)
    inside = np.cumsum(inside[:-1], dtype=np.int8) > 0
    new = np.concatenate(([True], at[1:] != at[:-1])) | np.concatenate(([True], ~inside[:-1]))
    new[starts[starts < len(new)]] = True
    first = np.flatnonzero(new & inside)
    stop = np.flatnonzero(np.concatenate((new, [True])) | ~np.concatenate((inside, [False])))
    n = stop[np.searchsorted(stop, first, "right")] - first
    text = np.searchsorted(starts, first, "right") - 1
    return text, first, n, h[at[first]], at[first] - first


# ------------------------------------------------------------------ deep-shallow sorting


class BlindTrie:
    """Strings of one length by the bytes at which they branch; a leaf holds the numbers of equal strings.

    A node is [place, {byte: child}]; a leaf is [-1, string, numbers]. Searching compares only bytes at
    branching places; one whole comparison, with the leaf found, tells the first difference.
    """

    def __init__(self) -> None:
        self.root: list | None = None

    def add(self, s: bytes, number: int) -> None:
        if self.root is None:
            self.root = [-1, s, [number]]
            return
        node = self.root
        while node[0] >= 0:
            child = node[1].get(s[node[0]])
            node = child if child is not None else next(iter(node[1].values()))
        if node[1] == s:
            node[2].append(number)
            return
        t = node[1]
        differ = int.from_bytes(s, "big") ^ int.from_bytes(t, "big")
        at = len(s) - (differ.bit_length() + 7) // 8
        leaf = [-1, s, [number]]
        parent, key, node = None, 0, self.root
        while 0 <= node[0] < at:
            parent, key = node, s[node[0]]
            node = node[1][key]
        if node[0] == at:
            node[1][s[at]] = leaf
            return
        branch = [at, {t[at]: node, s[at]: leaf}]
        if parent is None:
            self.root = branch
        else:
            parent[1][key] = branch

    def leaves(self) -> Iterator[list[int]]:
        """Numbers of equal strings, in the order of the strings."""
        stack = [self.root] if self.root else []
        while stack:
            node = stack.pop()
            if node[0] < 0:
                yield node[2]
            else:
                stack += [node[1][k] for k in sorted(node[1], reverse=True)]


def deep_shallow(text: bytes, places: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """The order of the strings text[p : p + length], equal ones by place in ``places``, and, by position in that
    order, whether a string equals the one before it (their common prefix reaches ``length``)."""
    b = np.frombuffer(text, np.uint8)
    n = len(places)
    order = np.arange(n)
    group = np.zeros(n, np.int64)  # by position in order
    for depth in range(0, min(SHALLOW, length - 8 + 1), 8):  # multikey quicksort, a digit at a time for all groups
        rows = b[places[order][:, None] + np.arange(depth, depth + 8)]
        digit = np.ascontiguousarray(rows).view(">u8").ravel()
        to = np.lexsort((digit, group))
        order, digit, group = order[to], digit[to], group[to]
        change = (group[1:] != group[:-1]) | (digit[1:] != digit[:-1])
        group = np.concatenate(([0], np.cumsum(change)))
    equal = np.zeros(n, bool)
    bounds = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1], [True]))) if n else np.zeros(0, np.int64)
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if hi - lo < 2:
            continue
        trie = BlindTrie()
        for number in sorted(order[lo:hi].tolist()):
            p = int(places[number])
            trie.add(text[p : p + length], number)
        at = lo
        for numbers in trie.leaves():
            order[at : at + len(numbers)] = numbers
            equal[at + 1 : at + len(numbers)] = True
            at += len(numbers)
    return order, equal


# ------------------------------------------------------------------ steps

RUN, TOKEN, OPEN, SETTLED = 0, 1, 2, 3


#: Windows that a packed number counts at most.
_MOST = (1 << 22) - 1


def packed(at: np.ndarray, n: np.ndarray, off: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """First window, number of windows, place of the k-gram after the first window, and kind, as one number."""
    return at.astype(np.int64) << 32 | n.astype(np.int64) << 10 | off.astype(np.int64) << 2 | kind.astype(np.int64)

def block_runs(keys: list, texts: list[bytes], length: int) -> dict[str, list | np.ndarray]:
    """Rows of step 1 for a block: h, digest, key, what (kind and windows, packed).

    A text longer than a part is taken in pieces that overlap by length - 1 bytes; which windows lie in a piece
    does not change what is found, only where runs end.
    """
    doc_of, first_of, n_of, hash_of, off_of, digests = [], [], [], [], [], []
    digest = xxhash.xxh3_64_intdigest
    pieces: list[tuple[int, int, bytes]] = []

    def flush() -> None:
        joined = b"".join(p for _, _, p in pieces)
        starts = np.cumsum([0] + [len(p) for _, _, p in pieces])[:-1]
        piece, first, n, h, off = runs(np.frombuffer(joined, np.uint8), starts, length)
        if len(first):
            view = memoryview(joined)
            digests.append(np.array([digest(view[a:z]) for a, z in zip(first.tolist(), (first + n + length - 1).tolist())], np.uint64))
            doc_of.append(np.array([p[0] for p in pieces], np.int64)[piece])
            first_of.append(first - starts[piece] + np.array([p[1] for p in pieces], np.int64)[piece])
            n_of.append(n)
            hash_of.append(h)
            off_of.append(off)
        pieces.clear()

    size = 0
    for i, t in enumerate(texts):
        for at in range(0, max(1, len(t) - length + 1), PART):
            p = t[at : at + PART + length - 1]
            if len(p) >= length:
                if size + len(p) > PART + length:
                    flush()
                    size = 0
                pieces.append((i, at, p))
                size += len(p)
    if pieces:
        flush()
    if not digests:
        return {"h": [], "digest": [], "key": [], "what": []}
    doc, first, n, h, off, d = (np.concatenate(x) for x in (doc_of, first_of, n_of, hash_of, off_of, digests))
    number = {k: i for i, k in enumerate(sorted(set(keys)))}
    rank = np.array([number[k] for k in keys], np.int64)
    order = np.lexsort((first, rank[doc], off, n, d, h))
    doc, first, n, h, off, d = (x[order] for x in (doc, first, n, h, off, d))
    new_h = np.concatenate(([True], h[1:] != h[:-1]))
    same = np.concatenate(([False], (d[1:] == d[:-1]) & (n[1:] == n[:-1]) & (off[1:] == off[:-1])))
    place = np.concatenate(([False], (rank[doc][1:] == rank[doc][:-1]) & (first[1:] == first[:-1])))
    again = ~new_h & same & ~place
    once = np.flatnonzero(~(~new_h & same & place))  # a repeated row's runs stand there once
    doc, first, n, h, off, d, new_h, again = (x[once] for x in (doc, first, n, h, off, d, new_h, again))
    which = np.cumsum(new_h) - 1
    several = (np.bincount(which, ~again) > 1)[which]  # surroundings of the k-gram in this block
    # runs that are settled here, neighbours in a document as one
    gone = np.flatnonzero(again)
    gone = gone[np.lexsort((first[gone], doc[gone]))]
    gd, ga, gz = doc[gone], first[gone], first[gone] + n[gone]
    new = np.concatenate(([True], (gd[1:] != gd[:-1]) | (ga[1:] != gz[:-1]))) if len(gone) else np.zeros(0, bool)
    start = np.flatnonzero(new)
    stop = np.append(start[1:], len(gone)) - 1 if len(gone) else start
    gd, ga, gn = gd[start], ga[start], gz[stop] - ga[start] if len(gone) else ga
    more = [(k, a + lo, min(_MOST, m - lo)) for k, a, m in zip(gd.tolist(), ga.tolist(), gn.tolist()) for lo in range(0, m, _MOST)]
    gd, ga, gn = (np.array([x[i] for x in more], np.int64) for i in range(3))
    kept, token = np.flatnonzero(~again), np.flatnonzero(new_h & several)
    take = np.concatenate((kept, token))
    kind = np.concatenate((np.where(several[kept], OPEN, RUN), np.full(len(token), TOKEN)))
    # what is settled or goes on anyway needs to meet no other run: it is dealt by chance
    spread = np.uint64(xxhash.xxh3_64_intdigest(repr(keys[0]))) if keys else np.uint64(0)
    chance = np.arange(len(take) + len(gd), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + spread
    return {
        "h": np.concatenate((np.where(kind == OPEN, chance[: len(take)], h[take]), chance[len(take) :])).astype(np.int64),
        "digest": np.concatenate((np.where(kind == RUN, d[take], 0).astype(np.int64), np.zeros(len(gd), np.int64))),
        "key": [keys[i] for i in [*doc[take].tolist(), *gd.tolist()]],
        "what": np.concatenate((packed(first[take], n[take], off[take], kind), packed(ga, gn, np.zeros(len(gd), np.int64), np.full(len(gd), SETTLED)))),
    }


def leaning(at: int, n: int, off: int, length: int) -> list[tuple[int, int, int, int]]:
    """The parts of a run: (start and stop of the bytes that all windows of such a part hold, first window, windows).

    A window at distance x before the k-gram leans left if x is at least half the k-gram's places in a window.
    """
    width = length - GRAM + 1
    half = width // 2
    gram = at + off
    out = []
    for low, high in ((half, width - 1), (0, half - 1)):  # distances
        a, z = max(at, gram - high), min(at + n - 1, gram - low)
        if a <= z:
            out.append((gram - low, gram - high + length, a, z - a + 1))
    return out


def block_parts(keys: list, texts: list[bytes], opens: list[list[tuple[int, int, int]]], length: int) -> tuple[list, ...]:
    """Rows of step 3 for a block: (digest of the common bytes, key, first window, windows, kind).

    Parts that share their bytes in the block go on as they are, and a token stands for them.
    """
    digest = xxhash.xxh3_64_intdigest
    rows = [(digest(t[a:z]), key, at, n) for key, t, runs_ in zip(keys, texts, opens) for r in runs_ for a, z, at, n in leaning(*r, length)]
    c = np.array([r[0] for r in rows], np.uint64)
    _, which, count = np.unique(c, return_inverse=True, return_counts=True)
    here = count[which] > 1 if len(rows) else np.zeros(0, bool)
    token = np.unique(c[here])
    chance = np.arange(len(rows), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + (c[0] if len(rows) else np.uint64(0))
    return (
        np.concatenate((np.where(here, chance, c), token)).astype(np.int64),
        [*(r[1] for r in rows), *[None] * len(token)],
        np.array([*(r[2] for r in rows), *[0] * len(token)], np.int64),
        np.array([*(r[3] for r in rows), *[0] * len(token)], np.int32),
        np.concatenate((np.where(here, OPEN, RUN), np.full(len(token), TOKEN))).astype(np.int32),
    )


def block_windows(keys: list, texts: list[bytes], opens: list[list[tuple[int, int]]], length: int):
    """Step 4 for a block: spans of settled windows (key, at, n) and, of each string, its first window here (w1, w2, key, at)."""
    number = {k: i for i, k in enumerate(sorted(set(keys)))}
    order = sorted(range(len(texts)), key=lambda i: keys[i])
    joined, places, owner, base = [], [], [], 0
    for i in order:
        joined.append(texts[i])
        for at, n in sorted(opens[i]):
            places.append(np.arange(base + at, base + at + n))
            owner.append(np.full(n, i))
        base += len(texts[i])
    text = b"".join(joined)
    place, doc = np.concatenate(places), np.concatenate(owner)
    starts = np.zeros(len(texts), np.int64)
    starts[order] = np.cumsum([0] + [len(texts[i]) for i in order])[:-1]
    at = place - starts[doc]
    rank = np.array([number[k] for k in keys], np.int64)[doc]
    by_place = np.lexsort((at, rank))  # equal strings then stand by document and place
    place, doc, at, rank = place[by_place], doc[by_place], at[by_place], rank[by_place]
    once = np.flatnonzero(np.concatenate(([True], (rank[1:] != rank[:-1]) | (at[1:] != at[:-1]))))
    place, doc, at = place[once], doc[once], at[once]
    sa, equal = deep_shallow(text, place, length)
    first = sa[~equal]
    gone = np.sort(sa[equal])  # places ascend within a document's windows: neighbours become one span
    parts = np.split(gone, np.flatnonzero((np.diff(place[gone]) != 1) | (np.diff(doc[gone]) != 0)) + 1) if len(gone) else []
    spans_ = [(keys[int(doc[p[0]])], int(at[p[0]]), len(p)) for p in parts]
    w = np.frombuffer(b"".join(xxhash.xxh3_128_digest(text[p : p + length]) for p in place[first].tolist()), ">i8").astype(np.int64).reshape(-1, 2)
    return spans_, (w[:, 0], w[:, 1], [keys[i] for i in doc[first].tolist()], at[first])


def removed_spans(n_bytes: int, settled: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Maximal spans covered by windows: settled holds (first window, windows)."""
    spans: list[list[int]] = []
    for at, n in sorted(settled):
        stop = min(n_bytes, at + n - 1 + length)
        if spans and at <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], stop)
        else:
            spans.append([at, stop])
    return [(a, z) for a, z in spans]


def _utf8(x) -> bytes:
    return x.as_buffer().to_pybytes() if x.is_valid else b""


def settled_windows(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """docs: id, text. (id, at, n) of windows that an earlier equal string settles, or whole runs of them."""
    kind = docs.schema["id"].dataType
    key_type, name = to_arrow_type(kind), kind.simpleString()

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list = []
        texts: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            rows = block_runs(keys, texts, length)
            keys.clear()
            texts.clear()
            release()
            return pa.RecordBatch.from_arrays([pa.array(rows[c], t) for c, t in (("h", pa.int64()), ("digest", pa.int64()), ("key", key_type), ("what", pa.int64()))], names=["h", "digest", "key", "what"])

        for batch in batches:
            for key, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                b = _utf8(t)
                if len(b) >= length and key is not None:
                    keys.append(key)
                    texts.append(b)
                    size += len(b)
                if size > BLOCK:
                    yield flush()
                    size = 0
        if texts:
            yield flush()

    rows = docs.mapInArrow(found, f"h long, digest long, key {name}, what long")
    kind_of = F.col("what").bitwiseAND(F.lit(3))
    shape = F.col("what").bitwiseAND(F.lit((1 << 32) - 1))  # windows, place of the k-gram and kind
    by = Window.partitionBy("h")
    ranked = by.orderBy("digest", shape, "key", "what")
    run_only = F.when(kind_of == RUN, F.struct("digest", shape))
    judged = rows.select(
        "key", "what",
        ((F.lag(run_only).over(ranked) == run_only) & (F.lag(F.struct("key", "what")).over(ranked) != F.struct("key", "what"))).alias("again"),
        ((F.max(run_only).over(by) != F.min(run_only).over(by)) | (F.max((kind_of == TOKEN).cast("int")).over(by) == 1)).alias("several"),
    )
    settled = (kind_of == SETTLED) | F.coalesce("again", F.lit(False))
    open_ = ~settled & ((kind_of == OPEN) | ((kind_of == RUN) & F.coalesce("several", F.lit(False))))
    state = judged.select(
        F.col("key").alias("id"), F.shiftright("what", 32).alias("at"), F.shiftright("what", 10).bitwiseAND(F.lit(_MOST)).cast("int").alias("n"),
        F.shiftright("what", 2).bitwiseAND(F.lit(255)).cast("int").alias("off"), settled.alias("settled"), open_.alias("open"),
    )
    state = cut(state.where("settled OR open"))
    first = state.where("settled").select("id", "at", "n")
    # the texts are dealt by id once; all three joins with them read the same exchange
    opens = state.where("open").groupBy("id").agg(F.collect_list(F.struct("at", "n", "off")).alias("opens"))

    def parted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list = []
        texts: list[bytes] = []
        held: list[list[tuple[int, int, int]]] = []

        def flush() -> pa.RecordBatch:
            c, key, at, n, kind = block_parts(keys, texts, held, length)
            keys.clear()
            texts.clear()
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c), pa.array(key, key_type), pa.array(at), pa.array(n), pa.array(kind)], names=["c", "key", "at", "n", "kind"])

        size = 0
        for batch in batches:
            for key, t, os in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                if os:
                    keys.append(key)
                    texts.append(_utf8(t))
                    held.append([(o["at"], o["n"], o["off"]) for o in os])
                    size += len(texts[-1])
                if size > BLOCK:
                    yield flush()
                    size = 0
        if texts:
            yield flush()

    common = docs.join(opens.hint("shuffle_hash"), "id", "left").select("id", "text", "opens").mapInArrow(parted, f"c long, key {name}, at long, n int, kind int")
    met = common.withColumn("found", F.count("*").over(Window.partitionBy("c")))
    wanted = met.where(f"kind = {OPEN} OR (kind = {RUN} AND found > 1)").groupBy(F.col("key").alias("id")).agg(F.collect_list(F.struct("at", "n")).alias("opens"))

    def sorted_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list = []
        texts: list[bytes] = []
        held: list[list[tuple[int, int]]] = []
        n = 0

        def flush() -> Iterator[pa.RecordBatch]:
            gone, (w1, w2, key, at) = block_windows(keys, texts, held, length)
            keys.clear()
            texts.clear()
            held.clear()
            none = [None] * len(gone)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*none, *w1.tolist()], pa.int64()), pa.array([*none, *w2.tolist()], pa.int64()),
                    pa.array([*(g[0] for g in gone), *key], key_type),
                    pa.array([*(g[1] for g in gone), *at.tolist()], pa.int64()), pa.array([*(g[2] for g in gone), *[1] * len(at)], pa.int32()),
                ],
                names=["w1", "w2", "key", "at", "n"],
            )

        for batch in batches:
            for key, t, os in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                if not os:
                    continue
                b, mine = _utf8(t), sorted((o["at"], o["n"]) for o in os)
                # a document with very many windows comes in parts, each with the bytes it needs
                while mine:
                    some, m = [], 0
                    while mine and m < WINDOWS:
                        some.append(mine.pop(0))
                        m += some[-1][1]
                    keys.append(key)
                    texts.append(b)
                    held.append(some)
                    n += m
                    if n >= WINDOWS or sum(map(len, texts)) > BLOCK:
                        yield from flush()
                        n = 0
        if texts:
            yield from flush()

    windows = docs.join(wanted.hint("shuffle_hash"), "id", "left").select("id", "text", "opens").mapInArrow(sorted_, f"w1 long, w2 long, key {name}, at long, n int")
    # settled spans of windows have no digest; they are dealt by what they are
    salt = F.when(F.col("w1").isNull(), F.xxhash64("key", "at")).otherwise(F.col("w1"))
    w = Window.partitionBy("salt", "w1", "w2").orderBy("key", "at")
    deep = windows.withColumn("salt", salt).withColumn("r", F.rank().over(w)).where("w1 IS NULL OR r > 1").select(F.col("key").alias("id"), "at", "n")
    return first.unionByName(deep)


def _marks(src: DataFrame, length: int) -> DataFrame:
    return settled_windows(src, length).groupBy("id").agg(F.collect_list(F.struct("at", "n")).alias("__settled"))


def deduplicated(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows with what is left of their texts. A character cut in two by a span goes whole."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    columns = docs.columns
    at, key = columns.index(text_col), F.col(f"c{columns.index(id_col)}")
    # the rows' own columns go by number, so that none can clash with the marks
    numbered = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])
    marks_of = _marks(src, length).hint("shuffle_hash")
    marked = numbered.join(marks_of, key == marks_of["id"], "left").select(*numbered.columns, "__settled")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t, marks in zip(batch.column(at), batch.column(len(columns)).to_pylist()):
                if not t.is_valid or not marks:
                    out.append(t.as_py())
                    continue
                b = _utf8(t)
                out.append(kept_bytes(b, removed_spans(len(b), [(m["at"], m["n"]) for m in marks], length)).decode("utf-8", "ignore"))
            cols = [pa.array(out, pa.string()) if i == at else batch.column(i) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays(cols, names=columns)

    return marked.mapInArrow(run, docs.schema)


def kept_bytes(b: bytes, gone: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for span in gone for x in span), len(b)]
    return b"".join(b[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2))


def digests(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) for each row."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    marked = src.join(_marks(src, length).hint("shuffle_hash"), "id", "left").select("id", "text", "__settled")
    schema = docs.select(id_col).schema
    for n, t in (("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"), ("kept_sha256", "string")):
        schema = schema.add(n, T.LongType() if t == "long" else T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t, marks in zip(batch.column(1), batch.column(2).to_pylist()):
                b = _utf8(t)
                gone = removed_spans(len(b), [(m["at"], m["n"]) for m in marks or ()], length)
                rows.append((len(b), sum(z - a for a, z in gone), len(gone), hashlib.sha256(kept_bytes(b, gone)).hexdigest()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string())))], names=schema.names)

    return marked.mapInArrow(run, schema)
