"""SimHash near-duplicates: fingerprints, pigeonhole blocks, verified links, components.

Two operators share the plan "split fingerprints in blocks, join on equal blocks, verify": ``near_duplicates`` with
64 sign bits and Hamming distance, ``similar_documents`` with a wider one and the similarity itself.

A 64-bit fingerprint is cut into six blocks. Two fingerprints that differ in at most three bits agree on
at least three blocks, so each fingerprint is filed under all twenty choices of three blocks (about 32
bits each), equal keys are joined and the Hamming distance is verified on what meets.

Copies are folded first: equal fingerprints are one node whatever their number, so a group of copies that
holds a third of all rows costs one node. Fingerprints that differ in one block only are put together before that,
in groups whose size the block's width bounds; pairs are then taken between the families so found only.

Defined cases: a null or empty text has fingerprint zero and is linked like any other; repeated rows get
the class of their fingerprint; a bit set in exactly half the hashes is 0; of the ids of a class the least names
it; texts of any length count whole; an empty table gives an empty result; further columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import components, cut, forget, map_texts, partition_key, release

#: (shift, width) of the blocks, from the highest bit.
BLOCKS = ((53, 11), (42, 11), (31, 11), (20, 11), (10, 10), (0, 10))
MAX_BITS = 3


def fingerprint(text: str, size: int = 3) -> int:
    """Unsigned SimHash of the text's word shingles, over XXH64 with seed 42 of their UTF-8."""
    ws = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    n = max(1, len(ws) - size + 1) if ws else 0
    if not n:
        return 0
    joined = memoryview(b" ".join(ws))
    ends = np.cumsum([len(w) + 1 for w in ws]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = ends[min(size, len(ws)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    total = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        hs = np.array([digest(joined[a:b], 42) for a, b in zip(starts[at : at + (1 << 16)], stops[at : at + (1 << 16)])], ">u8")
        total += np.unpackbits(hs.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big")


def signed(x: int) -> int:
    """An unsigned 64-bit number as the long with the same bits."""
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """(id, fp): fp is the fingerprint as a signed long."""

    def make():
        def row(text: str) -> tuple:
            return (signed(fingerprint(text, size)),)

        return row

    return map_texts(docs, make, [("fp", "long")], text_col, [id_col])


def _block(col, shift: int, width: int):
    return F.shiftrightunsigned(col, shift).bitwiseAND(F.lit((1 << width) - 1))


def _keys(col):
    """The keys of a fingerprint: (number of the choice of blocks, value of those blocks)."""
    out = []
    for i, choice in enumerate(combinations(BLOCKS, 3)):
        value = F.lit(i).cast("long")
        for shift, width in choice:
            value = F.shiftleft(value, width).bitwiseOR(_block(col, shift, width))
        out.append(value)
    return F.array(*out)


def block_links(nodes: DataFrame, fp_col: str = "fp") -> DataFrame:
    """(u, v): a spanning forest of the links between fingerprints that differ in one block only.

    Fingerprints that agree on all blocks but one form groups of at most 2**11 members whatever the data, so a
    group is linked in one task, and a family of near copies gives as many rows as members, not its pairs.
    """
    others = [signed(~(((1 << w) - 1) << s) & (2**64 - 1)) for s, w in BLOCKS]
    masks = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(m).cast("long").alias("m")) for i, m in enumerate(others)])
    filed = nodes.select(F.col(fp_col).alias("f"), F.explode(masks).alias("b")).select("f", F.col("b.i").alias("i"), F.col("f").bitwiseAND(F.col("b.m")).alias("rest"))
    crowded = filed.groupBy("i", "rest").agg(F.count("*").alias("n")).where("n > 1").select("i", "rest")

    def linked(t: pa.Table) -> pa.Table:
        f = np.sort(t.column("f").to_numpy().astype(np.uint64))
        near = np.bitwise_count(f[:, None] ^ f[None, :]) <= MAX_BITS
        label = np.arange(len(f))
        while True:  # the least member reachable, by rows
            new = np.where(near, label[None, :], len(f)).min(1)
            new = np.minimum(new, new[new])
            if (new == label).all():
                break
            label = new
        u = np.flatnonzero(label != np.arange(len(f)))
        return pa.table({"u": f[u].astype(np.int64), "v": f[label[u]].astype(np.int64)})

    return filed.join(crowded, ["i", "rest"], "left_semi").groupBy("i", "rest").applyInArrow(linked, "u long, v long")


def links(nodes: DataFrame, fp_col: str = "fp", family_col: str | None = None) -> DataFrame:
    """(u, v) with u < v: pairs of different fingerprints at MAX_BITS or fewer differing bits.

    Found through equal keys; a pair that shares several keys is given once. Pairs of one family, if a column
    names it, are left out: they are known to be in one component. Keys that one family holds alone are dropped
    before the join, and of the others all but the family with most members meet the whole key: of two different
    families one isn't the largest, so no pair is lost, and a key of n members of one family and a few more
    costs a few times n comparisons.
    """
    family = F.col(family_col) if family_col else F.col(fp_col)
    filed = nodes.select(F.col(fp_col).alias("f"), family.alias("family"), F.explode(_keys(F.col(fp_col))).alias("key"))
    mixed = filed.groupBy("key").agg(F.min("family").alias("lo"), F.max("family").alias("hi")).where("lo <> hi").select("key")
    some = cut(filed.join(mixed, "key", "left_semi"))
    held = some.groupBy("key", "family").agg(F.count("*").alias("n"))
    largest = held.groupBy("key").agg(F.max(F.struct("n", "family"))["family"].alias("largest"))
    here = some.join(largest, "key")
    a = here.where("family <> largest").select("key", F.col("f").alias("x"), F.col("family").alias("fx"))
    b = here.select("key", F.col("f").alias("y"), F.col("family").alias("fy"))
    near = F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= MAX_BITS
    met = a.join(b, (a.key == b.key) & (F.col("fx") != F.col("fy")) & near)
    return met.select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """(id, fingerprint as 16 hexadecimal digits, component_id: the least id reachable by links)."""
    fps = cut(fingerprints(docs, id_col, text_col, size))
    nodes = fps.groupBy("fp").agg(F.min(id_col).alias("least"))
    forest = cut(block_links(nodes))
    families = components(forest)
    known = nodes.join(families, nodes.fp == families.node, "left").select("fp", F.coalesce("component", "fp").alias("family"))
    comp = components(forest.unionByName(links(known, family_col="family")))
    named = nodes.join(comp, nodes.fp == comp.node, "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    member = named.join(least, "component").select("fp", "component_id")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return fps.join(member, "fp").select(id_col, hexed, "component_id")


# ------------------------------------------------------------------ by similarity

#: Blocks of the wide fingerprint and sign bits in each: of two sets of shingles with a Jaccard similarity of 0.9 about
#: one bit in ten differs, and some of the blocks are equal with a chance of 0.9 (at 0.95: 0.997; at 0.8: 0.46).
SLICES, WIDTH = 32, 24
#: Of the first 128 sign bits as many may differ between texts that are compared: at a similarity of 0.8 about 19 do,
#: with a deviation of 4, of unrelated texts 64.
FAR_BITS = 44
#: Rounds in which each key tries one representative, before all that is still apart meets by its first shingles.
STAR_ROUNDS = 2
#: Places in which ``_levels`` counts the shingles of all texts, and how many of them travel as one row.
PLACES, PART = 1 << 24, 1 << 16
#: About so many shingles are counted together, and so many of one task's are dealt at once.
COUNTED = 1 << 19
#: Sets of more shingles than this are told apart by how many of their first ones they share.
LONG = 512

_MIX, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_SEEDS = np.random.default_rng(42).integers(0, 1 << 64, (1, SLICES * WIDTH // 64), np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _MIX2
    return h ^ (h >> np.uint64(32))


def shingles(text: str, size: int) -> np.ndarray:
    """The set of the text's word shingles, as sorted 64-bit hashes. Fewer words: the whole sequence; none: empty."""
    ws = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not ws:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, ws), np.uint64, len(ws))
    n = max(1, len(ws) - size + 1)
    h = np.zeros(n, np.uint64)
    for k in range(min(size, len(ws))):
        h = (h + w[k : k + n]) * _MIX
    return np.unique(_mixed(h))


def wide_fingerprint(h: np.ndarray) -> np.ndarray:
    """SimHash of a set of shingles in 768 bits, as bytes: a bit is 1 if set in over half of the shingles' hashes."""
    total = np.zeros(SLICES * WIDTH, np.int64)
    for at in range(0, len(h), 1024):
        wide = _mixed((h[at : at + 1024, None] ^ _SEEDS) * _MIX)
        total += np.unpackbits(wide.view(np.uint8), axis=1).sum(0, dtype=np.int32)
    return np.packbits(2 * total > len(h))


def wide_keys(fp: np.ndarray) -> np.ndarray:
    """The keys of wide fingerprints, one for each block: its number and its value."""
    b = fp.reshape(-1, SLICES, WIDTH // 8).astype(np.int64)
    return (np.arange(SLICES) << WIDTH) + (b << np.arange(WIDTH - 8, -1, -8)).sum(2)


def parities(h: np.ndarray) -> np.ndarray:
    """512 bits, as 8 longs: whether an odd number of the set's hashes falls in each place. Of two sets at least as
    many shingles stand in one only as bits differ."""
    return np.packbits(np.bincount((h >> np.uint64(55)).astype(np.int64), minlength=512) & 1).view(np.int64)


def rarest_first(h: np.ndarray, weight: np.ndarray, similarity: float) -> np.ndarray:
    """So many shingles of a set, by their weight and else by their hash, that any set as similar shares one of them with
    it among its own, if a shingle has the same weight in each."""
    return h[np.argsort(weight, kind="stable")][: len(h) - int(np.ceil(len(h) * similarity - 1e-9)) + 1]


def first_shingles(h: np.ndarray, frequent: np.ndarray, counts: np.ndarray, similarity: float) -> np.ndarray:
    """Those with the counts of a sorted list of shingles as weights, 0 for all others."""
    weight = np.zeros(len(h), np.int64)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, h), len(frequent) - 1)
        weight = np.where(frequent[at] == h, counts[at], 0)
    return rarest_first(h, weight, similarity)


def places(h: np.ndarray) -> np.ndarray:
    """The places in which shingles are counted."""
    return (h * _MIX >> np.uint64(65 - PLACES.bit_length())).astype(np.int64)


def _node(h: np.ndarray) -> int:
    return signed(xxhash.xxh3_64_intdigest(h.tobytes()))


def _levels(named: DataFrame, size: int) -> np.ndarray:
    """For each place how many texts hold a shingle there, as eight times the binary logarithm of that and one.

    All shingles of all rows are counted; equal sets of one task count once. A task has one bounded table, of which the
    full places travel. Once there are more shingles than places this tells little; ``_rarest`` counts each by itself.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seen = np.zeros(PLACES, np.uint16), set()

        def add(sets: list[np.ndarray]) -> None:
            at, n = np.unique(places(np.concatenate([np.zeros(0, np.uint64), *sets])), return_counts=True)
            held[at] = np.minimum(held[at] + n, 0xFFFF)

        for batch in batches:
            sets, much = [], 0
            for text in batch.column(0):
                h = shingles(text.as_py() or "", size)
                if (node := _node(h)) in seen:
                    continue
                seen.add(node)
                sets.append(h)
                much += len(h)
                if much >= 1 << 20:
                    add(sets)
                    sets, much = [], 0
            add(sets)
        for part, n in enumerate(held.reshape(-1, PART)):
            at = np.flatnonzero(n)
            if len(at):
                yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "at": pa.array([at.astype(np.uint16).tobytes()], pa.binary()), "n": pa.array([n[at].tobytes()], pa.binary())})

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, at, n in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                held = sums.setdefault(part, np.zeros(PART, np.uint32))
                held[np.frombuffer(at.as_buffer(), np.uint16)] += np.frombuffer(n.as_buffer(), np.uint16)
        for part, n in sums.items():
            level = np.round(8 * np.log2(1.0 + n)).astype(np.uint8)
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "level": pa.array([level.tobytes()], pa.binary())})

    counted = named.select("text").mapInArrow(count, "part int, at binary, n binary")
    levels = np.zeros((PLACES // PART, PART), np.uint8)
    for r in counted.repartition("part").mapInArrow(total, "part int, level binary").toLocalIterator():
        levels[r.part] = np.frombuffer(r.level, np.uint8)
    return levels.reshape(-1)


def _binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The values as bytes, a row up to each of the ends."""
    offsets = np.concatenate(([0], ends)) * values.itemsize
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _values(t: pa.Table, name: str, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The values in a column of bytes, and how many each row has."""
    parts = [np.frombuffer(b.as_buffer(), kind) for b in t.column(name)]
    return np.concatenate([*parts, np.zeros(0, kind)]), np.array([len(x) for x in parts], np.int64)


def _rarest(named: DataFrame, size: int, similarity: float, total: int) -> DataFrame:
    """(node, skipped, first): the first shingles of each set, those that fewer texts hold before others, as longs; what no
    other text holds comes before all, can't be shared and is only counted, in ``skipped``.

    Every shingle of every row is counted by itself, whatever their number. They are dealt by their highest bits to as
    many parts as keep a part's size, where those in several rows are found and how many texts hold them (told apart by 16
    bits of their nodes: that is the order only); these alone go back to the texts. Shingles travel in 32 bits below those
    of the part: such as agree in them count as one, in all texts. Equal sets of one task count once.
    """
    bits = min(16, max(6, (total // COUNTED).bit_length()))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, turn, seen = TaskContext.get().partitionId(), 0, set()

        def group(nodes: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
            h, sizes, number = np.concatenate(sets), np.array([len(x) for x in sets], np.int32), (turn << 20) + task
            part = (h >> np.uint64(64 - bits)).astype(np.uint16)
            at = np.argsort(part, kind="stable")
            part, text = part[at], np.repeat(np.arange(len(sets)), sizes)[at]
            low = (h[at] << np.uint64(bits) >> np.uint64(32)).astype(np.uint32)
            run = np.flatnonzero(np.concatenate(([True], (part[1:] != part[:-1]) | (text[1:] != text[:-1]))))
            ids = np.arange(1 << bits)
            ends, run_ends = np.searchsorted(part, ids, "right"), np.searchsorted(part[run], ids, "right")
            own = np.array(nodes, np.int64)
            told = (ids >= number % len(ids)) * len(own)  # one row has the nodes
            columns = {
                "part": pa.array(ids, pa.int32()),
                "number": pa.array(np.full(len(ids), number), pa.int64()),
                "low": _binary(low, ends),
                "text": _binary(text[run].astype(np.uint16), run_ends),
                "tag": _binary((own[text[run]] & 0xFFFF).astype(np.uint16), run_ends),
                "held": _binary(np.diff(np.append(run, len(h))).astype(np.uint32), run_ends),
                "nodes": _binary(own, told),
                "sizes": _binary(sizes, told),
            }
            rows = np.diff(np.concatenate(([0], ends))) > 0
            rows[number % len(ids)] = True
            return pa.RecordBatch.from_pydict(columns).filter(pa.array(rows))

        nodes, sets, much = [], [], 0
        for batch in batches:
            for text in batch.column(0):
                h = shingles(text.as_py() or "", size)
                if not len(h) or (node := _node(h)) in seen:
                    continue
                seen.add(node)
                nodes.append(node)
                sets.append(h)
                much += len(h)
                if much >= COUNTED or len(sets) > 0xFFFF:
                    yield group(nodes, sets)
                    nodes, sets, much, turn = [], [], 0, turn + 1
                    release()
        if sets:
            yield group(nodes, sets)
        nodes, sets = [], []
        release()

    def counted(t: pa.Table) -> pa.Table:
        release()
        low, many = _values(t, "low", np.uint32)
        held = _values(t, "held", np.uint32)[0]
        text, tag = (np.repeat(_values(t, c, np.uint16)[0], held) for c in ("text", "tag"))
        both = np.sort(low.astype(np.uint64) << np.uint64(16) | tag)
        value = (both >> np.uint64(16)).astype(np.uint32)
        start = np.flatnonzero(np.concatenate((np.ones(min(1, len(value)), bool), value[1:] != value[:-1])))
        rows = np.diff(np.append(start, len(value)))
        texts = np.cumsum(np.concatenate((np.zeros(min(1, len(both)), int), both[1:] != both[:-1])))
        texts = texts[start + rows - 1] - texts[start] + 1
        several, texts = value[start][rows > 1], np.minimum(texts[rows > 1], 0xFFFF).astype(np.uint16)
        some = np.zeros(1 << 22, bool)
        some[several >> 10] = True
        at = np.flatnonzero(some[low >> 10])
        place = np.searchsorted(several, low[at])
        good = several[np.minimum(place, len(several) - 1)] == low[at] if len(several) else np.zeros(0, bool)
        at, place = at[good], place[good]
        ends = np.searchsorted(at, np.cumsum(many))
        columns = {"part": t.column("part"), "number": t.column("number"), "low": _binary(low[at], ends), "text": _binary(text[at], ends), "texts": _binary(texts[place], ends), "nodes": t.column("nodes"), "sizes": t.column("sizes")}
        rows = (np.diff(np.concatenate(([0], ends))) > 0) | (_values(t, "nodes", np.int64)[1] > 0)
        return pa.table(columns).filter(pa.array(rows))

    def ordered(t: pa.Table) -> pa.Table:
        release()
        nodes, n = _values(t, "nodes", np.int64)[0], _values(t, "sizes", np.int32)[0].astype(np.int64)
        low, many = _values(t, "low", np.uint32)
        text, texts = (_values(t, c, np.uint16)[0] for c in ("text", "texts"))
        h = np.repeat(t.column("part").to_numpy().astype(np.int64), many) << 32 | low
        shared = np.bincount(text, minlength=len(n))
        wanted = np.clip(n - np.ceil(n * similarity - 1e-9).astype(np.int64) + 1 - (n - shared), 0, shared)
        here = np.flatnonzero(wanted[text] > 0)
        at = here[np.lexsort((h[here], texts[here], text[here]))]
        of = text[at]
        rank = np.arange(len(at)) - np.searchsorted(of, np.arange(len(n)))[of]
        return pa.table({"node": nodes, "skipped": (n - shared).astype(np.int32), "first": _binary(h[at[rank < wanted[of]]], np.cumsum(wanted))})

    rows = named.select("text").mapInArrow(dealt, "part int, number long, low binary, text binary, tag binary, held binary, nodes binary, sizes binary")
    found = rows.groupBy(partition_key(F.col("part")).alias("key")).applyInArrow(counted, "part int, number long, low binary, text binary, texts binary, nodes binary, sizes binary")
    return found.groupBy(partition_key(F.col("number")).alias("key")).applyInArrow(ordered, "node long, skipped int, first binary")


def _exploded(rows: DataFrame, each, kept: list[str], fields: str) -> DataFrame:
    """A row for each of what ``each`` makes of the bytes in the first column: (values of the new columns, how many of them
    for each row); the columns kept follow."""
    names = [f.split()[0] for f in fields.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, counts = each([x.as_buffer() for x in batch.column(0)])
            row = pa.array(np.repeat(np.arange(batch.num_rows), counts))
            yield pa.RecordBatch.from_arrays([*map(pa.array, values), *(batch.column(i + 1).take(row) for i in range(len(kept)))], names=names)

    return rows.mapInArrow(run, fields)


def _sets(named: DataFrame, nodes: DataFrame, pairs: DataFrame, size: int) -> DataFrame:
    """(node, shingles) of the nodes in the pairs, made anew from a text of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, sets = [], []
            for text, wanted in zip(batch.column(0), batch.column(1).to_pylist()):
                h = shingles(text.as_py() or "", size)
                if _node(h) == wanted:
                    found.append(wanted)
                    sets.append(h.tobytes())
            yield pa.RecordBatch.from_pydict({"node": pa.array(found, pa.int64()), "shingles": pa.array(sets, pa.binary())})

    ends = pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node"))).distinct()
    # written first: Spark then knows its size before it plans the join, and doesn't deal the texts by id for a few of them
    wanted = cut(nodes.select("node", "least").join(ends, "node", "left_semi").select(F.col("least").alias("id"), F.col("node").alias("wanted")))
    texts = named.join(wanted, "id").select("text", "wanted")
    return texts.mapInArrow(run, "node long, shingles binary").groupBy("node").agg(F.first("shingles").alias("shingles"))


def _similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (u, v) whose shingles have that Jaccard similarity or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3)):
                a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                both = len(a) + len(b) - len(np.union1d(a, b))
                keep.append(both >= similarity * (len(a) + len(b) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    # members first, representatives last: a representative of many is one hot key, which adaptive execution splits
    one = pairs.join(sets.select(F.col("node").alias("v"), F.col("shingles").alias("b")), "v")
    both = one.join(sets.select(F.col("node").alias("u"), F.col("shingles").alias("a")), "u")
    return both.select("u", "v", "a", "b").mapInArrow(run, "u long, v long")


def _shared(rows: DataFrame, key: str) -> DataFrame:
    """The rows whose key several nodes hold, each node's at least once (and, of copies, at most twice). One shuffle; nothing is gathered."""
    w = Window.partitionBy(key).orderBy("node")
    beside = rows.withColumn("before", F.lag("node").over(w)).withColumn("after", F.lead("node").over(w))
    return beside.where("before <> node OR after <> node").drop("before", "after")


def _first_pairs(made: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """(node, peer): nodes of different components that may have that similarity, none left out that has it.

    In any one order of the shingles, two such sets share one of their first n - ceil(similarity * n) + 1 each, and of
    either enough is left from there on. Of the holders of a shingle all but the largest component meet all. What
    parities differ in stands in one of the sets only, which bounds what they share: so texts that have much in common
    but differ by too much of their own make no row. Long sets fill the parities; of these those pairs are left that
    share as many of their first shingles as such sets must.
    """

    def each(buffers):
        hs = [np.frombuffer(b, np.int64) for b in buffers]
        counts = [len(h) for h in hs]
        ranks = [np.arange(k, dtype=np.int32) for k in counts]
        return [np.concatenate([*hs, np.zeros(0, np.int64)]), np.concatenate([*ranks, np.zeros(0, np.int32)])], counts

    held = _exploded(made.select("first", "node", "skipped"), each, ["node", "skipped"], "shingle long, rank int, node long, skipped int")
    held = held.select("shingle", (F.col("rank") + F.col("skipped")).alias("rank"), "node")
    beside = cut(_shared(held, "shingle").join(cut(nodes.select("node", "component")), "node"))
    mixed = beside.groupBy("shingle").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("shingle")
    apart = beside.join(mixed, "shingle", "left_semi").select("shingle", "node", "rank").join(nodes.drop("least"), "node")
    first = cut(apart.withColumn("rest", F.col("n") - F.col("rank")).drop("rank"))
    forget(beside)
    size_of = first.groupBy("shingle", "component").agg(F.count("*").alias("held"))
    largest = size_of.groupBy("shingle").agg(F.max(F.struct("held", "component"))["component"].alias("largest"), F.count("*").alias("parts")).where("parts > 1")
    few = first.join(largest, "shingle").where("component <> largest")
    other = first.select("shingle", F.col("node").alias("peer"), F.col("component").alias("of"), F.col("n").alias("m"), F.col("rest").alias("left"), *(F.col(f"p{i}").alias(f"q{i}") for i in range(8)))
    needed = F.lit(similarity / (1 + similarity)) * (F.col("n") + F.col("m")) - F.lit(1e-6)
    differ = sum((F.bit_count(F.col(f"p{i}").bitwiseXOR(F.col(f"q{i}"))) for i in range(1, 8)), F.bit_count(F.col("p0").bitwiseXOR(F.col("q0"))))
    long = F.least("n", "m") > LONG
    enough = F.least("rest", "left") >= needed
    sizes = F.least("n", "m") >= F.lit(similarity) * F.greatest("n", "m") - F.lit(1e-6)
    fits = (long | enough) & sizes & (F.col("n") + F.col("m") - differ >= 2 * needed)
    met = few.join(other, "shingle").where((F.col("component") != F.col("of")) & fits)
    # what is not among the first of the set whose first ones end earlier is at most its others; repeated rows only count more
    least = F.when(long, F.ceil(needed) - F.ceil(F.lit(similarity) * F.greatest("n", "m") - F.lit(1e-9)) + 1).otherwise(1)
    pairs = met.groupBy(F.least("node", "peer").alias("u"), F.greatest("node", "peer").alias("v")).agg(F.count("*").alias("shared"), F.max(least).alias("least"), F.max(enough).alias("enough"))
    return pairs.where("shared >= least AND enough").select(F.col("u").alias("node"), F.col("v").alias("peer"))


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, similarity: float = 0.8) -> DataFrame:
    """(id, component_id: the least id reachable by links) for each row; texts are linked whose word shingles have that Jaccard similarity or more.

    The fingerprint is a SimHash of the set of shingles in 768 bits, cut in 32 blocks. Fingerprints that agree in a block
    and differ in few bits are near, and their texts are compared by their shingles. Texts with equal sets are one
    node, by a 64-bit digest of the set. Of the texts of a key, one at a time meets the others, those already in its
    component left out. At a similarity of 0.8 about an eighth and more of the bits differ, so some of such pairs share
    no block; last, therefore, all texts of different components meet by the first of their shingles in one order, which
    is exact. So a group of near copies costs a few comparisons a member, and no pair is left out. In that order those
    come first that few texts hold, each counted over all of them: a passage that many texts have brings only those together
    of which it is nearly all, whatever share of the rows they are.

    Defined cases: null, empty texts and such without words are copies of one another; repeated rows are copies;
    of a class the least id names it; rows without an id are no member of any class (component_id null); texts
    of any length count whole; an empty table gives an empty result; further columns don't matter.
    """
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def make():
        def row(text: str) -> tuple:
            h = shingles(text, size)
            fp = wide_fingerprint(h)
            return _node(h), len(h), *fp[:16].view(np.int64).tolist(), *parities(h).tolist(), fp.tobytes() if len(h) else b""

        return row

    bits = ["h0", "h1", *(f"p{i}" for i in range(8))]
    made = cut(map_texts(named, make, [("node", "long"), ("n", "int"), *((c, "long") for c in bits), ("print", "binary")], "text", ["id"]))
    known = made.where("id IS NOT NULL")
    nodes = cut(known.groupBy("node").agg(F.min("id").alias("least"), *(F.first(c).alias(c) for c in ("n", *bits))))

    def each(buffers):
        return [wide_keys(np.frombuffer(b"".join(b.to_pybytes() for b in buffers), np.uint8)).reshape(-1)], SLICES

    filed = _shared(_exploded(known.where("n > 0").select("print", "node"), each, ["node"], "key long, node long"), "key")
    filed = cut(filed.join(nodes.select("node", "n", "h0", "h1"), "node"))

    found = tested = labels = None
    for turn in range(STAR_ROUNDS + 1):
        all_of = filed if turn < STAR_ROUNDS else nodes.drop("h0", "h1")
        here = all_of.withColumn("component", F.col("node"))
        if labels is not None:
            here = all_of.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
        if turn < STAR_ROUNDS:
            apart = here.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("key")
            here = here.join(apart, "key", "left_semi")
            order = F.col("node") if turn == 0 else F.xxhash64("node", F.lit(turn))
            one = F.min(F.struct(order.alias("order"), F.col("node").alias("peer"), F.col("component").alias("of"), F.col("n").alias("m"), F.col("h0").alias("g0"), F.col("h1").alias("g1"))).alias("one")
            near = F.bit_count(F.col("h0").bitwiseXOR(F.col("g0"))) + F.bit_count(F.col("h1").bitwiseXOR(F.col("g1"))) <= FAR_BITS
            fits = F.least("n", "m") >= F.lit(similarity) * F.greatest("n", "m") - F.lit(1e-6)
            pairs = here.join(here.groupBy("key").agg(one).select("key", "one.*"), "key").where((F.col("component") != F.col("of")) & near & fits)
            if turn == 0:  # one representative for each
                pairs = pairs.groupBy("node").agg(F.min("peer").alias("peer"))
        else:
            total = known.agg(F.sum(F.col("n").cast("long"))).first()[0] or 0
            # written first: one Python worker for a task at a time
            pairs = _first_pairs(cut(_rarest(named.where("id IS NOT NULL"), size, similarity, total)), here, similarity)
        least, most = F.least("node", "peer").alias("u"), F.greatest("node", "peer").alias("v")
        pairs = pairs.select(least, most).distinct()
        pairs = cut(pairs if tested is None else pairs.join(tested, ["u", "v"], "left_anti"))
        if pairs.isEmpty():
            continue
        sets = cut(_sets(named, nodes, pairs, size))
        links = cut(_similar(pairs, sets, similarity))
        forget(sets)
        tested = pairs if tested is None else tested.unionByName(pairs)
        found = links if found is None else found.unionByName(links)
        labels = components(found)
    for spent in [filed, *([tested, found] if found is not None else [])]:
        forget(spent)
    named_nodes = nodes.select("node", "least")
    if labels is not None:
        named_nodes = named_nodes.join(labels, "node", "left")
    named_nodes = named_nodes.withColumn("component", F.col("node") if labels is None else F.coalesce("component", "node"))
    least = named_nodes.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = named_nodes.join(least, "component").select("node", "component_id")
    return made.join(classes, "node", "left").select(F.col("id").alias(id_col), F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"))
