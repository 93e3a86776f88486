"""Embedding near-duplicates: int8 tile products with rigorous bounds, exact recomputation of what may link.

Each vector is brought to length 1 and quantised to int8 with a scale of its own; the length of what
quantising took off is kept, rounded up. For two vectors x = s q + e and y, |xy - ss'qq'| is at most
|sq||e'| + |e|(|s'q'| + |e'|), so the integer product of a tile (exact in float32) and these bounds say
which pairs can reach the threshold; only those are recomputed, in double precision from the stored vectors.

Copies are folded first: equal vectors are one node whatever their number. Vectors are dealt by their nearest
of a few pivots, and large cells are cut by a hash, into blocks; a block knows its interval of angles to
every pivot. Linked vectors differ by at most arccos(threshold) in the angle to any pivot, so only pairs of
blocks whose intervals come that close, for all pivots, are multiplied. Pairs of blocks meet by equal bands
of the angle to the first pivot. Tiles of neighbouring blocks are one task, so that a block travels once for many
tiles. A tile gives link counts and a spanning forest, never its pairs.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components link with nothing
and are kept; vectors of different lengths don't link; repeated rows are vectors of their own; a vector without an
id counts as a link of others, but names no component unless all in it have none; cosines at the threshold link; an
empty table gives an empty result; further columns don't matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import components, cut

BLOCK = 4096
PIVOTS = 48
#: Rows of a tile that are held at once.
STRIP = 256
#: Blocks on either side of the tiles that are one task, at most, and bytes of vectors that it holds.
SIDE, TASK_BYTES = 16, 128 << 20
#: Longest dot product whose integer value float32 holds exactly: 2**24 / 127**2.
_EXACT = 1040


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes of unit rows, their scales, and upper bounds of the lengths of the residuals."""
    scale = np.abs(x).max(1) / 127
    q = np.rint(x / scale[:, None]).astype(np.int8)
    error = np.linalg.norm(x - q * scale[:, None], axis=1)
    return q, scale, error * (1 + 1e-9) + 1e-12


def upper_bounds(a, b) -> np.ndarray:
    """Upper bounds of the cosines between the rows of two quantised blocks."""
    qa, sa, ea = a
    qb, sb, eb = b
    dot = np.zeros((len(qa), len(qb)), np.float64 if qa.shape[1] > _EXACT else np.float32)
    for lo in range(0, qa.shape[1], _EXACT):
        dot += qa[:, lo : lo + _EXACT].astype(np.float32) @ qb[:, lo : lo + _EXACT].astype(np.float32).T
    la, lb = 1 + ea, 1 + eb  # the quantised vectors' lengths, at most
    bound = dot * sa[:, None].astype(np.float32) * sb[None, :].astype(np.float32)
    bound += (la[:, None] * eb[None, :] + ea[:, None] * (lb + eb)[None, :]).astype(np.float32)
    return bound + np.float32(1e-5)  # rounding of the float32 steps above, amply


def local_components(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The least node reachable from each of n nodes."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, u, least)
        np.minimum.at(new, v, least)
        np.minimum.at(new, label[u], least)
        np.minimum.at(new, label[v], least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def link_tile(x: np.ndarray, y: np.ndarray | None, threshold: float, mult_x: np.ndarray, mult_y: np.ndarray):
    """Links between rows of x and y (of x with itself if y is None): weighted counts for both, and forest edges.

    Edges number the rows of x from 0 and those of y after them.
    """
    same = y is None
    y = x if same else y
    ux = x / np.linalg.norm(x, axis=1)[:, None]
    uy = ux if same else y / np.linalg.norm(y, axis=1)[:, None]
    quant_x = quantise(ux)
    quant_y = quant_x if same else quantise(uy)
    count_x, count_y = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
    us, vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    shift = 0 if same else len(x)
    for lo in range(0, len(x), STRIP):
        strip = slice(lo, lo + STRIP)
        maybe = upper_bounds([p[strip] for p in quant_x], quant_y) >= threshold
        i, j = np.nonzero(maybe)
        if same:
            i, j = i[j > i + lo], j[j > i + lo]
        if not len(i):
            continue
        if len(i) * 8 > maybe.size:  # dense: one product in double precision
            exact = (ux[strip] @ uy.T)[i, j]
        else:
            exact = np.concatenate([np.einsum("ij,ij->i", ux[lo + i[k : k + 65536]], uy[j[k : k + 65536]]) for k in range(0, len(i), 65536)])
        # at the very threshold the plain formula decides
        edge = np.abs(exact - threshold) < 1e-12
        if edge.any():
            a, b = x[lo + i[edge]], y[j[edge]]
            exact[edge] = (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))
        hit = exact >= threshold
        i, j = lo + i[hit], j[hit]
        np.add.at(count_x, i, mult_y[j])
        np.add.at(count_x if same else count_y, j, mult_x[i])
        us.append(i)
        vs.append(j + shift)
        if sum(map(len, us)) > 500_000:
            us, vs = _forest(len(x) + shift and len(x) + len(y), us, vs)
    us, vs = _forest(len(x) + len(y), us, vs)
    return count_x, count_y, us[0], vs[0]


def _forest(n: int, us: list[np.ndarray], vs: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    label = local_components(n, np.concatenate(us), np.concatenate(vs))
    u = np.flatnonzero(label != np.arange(n))
    return [u], [label[u]]


_BLOCK = "block long, dim int, ids binary, mults binary, vectors binary, low array<float>, high array<float>"


def _near_pivots(nodes: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """nodes (node, dim, mult, embedding) with ``cell``, the number of the nearest pivot among those of all lengths."""
    before = dict(zip(sorted(pivots), np.cumsum([0] + [len(pivots[d]) for d in sorted(pivots)]).tolist()))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = [before[d] + int((pivots[d] @ np.asarray(v.values, np.float64)).argmax()) for v, d in zip(batch.column(3), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int64())], names=[*batch.schema.names, "cell"])

    return nodes.mapInArrow(placed, T.StructType([*nodes.schema.fields, T.StructField("cell", T.LongType())]))


def _blocks(near: DataFrame, pivots: dict[int, np.ndarray], cells: dict[int, int], stored: str) -> DataFrame:
    """Blocks of nodes of one cell, as one row each. ``cells``: nodes of each cell; a larger one is cut by a hash. ``stored``: the vectors' own type."""
    cuts = F.create_map(*[F.lit(x) for c, n in cells.items() for x in (c, max(1, -(-n // BLOCK)))])
    block = F.col("cell") * F.lit(1 << 32) + F.pmod(F.xxhash64("node"), F.element_at(cuts, F.col("cell")))

    def made(t: pa.Table) -> pa.Table:
        t = t.take(pa.array(np.argsort(t.column("node").to_numpy())))
        dim = t.column("dim")[0].as_py()
        x = np.array(t.column("embedding").combine_chunks().flatten(), np.float64).reshape(-1, dim)
        cos = np.clip(x / np.linalg.norm(x, axis=1)[:, None] @ pivots[dim].T, -1, 1)
        angle = np.arccos(cos)
        low, high = angle.min(0) - 1e-5, angle.max(0) + 1e-5
        return pa.table({
            "block": pa.array([t.column("block")[0].as_py()], pa.int64()), "dim": pa.array([dim], pa.int32()),
            "ids": [t.column("node").to_numpy().tobytes()], "mults": [t.column("mult").to_numpy().tobytes()],
            "vectors": [x.astype(stored).tobytes()], "low": pa.array([low.tolist()], pa.list_(pa.float32())), "high": pa.array([high.tolist()], pa.list_(pa.float32())),
        })

    return near.withColumn("block", block).groupBy("block").applyInArrow(made, _BLOCK)


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, n_links, component_id, kept) for each row."""
    kind = vectors.schema[id_col].dataType.simpleString()
    stored = "<f4" if vectors.schema[vec_col].dataType.simpleString() == "array<float>" else "<f8"
    e = F.col("embedding")
    good = (
        e.isNotNull()
        & (F.size(e) > 0)
        & ~F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists(e, lambda x: x != 0)
    )
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("embedding")).withColumn("good", F.coalesce(good, F.lit(False)))
    distinct = rows.where("good").groupBy("embedding").agg(F.min("id").alias("least"), F.count("*").alias("mult"))
    nodes = cut(distinct.withColumn("node", F.monotonically_increasing_id()).withColumn("dim", F.size("embedding")))
    picked = nodes.orderBy(F.xxhash64("embedding"), "node").limit(20 * PIVOTS).select("dim", "embedding").collect()
    dims = [r["dim"] for r in nodes.select("dim").distinct().collect()]
    n = nodes.count()
    if not n:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    wanted = max(1, min(PIVOTS, n // BLOCK))
    pivots = {}
    for d in dims:
        some = np.array([r["embedding"] for r in picked if r["dim"] == d][:wanted] or [[1.0] + [0.0] * (d - 1)])
        pivots[d] = some / np.linalg.norm(some, axis=1)[:, None]
    near = cut(_near_pivots(nodes.select("node", "dim", "mult", "embedding"), pivots))
    cells = {r["cell"]: r["count"] for r in near.groupBy("cell").count().collect()}  # a row a pivot at most
    blocks = cut(_blocks(near, pivots, cells, stored))

    reach = math.acos(threshold) + 1e-4
    meta = blocks.select("block", "dim", "low", "high")
    band = lambda c: F.floor(c / F.lit(reach)).cast("int")
    first = meta.withColumn("band", F.explode(F.sequence(band(F.col("low")[0]) - 1, band(F.col("high")[0]) + 1)))
    second = meta.select(F.col("block").alias("other"), "dim", F.col("low").alias("low2"), F.col("high").alias("high2"), F.explode(F.sequence(band(F.col("low")[0]), band(F.col("high")[0]))).alias("band"))
    gaps = F.zip_with("low", "high2", lambda a, b: a - b > F.lit(reach))
    gaps2 = F.zip_with("low2", "high", lambda a, b: a - b > F.lit(reach))
    close = ~F.exists(gaps, lambda x: x) & ~F.exists(gaps2, lambda x: x)
    tiles = first.join(second, ["dim", "band"]).where((F.col("block") <= F.col("other")) & close).select("block", "other").distinct()
    # tiles of neighbouring blocks are one task: a block's data is sent once for all its tiles there
    n_tiles, size = tiles.count(), BLOCK * max(dims) * np.dtype(stored).itemsize
    side = max(1, min(SIDE, math.isqrt(n_tiles // 24), TASK_BYTES // (2 * size)))
    group = lambda c: F.shiftright(c, 32) * F.lit(1 << 24) + F.floor(F.col(c).bitwiseAND(F.lit((1 << 32) - 1)) / F.lit(side)).cast("long")
    wide = cut(tiles.select(group("block").alias("ga"), group("other").alias("gb"), "block", "other"))
    sent = wide.select("ga", "gb", F.explode(F.array("block", "other")).alias("block")).distinct()
    carried = sent.join(blocks.select("block", "dim", "ids", "mults", "vectors"), "block")
    parts = max(1, min(20_000, 2 * wide.select("ga", "gb").distinct().count()))

    def linked(held: pa.Table, asked: pa.Table) -> pa.Table:
        of = {}
        for r in held.select(["block", "dim", "ids", "mults", "vectors"]).to_pylist():
            of[r["block"]] = (np.frombuffer(r["ids"], np.int64), np.frombuffer(r["mults"], np.int64), np.frombuffer(r["vectors"], stored).reshape(-1, r["dim"]))
        del held
        us, vs, ns = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for block, other in zip(asked.column("one").to_pylist(), asked.column("other").to_pylist()):
            (ids_a, mult_a, x), (ids_b, mult_b, y) = of[block], of[other]
            same = block == other
            ca, cb, u, v = link_tile(x.astype(np.float64), None if same else y.astype(np.float64), threshold, mult_a, mult_b)
            ids = np.concatenate((ids_a, ids_a if same else ids_b))
            counts = np.concatenate((ca, cb))
            some = np.flatnonzero(counts)
            us += [ids[some], ids[u]]
            vs += [ids[some], ids[v]]
            ns += [counts[some], np.zeros(len(u), np.int64)]
        return pa.table({"u": np.concatenate(us), "v": np.concatenate(vs), "n": np.concatenate(ns)})

    todo = wide.select(F.col("ga").alias("ta"), F.col("gb").alias("tb"), F.col("block").alias("one"), "other").repartition(parts, "ta", "tb")
    dealt = carried.repartition(parts, "ga", "gb").groupBy("ga", "gb").cogroup(todo.groupBy("ta", "tb"))
    found = cut(dealt.applyInArrow(linked, "u long, v long, n long"))
    counts = found.where("u = v").groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("others"))
    comp = components(found.where("u <> v").select("u", "v"))
    named = nodes.select("node", "least", "mult", F.col("embedding").alias("e")).join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    member = named.join(least, "component").join(counts, "node", "left").select("e", "component_id", (F.col("mult") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    out = rows.join(member, rows.good & (rows.embedding == member.e), "left")
    component_id = F.coalesce("component_id", "id").cast(kind)
    return out.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component_id.alias("component_id"), (F.col("id") == component_id).alias("kept"),
    )
