"""Shared plumbing: Arrow mapping over texts, durable cuts, connected components."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.durable import cut, forget, shared_dir  # noqa: F401  the operators take them from here

WORD_BREAK = re.compile(r"[\x20\x09-\x0D]+")


def words(text: str) -> list[str]:
    """Maximal runs of characters other than ASCII white space."""
    return [w for w in WORD_BREAK.split(text) if w]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_texts(
    df: DataFrame,
    make: Callable[[], Callable[[str], tuple]],
    fields: list[tuple[str, str]],
    text_col: str = "text",
    keep: list[str] | None = None,
    where: int | None = None,
) -> DataFrame:
    """Append to each row what a function makes of its text (null: empty).

    ``make`` runs once in each task and returns the function; ``fields`` are the (name, Arrow type)
    of its results. ``keep`` are the columns passed through, all of them by default; a result takes
    the place of a kept column of the same name. ``where``: index of a boolean result, rows without
    which are left out; the results are then left out too, so that the columns stay as they were.
    """
    keep = df.columns if keep is None else keep
    src = df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, text_col])])
    arrow = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
    added = [] if where is not None else fields
    kept = [c for c in keep if c not in {n for n, _ in added}]
    schema = T.StructType([src.schema[c] for c in kept] + [T.StructField(n, T._parse_datatype_string(t)) for n, t in added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            rows = [fn(t.as_py() or "") for t in batch.column(at)]
            if where is not None:
                mask = pa.array([r[where] for r in rows], pa.bool_())
                yield batch.select(kept).filter(mask)
                continue
            cols = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            cols += [pa.array([r[i] for r in rows], arrow[t]) for i, (_, t) in enumerate(fields)]
            yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return src.mapInArrow(run, schema)


def release() -> None:
    """Give memory of finished work back to the system: Python workers live on from task to task."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


_WORD = (1 << 32) - 1


def _times(x: Column, by: int) -> Column:
    """x * by in 32 bits, without a product beyond 63."""
    low = x * F.lit(by & 0xFFFF)
    high = F.shiftleft((x * F.lit(by >> 16)).bitwiseAND(F.lit(0xFFFF)), 16)
    return (low + high).bitwiseAND(F.lit(_WORD))


def _xor_shift(x: Column, *by: int) -> Column:
    out = x
    for n in by:
        out = out.bitwiseXOR(F.shiftright(x, n))
    return out


def _rotate_right(x: Column, by: int) -> Column:
    return F.shiftright(x, by).bitwiseOR(F.shiftleft(x, 32 - by).bitwiseAND(F.lit(_WORD)))


def partition_key(number: Column) -> Column:
    """An int that Spark's hash partitioning puts in partition ``number``, among any more partitions than that.

    Groups so keyed are dealt evenly, where hashed keys would share partitions and leave others empty. It is the
    inverse of the 32-bit Murmur3 hash with seed 42, each step of which can be undone.
    """
    odd = lambda x: pow(x, -1, 1 << 32)
    steps = [
        lambda h: _xor_shift(h, 16),
        lambda h: _times(h, odd(0xC2B2AE35)),
        lambda h: _xor_shift(h, 13, 26),
        lambda h: _times(h, odd(0x85EBCA6B)),
        lambda h: _xor_shift(h, 16).bitwiseXOR(F.lit(4)),
        lambda h: _times((h + F.lit((1 << 32) - 0xE6546B64)).bitwiseAND(F.lit(_WORD)), odd(5)),
        lambda h: _rotate_right(h, 13).bitwiseXOR(F.lit(42)),
        lambda h: _times(h, odd(0x1B873593)),
        lambda h: _rotate_right(h, 15),
        lambda h: _times(h, odd(0xCC9E2D51)),
        lambda k: F.when(k >= 1 << 31, k - F.lit(1 << 32)).otherwise(k),
    ]
    at = F.array(number.cast("long"))
    for step in steps:  # as functions of a variable: written out, each step would double the expression
        at = F.transform(at, step)
    return F.element_at(at, 1).cast("int")


def _same_node_min(edges: DataFrame) -> DataFrame:
    """For each node u the least of its neighbours and itself (combined before the shuffle)."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node reachable, for each node on an edge.

    ``edges`` has long columns u and v. Alternating large-star and small-star steps (Kiveris et al.,
    2014): neighbour lists are never gathered, only their minima, and the join that carries a minimum
    back to a node's edges has one row a node on one side, so a hot node can be split. Each round is
    written to the shared folder; the last round is found by an order-free digest of the edge set.
    """
    e = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())

    def digest(d: DataFrame):
        return d.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()

    before = digest(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_same_node_min(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # each edge now points from the greater node to a lesser one
        low = large.where("u <> v").distinct()
        least = low.groupBy("u").agg(F.min("v").alias("m"))
        small = low.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        nxt = cut(small)
        forget(e)
        e, after = nxt, digest(nxt)
        if tuple(after) == tuple(before):
            break
        before = after
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
