"""Tokens of documents, and hierarchical best-fit packing into sequences.

Documents are encoded, closed by an end id, and cut only if longer than a sequence. Pieces are dealt to
groups of bounded size by a hash of their key; each group packs best-fit, largest first, and sets its
nearly full bins aside. Its other bins go up as single items to fewer groups, dealt anew, and so on, until
one group has held all that is left or a round saves next to nothing. Full pieces are sequences at once.
Only (key, length) rows move, never ids. Each round is written to the shared folder before the next one
reads it, so a lost executor can't change what was packed.

Defined cases: a null or empty text is its end id alone; repeated rows are packed each for itself; an empty
table gives an empty result; further columns don't matter.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

CAPACITY = 2048
#: Items that a group gets on average, and groups that meet in one of the next round.
GROUP, FAN_IN = 60_000, 8
#: A bin with no more room than this share of the capacity is set aside.
SLACK = 1 / 512
#: Distinct pieces whose ids a task remembers.
REMEMBERED = 250_000

#: Texts of these characters only take the quick way: normal forms, lower case and character classes agree
#: there between the tokenizer's library and Python's.
_PLAIN = re.compile("[\t\n\x0b\x0c\r\x20-\x7e\xa0-\xac\xae-\xb1\xb4-\xb8\xba\xbb\xbf-įı-ɏ]*")
#: The tokenizer's own split pattern (a fixed value of the vocabulary file), as Python's re has it for such texts.
_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")

#: The letters that byte-level tokenizers write for bytes: printable ones stand for themselves, the others follow 255.
_OWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_LETTERS = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _OWN)}


class _Words(dict):
    """Ids of words, made when first asked for."""

    def __init__(self, content: str):
        from tokenizers.models import BPE

        model = json.loads(content)["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        super().__init__()
        self.tokenize = BPE(vocab=model["vocab"], merges=merges, end_of_word_suffix=model["end_of_word_suffix"], cache_capacity=0).tokenize

    def __missing__(self, word: str) -> bytes:
        spelt = word if word.isascii() else word.encode().decode("latin-1").translate(_BYTE_LETTERS)
        ids = array("I", [t.id for t in self.tokenize(spelt)]).tobytes()
        self[word] = ids
        return ids


class WordTokenizer:
    """Ids of a text by a tokenizer file, as little-endian unsigned 32-bit bytes.

    The tokenizer splits a text into words and encodes each on its own; words are remembered. A text with
    characters on which the split could differ goes to the library whole.
    """

    def __init__(self, content: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.no_truncation()
        self.known = _Words(content)

    def _library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if not _PLAIN.fullmatch(text):
            return self._library(text)
        if len(self.known) > REMEMBERED:
            self.known.clear()
        return b"".join(map(self.known.__getitem__, _SPLIT.findall(text.lower())))


def _flat_map(src: DataFrame, make: Callable[[], Callable[[object, str], Iterator[tuple]]], schema: str, names: list[str], kinds: list[pa.DataType]) -> DataFrame:
    """src: id, text. Rows that a function makes of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            rows = [r for key, t in zip(batch.column(0).to_pylist(), batch.column(1)) for r in fn(key, t.as_py() or "")]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    return src.mapInArrow(run, schema)


def tokens(docs: DataFrame, tokenizer_file: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): all ids of each document with the end id, as little-endian unsigned 32-bit bytes."""
    return _pieces(docs, tokenizer_file, end_id, None, id_col, text_col)


def pieces(docs: DataFrame, tokenizer_file: str, end_id: int = 0, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32) for each piece of each document."""
    return _pieces(docs, tokenizer_file, end_id, capacity, id_col, text_col)


def _pieces(docs, tokenizer_file, end_id, capacity, id_col, text_col):
    with open(tokenizer_file, encoding="utf-8") as f:
        content = f.read()
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = src.schema["id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    end = np.array([end_id], "<u4").tobytes()

    def make():
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = WordTokenizer(content)

        def fn(key, text):
            ids = tokenizer.encode(text) + end
            if capacity is None:
                yield key, ids
                return
            step = 4 * capacity
            for i, at in enumerate(range(0, len(ids), step)):
                part = ids[at : at + step]
                yield key, i, at // 4, len(part) // 4, zlib.crc32(part)

        return fn

    if capacity is None:
        return _flat_map(src, make, f"id {kind.simpleString()}, ids binary", ["id", "ids"], [to_arrow_type(kind), pa.binary()])
    names = ["id", "piece", "start", "length", "ids_crc32"]
    schema = f"id {kind.simpleString()}, piece int, start long, length long, ids_crc32 long"
    return _flat_map(src, make, schema, names, [to_arrow_type(kind), pa.int32(), pa.int64(), pa.int64(), pa.int64()])


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: lists of places in ``sizes``, one a bin, in order of opening.

    Bins stand in stacks by room left; the bits of a number say which stacks hold any, so the tightest
    fit is its lowest set bit from the item's size on.
    """
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    there = 0
    bins: list[list[int]] = []
    for i in order:
        size = sizes[i]
        fit = there >> size
        if fit:
            room = size + (fit & -fit).bit_length() - 1
            b = stacks[room].pop()
            if not stacks[room]:
                there ^= 1 << room
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        room -= size
        if not stacks[room]:
            there |= 1 << room
        stacks[room].append(b)
    return bins


_ITEM = "size long, members array<struct<id:{id},piece:int,start:long,length:long,ids_crc32:long>>"


def _packer(capacity: int, last: bool) -> Callable[[pa.Table], pa.Table]:
    """A function that packs a group's items; of the last round all bins are set aside."""

    def local(t: pa.Table) -> pa.Table:
        members = t.column("members").combine_chunks()
        starts = np.asarray(members.offsets)
        heads = members.flatten().take(pa.array(starts[:-1] - starts[0]))  # the first piece of each item names it
        keys = list(zip(heads.field("id").to_pylist(), heads.field("piece").to_pylist()))
        t = t.take(pa.array(sorted(range(len(keys)), key=lambda i: (*((False,) if keys[i][0] is None else (True, keys[i][0])), keys[i][1])), pa.int64()))
        sizes, members = t.column("size").to_pylist(), t.column("members").combine_chunks()
        bins = best_fit(sizes, capacity)
        order = [i for b in bins for i in b]
        flat = members.take(pa.array(order, pa.int64()))
        ends = np.cumsum([0] + [len(b) for b in bins])
        offsets = np.asarray(flat.offsets)[ends]  # members of a bin's items stand side by side
        merged = pa.ListArray.from_arrays(pa.array(offsets - offsets[0], pa.int32()), flat.flatten())
        size = np.array([sum(sizes[i] for i in b) for b in bins], np.int64)
        return pa.table({"size": size, "members": merged, "full": pa.array(last | (size >= capacity - int(capacity * SLACK)))})

    return local


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``parts`` (id, piece, start, length, ids_crc32) with sequence_id and offset (place in the sequence)."""
    kind = parts.schema["id"].dataType.simpleString()
    item = _ITEM.format(id=kind)
    parts = cut(parts)
    member = F.struct("id", "piece", "start", "length", "ids_crc32")
    full = parts.where(F.col("length") >= capacity).select(F.col("length").alias("size"), F.array(member).alias("members"))
    left = parts.where(F.col("length") < capacity).select(F.col("length").alias("size"), F.array(member).alias("members"))
    n = left.count()
    groups = max(1, -(-n // GROUP))
    done = [full]
    level = 0
    while n:
        local = _packer(capacity, groups == 1)
        first = F.col("members")[0]
        dealt = left.withColumn("group", F.pmod(F.xxhash64(first["id"], first["piece"], F.lit(level)), F.lit(groups)))
        packed = cut(dealt.groupBy("group").applyInArrow(local, f"{item}, full boolean"))
        done.append(packed.where("full").drop("full"))
        left = packed.where("NOT full").drop("full")
        before, n = n, left.count()
        if n and level and n > 0.98 * before:  # what is left hardly fits together
            done.append(left)
            break
        groups = max(1, min(-(-groups // FAN_IN), -(-n // GROUP))) if n <= GROUP * FAN_IN else max(1, -(-n // GROUP))
        level += 1
    whole = done[0]
    for d in done[1:]:
        whole = whole.unionByName(d)
    numbered = cut(whole).withColumn("sequence_id", F.monotonically_increasing_id())
    place = F.expr("transform(members, (m, i) -> struct(m, aggregate(slice(members, 1, i), 0L, (s, x) -> s + x.length) AS offset))")
    each = numbered.select("sequence_id", F.explode(place).alias("x"))
    return each.select("x.m.id", "x.m.piece", "x.m.start", "x.m.length", "x.m.ids_crc32", "sequence_id", F.col("x.offset").alias("offset"))


def pack_documents(
    docs: DataFrame, tokenizer_file: str, end_id: int = 0, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) for each piece of each document."""
    packed = pack(pieces(docs, tokenizer_file, end_id, capacity, id_col, text_col), capacity)
    return packed.withColumnRenamed("id", id_col)


def sequences(tokenized: DataFrame, packed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves, ids as little-endian unsigned 32-bit bytes.

    ``tokenized`` is from :func:`tokens`; rows must be told apart by their id. At most a capacity of ids meets in a row.
    """
    part = F.expr("substring(ids, int(4 * start + 1), int(4 * length))")
    each = packed.withColumnRenamed(id_col, "id").join(tokenized, "id").select("sequence_id", "offset", part.alias("part"))
    ordered = F.array_sort(F.collect_list(F.struct("offset", "part")))
    return each.groupBy("sequence_id").agg(ordered.alias("p")).select("sequence_id", F.expr("aggregate(p, X'', (s, x) -> concat(s, x.part))").alias("ids"))
