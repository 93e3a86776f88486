"""Byte-level BPE by monoid tree reduction.

An element is the ids of a stretch of text encoded on its own. Encoding halves a text down to short leaves
and joins neighbours. A join re-encodes only a window about the seam: to its left back to a place x, to its
right on to a place y, where a white space character follows one that is none. No alternative of the split
pattern crosses such a place, and what matches before it is decided by the characters up to it, so it
parts two matches whatever stands further off: tokens before x and from y on are the same in either half
and in the whole. The window grows, doubling, until it holds such places or a half ends. Decoding maps ids
to bytes and concatenates up the same tree.

Defined cases: a null or empty text has no ids; repeated rows are encoded each for itself; an empty table
gives an empty result; further columns don't matter; text of any length is encoded whole.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
from pyspark.sql import DataFrame

from .common import map_texts

#: Characters of a leaf: short, so that ordinary documents are joined from several.
LEAF = 512


def _parts(text: str, at: int) -> bool:
    return text[at] in " \n" and not text[at - 1].isspace()


def _before(text: str, start: int, seam: int) -> int:
    """The last place in (start, seam) that parts matches for certain, or start."""
    reach = 64
    while True:
        low = max(start, seam - reach)
        for at in range(seam - 1, low, -1):
            if _parts(text, at):
                return at
        if low == start:
            return start
        reach *= 2


def _after(text: str, seam: int, stop: int) -> int:
    """The first place in (seam, stop) that parts matches for certain, or stop."""
    reach = 64
    while True:
        high = min(stop, seam + reach)
        for at in range(seam + 1, high):
            if _parts(text, at):
                return at
        if high == stop:
            return stop
        reach *= 2


class TreeBPE:
    """Encoder and decoder over a rank file's contents and a split pattern."""

    def __init__(self, rank_file: bytes, pattern: str, leaf: int = LEAF):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in rank_file.splitlines() if line)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.plain = self.encoding.encode_ordinary
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.leaf = max(2, leaf)

    def encode(self, text: str) -> list[int]:
        return self._encode(text, 0, len(text))

    def _encode(self, text: str, start: int, stop: int) -> list[int]:
        if stop - start <= self.leaf:
            return self.plain(text[start:stop])
        seam = (start + stop) // 2
        return self.join(text, start, seam, stop, self._encode(text, start, seam), self._encode(text, seam, stop))

    def join(self, text: str, start: int, seam: int, stop: int, left: list[int], right: list[int]) -> list[int]:
        """The ids of text[start:stop] from those of its parts at the seam, each encoded on its own."""
        x, y = _before(text, start, seam), _after(text, seam, stop)
        kept = left[: len(left) - len(self.plain(text[x:seam]))] if x > start else []
        rest = right[len(self.plain(text[seam:y])) :] if y < stop else []
        return kept + self.plain(text[x:y]) + rest

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= self.leaf:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


def encode_documents(
    docs: DataFrame, rank_file: str, pattern: str, text_col: str = "text", leaf: int = LEAF
) -> DataFrame:
    """The rows with ``ids`` (little-endian unsigned 32-bit, as binary) and ``decoded`` (binary).

    The rank file is read on the driver and travels with the function: its size does not depend on the data.
    """
    with open(rank_file, "rb") as f:
        content = f.read()

    def make():
        bpe = TreeBPE(content, pattern, leaf)

        def row(text: str) -> tuple:
            ids = bpe.encode(text)
            return np.array(ids, "<u4").tobytes(), bpe.decode(ids)

        return row

    return map_texts(docs, make, [("ids", "binary"), ("decoded", "binary")], text_col)


def digests(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): the digests are taken where the ids are made, to move less."""
    with open(rank_file, "rb") as f:
        content = f.read()

    def make():
        bpe = TreeBPE(content, pattern)

        def row(text: str) -> tuple:
            ids = bpe.encode(text)
            sha = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
            return len(ids), sha, hashlib.sha256(bpe.decode(ids)).hexdigest()

        return row

    return map_texts(docs, make, [("n_tokens", "long"), ("ids_sha256", "string"), ("decoded_sha256", "string")], text_col, [id_col])
