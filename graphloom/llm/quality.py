"""Quality rules as a bitmask ledger.

Every rule is evaluated once a document; the ledger keeps its measurements and one failure bit a rule.
A policy is a named, versioned mask over those bits, so verdicts under any policy, and what a rule
contributes (ablation), come from the ledger by bitwise arithmetic alone, without the texts.

Defined cases: a null or empty text has no words and fails ``few_words``; repeated rows are measured
each for itself; an empty table gives an empty ledger; further columns don't matter.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_BREAK, map_texts, words

#: Rules in the order of their bits: name, condition of failure over the measurements of a row.
RULES = (
    ("few_words", lambda m: m["n_words"] < 20),
    ("repeated_words", lambda m: 100 * m["n_repeat_words"] > 30 * m["n_words"]),
    ("symbols", lambda m: 10 * m["n_symbols"] > 3 * m["n_words"]),
    ("shouting", lambda m: m["n_words"] > 0 and 2 * m["n_upper_words"] > m["n_words"]),
    ("duplicate_lines", lambda m: 2 * m["n_dup_lines"] > m["n_lines"]),
    ("word_length", lambda m: m["n_words"] > 0 and not 2 <= m["word_chars"] / m["n_words"] <= 14),
    ("few_letters", lambda m: 2 * m["n_letter_words"] < m["n_words"]),
    ("stuttering", lambda m: 10 * m["n_stutters"] > 3 * m["n_words"]),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper_words", "n_letter_words", "n_stutters")


@dataclass(frozen=True)
class Policy:
    """Rules whose failure rejects a document."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_words"))
STRICT = Policy("strict", 1, tuple(BIT))
POLICIES = (BASE, STRICT)


def repeated_window_words(ws: list[str], n: int = 8) -> int:
    """Words that lie in an n-word window found twice or more in the list.

    Windows get exact ids: words are numbered, then ids of adjacent parts are paired and renumbered
    until the parts add up to n words, so equal ids mean equal windows.
    """
    if len(ws) <= n or len(set(ws)) == len(ws):
        return 0
    number: dict[str, int] = {}
    part = np.array([number.setdefault(w, len(number)) for w in ws], np.int64)

    def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        k = min(len(a), len(b))
        return np.unique(a[:k] * (int(b.max()) + 1) + b[:k], return_inverse=True)[1]

    whole, at, size, left = None, 0, 1, n
    while left:
        if left & 1:
            whole, at = (part, size) if whole is None else (pair(whole, part[at:]), at + size)
        left >>= 1
        if left:
            part, size = pair(part, part[size:]), size * 2
    again = np.flatnonzero(np.bincount(whole)[whole] > 1)
    edge = np.zeros(len(ws) + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + n, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def measure(text: str) -> dict[str, int]:
    ws = words(text)
    lines = [x for x in text.split("\n") if WORD_BREAK.sub("", x)]
    return {
        "n_words": len(ws),
        "word_chars": sum(map(len, ws)),
        "n_symbols": sum(map(text.count, "#*$%&|<>")),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": repeated_window_words(ws),
        "n_upper_words": sum(len(w) > 1 and w.isupper() for w in ws),
        "n_letter_words": sum(any(map(str.isalpha, w)) for w in ws),
        "n_stutters": sum(map(str.__eq__, ws, ws[1:])),
    }


def fail_bits(m: dict[str, int]) -> int:
    return sum(BIT[name] for name, failed in RULES if failed(m))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: its id, the measurements and ``fail_bits``. One pass, no shuffle."""

    def make():
        def row(text: str) -> tuple:
            m = measure(text)
            return (*(m[k] for k in MEASURES), fail_bits(m))

        return row

    return map_texts(docs, make, [*((k, "long") for k in MEASURES), ("fail_bits", "long")], text_col, [id_col])


def failed(policy: Policy) -> Column:
    """Whether a ledger's row fails any rule of the policy."""
    return F.col("fail_bits").bitwiseAND(F.lit(policy.mask)) != 0


def keep_passing(docs: DataFrame, policy: Policy = STRICT, text_col: str = "text") -> DataFrame:
    """The documents that pass, with their columns as they were."""

    def make():
        return lambda text: (not fail_bits(measure(text)) & policy.mask,)

    return map_texts(docs, make, [("kept", "boolean")], text_col, where=0)


def ablation(led: DataFrame, policies: tuple[Policy, ...] = POLICIES) -> DataFrame:
    """A row for each policy and rule in it: documents that fail the rule, and that it alone rejects.

    Rows are first counted by bit pattern (as many as 2 to the number of rules), so what follows is small.
    """
    patterns = led.groupBy("fail_bits").agg(F.count("*").alias("n"))
    rows = [(p.name, p.version, r, p.mask, BIT[r]) for p in policies for r in p.rules]
    rules = led.sparkSession.createDataFrame(rows, "policy string, version int, rule string, mask long, bit long")
    bits = F.col("fail_bits").bitwiseAND(F.col("mask"))
    hit = F.when(bits.bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)
    alone = F.when(bits == F.col("bit"), F.col("n")).otherwise(0)
    return (
        rules.join(patterns, bits.bitwiseAND(F.col("bit")) != 0, "left")
        .groupBy("policy", "version", "rule")
        .agg(F.sum(F.coalesce(hit, F.lit(0))).alias("n_failed"), F.sum(F.coalesce(alone, F.lit(0))).alias("n_alone"))
    )
