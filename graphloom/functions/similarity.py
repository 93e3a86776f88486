"""Similarity of strings by matching blocks, as a vectorised function."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _ratio(a: str | None, b: str | None) -> float:
    return SequenceMatcher(None, a, b).ratio() if a and b else 0.0


def ratio(a: Column, b: Column) -> Column:
    """Ratcliff-Obershelp ratio of two strings, 0 where one is null or empty. Not an edit distance."""

    @F.pandas_udf("double")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([_ratio(p, q) for p, q in zip(x, y)])

    return run(a, b)
