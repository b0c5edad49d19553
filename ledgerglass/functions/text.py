"""Token-sorted string similarity."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F, types as T


def token_sorted(value) -> Column:
    """Whitespace tokens in sorted order, joined by single blanks."""
    value = F.col(value) if isinstance(value, str) else value
    tokens = F.filter(F.split(value, r"\s+"), lambda t: t != "")
    return F.array_join(F.array_sort(tokens), " ")


def _codes(texts: list[str]) -> np.ndarray:
    """Texts as rows of code points, padded on the right with 0."""
    width = max(1, max((len(t) for t in texts), default=1))
    out = np.zeros((len(texts), width), dtype=np.uint32)
    for i, t in enumerate(texts):
        out[i, : len(t)] = np.frombuffer(t.encode("utf-32-le"), dtype=np.uint32)
    return out


@F.pandas_udf(T.IntegerType())
def lcs_length(a: pd.Series, b: pd.Series) -> pd.Series:
    """Length of the longest common subsequence, one table row at a time for a whole batch."""
    left, right = _codes(a.tolist()), _codes(b.tolist())
    best = np.zeros((len(a), right.shape[1] + 1), dtype=np.int32)
    for i in range(left.shape[1]):
        char = left[:, i : i + 1]
        hit = (char == right) & (char != 0)
        np.maximum(best[:, 1:], np.where(hit, best[:, :-1] + 1, 0), out=best[:, 1:])
        np.maximum.accumulate(best, axis=1, out=best)
    return pd.Series(best[:, -1])


def similarity(a, b) -> Column:
    """Indel similarity 0-100 of two texts: ``200 * LCS / (len(a) + len(b))``."""
    total = F.length(a) + F.length(b)
    return F.when(total > 0, 200.0 * lcs_length(a, b) / total).otherwise(100.0)
