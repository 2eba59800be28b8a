"""Jaro-Winkler similarity, the one function Spark has no built-in for.

Arrow batches reach a vectorised numpy routine: for each position of the left
string it resolves that position for *all* pairs of the batch at once, so there
is no Python loop over rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the published method: prefix length, prefix weight and the
# Jaro score above which the prefix counts.
PREFIX_LENGTH = 4
PREFIX_WEIGHT = 0.1
PREFIX_FLOOR = 0.7

_MAX_CELLS = 1 << 21  # bounds the width x rows matrices of one step


def _code_points(texts: list[str], lengths: np.ndarray) -> np.ndarray:
    """One row of code points per text, padded with zeros."""
    inside = np.arange(lengths.max()) < lengths[:, None]
    codes = np.zeros(inside.shape, dtype=np.int32)
    codes[inside] = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.int32)
    return codes


def _jaro_winkler_block(left: list[str], right: list[str]) -> np.ndarray:
    """Similarity of aligned, non-empty strings."""
    n = len(left)
    len_a = np.fromiter(map(len, left), dtype=np.int64, count=n)
    len_b = np.fromiter(map(len, right), dtype=np.int64, count=n)
    a = _code_points(left, len_a)
    b = _code_points(right, len_b)
    reach = np.maximum(np.maximum(len_a, len_b) // 2 - 1, 0)
    pos_b = np.arange(b.shape[1])
    free = pos_b[None, :] < len_b[:, None]
    hit_a = np.zeros(a.shape, dtype=bool)
    hit_b = np.zeros(b.shape, dtype=bool)
    rows = np.arange(n)
    for i in range(a.shape[1]):
        candidates = free & (b == a[:, i : i + 1]) & (np.abs(pos_b - i)[None, :] <= reach[:, None])
        first = candidates.argmax(axis=1)
        found = candidates[rows, first] & (i < len_a)
        hit_a[found, i] = True
        hit_b[rows[found], first[found]] = True
        free[rows[found], first[found]] = False
    common = hit_a.sum(axis=1)

    # Both hit lists have the same length per row, so row-major order aligns them.
    owner = np.nonzero(hit_a)[0]
    swapped = a[hit_a] != b[hit_b]
    halves = np.bincount(owner[swapped], minlength=n) // 2

    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = np.where(common > 0, (common / len_a + common / len_b + (common - halves) / common) / 3.0, 0.0)
    span = min(PREFIX_LENGTH, a.shape[1], b.shape[1])
    same = (a[:, :span] == b[:, :span]) & (np.arange(span) < np.minimum(len_a, len_b)[:, None])
    prefix = np.cumprod(same, axis=1).sum(axis=1)
    return np.where(jaro > PREFIX_FLOOR, jaro + prefix * PREFIX_WEIGHT * (1.0 - jaro), jaro)


def jaro_winkler_array(left: pd.Series, right: pd.Series) -> pd.Series:
    """Similarity per pair: null if either is null, 0 if either is empty."""
    out = np.full(len(left), np.nan)
    known = (left.notna() & right.notna()).to_numpy()
    a = left.to_numpy(dtype=object)
    b = right.to_numpy(dtype=object)
    equal = known & (a == b)
    out[known] = 0.0
    out[equal] = [1.0 if text else 0.0 for text in a[equal]]
    todo = [i for i in np.nonzero(known & ~equal)[0] if a[i] and b[i]]
    todo.sort(key=lambda i: max(len(a[i]), len(b[i])))  # like lengths share a block
    start = 0
    while start < len(todo):
        # Blocks grow until the padded matrix would pass the cell limit.
        stop = start + 1
        while stop < len(todo):
            width = max(len(a[todo[stop]]), len(b[todo[stop]]))
            if (stop - start + 1) * width > _MAX_CELLS:
                break
            stop += 1
        block = todo[start:stop]
        out[block] = _jaro_winkler_block([a[i] for i in block], [b[i] for i in block])
        start = stop
    return pd.Series(out)


@F.pandas_udf(T.DoubleType())
def jaro_winkler(left: pd.Series, right: pd.Series) -> pd.Series:
    values = jaro_winkler_array(left, right)
    return values.astype(object).where(values.notna(), None)
