"""Tail probabilities that have no built-in Spark function.

Each takes one number per row and is evaluated on Arrow batches.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_erfc = np.vectorize(math.erfc, otypes=[float])
_lgamma = np.vectorize(math.lgamma, otypes=[float])


@F.pandas_udf(T.DoubleType())
def normal_tail(z: pd.Series) -> pd.Series:
    """P(Z > z)."""
    return pd.Series(0.5 * _erfc(z.to_numpy(dtype=float) / math.sqrt(2)))


@F.pandas_udf(T.DoubleType())
def normal_two_sided(z: pd.Series) -> pd.Series:
    """P(|Z| > |z|)."""
    return pd.Series(_erfc(np.abs(z.to_numpy(dtype=float)) / math.sqrt(2)))


def incomplete_beta(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta by its continued fraction, for arrays."""
    a, b, x = np.broadcast_arrays(*(np.asarray(v, dtype=float) for v in (a, b, x)))
    flip = x > (a + 1) / (a + b + 2)
    p, q, t = np.where(flip, b, a), np.where(flip, a, b), np.where(flip, 1 - x, x)
    with np.errstate(divide="ignore", invalid="ignore"):
        front = np.exp(
            _lgamma(p + q) - _lgamma(p) - _lgamma(q) + p * np.log(t) + q * np.log1p(-t)
        ) / p
    tiny = 1e-300
    c = np.ones_like(t)
    d = 1 - (p + q) * t / (p + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    value = d.copy()
    for m in range(1, 300):
        for step in (
            m * (q - m) * t / ((p + 2 * m - 1) * (p + 2 * m)),
            -(p + m) * (p + q + m) * t / ((p + 2 * m) * (p + 2 * m + 1)),
        ):
            d = 1 + step * d
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1 + step / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            change = d * c
            value = value * change
        if np.all(np.abs(change - 1) < 1e-14):
            break
    result = np.where((t <= 0), 0.0, front * value)
    return np.clip(np.where(flip, 1 - result, result), 0.0, 1.0)


@F.pandas_udf(T.DoubleType())
def student_two_sided(t: pd.Series, df: pd.Series) -> pd.Series:
    """P(|T| > |t|) with df degrees of freedom; NULL in, NULL out."""
    value = t.to_numpy(dtype=float)
    free = df.to_numpy(dtype=float)
    known = ~np.isnan(value) & (free > 0)
    safe = np.where(known, value, 0.0)
    dof = np.where(known, free, 1.0)
    with np.errstate(over="ignore", invalid="ignore"):
        x = np.where(np.isinf(safe), 0.0, dof / (dof + safe * safe))
    p = incomplete_beta(dof / 2, np.full_like(dof, 0.5), x)
    return pd.Series(np.where(known, p, np.nan)).astype(object).where(known, None)
