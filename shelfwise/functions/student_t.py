"""Student's t distribution for the few rows an aggregate leaves.

The two-sided tail probability uses the regularized incomplete beta function
(continued fraction) for small degrees of freedom and Hill's normalizing
transform (Communications of the ACM, Algorithm 395) from ``LARGE_DF`` on, where
log-gamma differences would lose digits. The quantile bisects on the tail.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Ship these functions with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LARGE_DF = 1000.0
_TINY = 1e-300


def _log_beta(a: np.ndarray, b: float) -> np.ndarray:
    return np.array([math.lgamma(x) + math.lgamma(b) - math.lgamma(x + b) for x in a])


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Continued fraction of the incomplete beta, evaluated front to back."""
    numer = np.ones_like(x)
    denom = 1.0 - (a + b) * x / (a + 1.0)
    denom = 1.0 / np.where(np.abs(denom) < _TINY, _TINY, denom)
    total = denom.copy()
    for m in range(1, 400):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        step = np.ones_like(x)
        for term in (even, odd):
            denom = 1.0 + term * denom
            denom = 1.0 / np.where(np.abs(denom) < _TINY, _TINY, denom)
            numer = 1.0 + term / numer
            numer = np.where(np.abs(numer) < _TINY, _TINY, numer)
            step = denom * numer
            total = total * step
        if np.all(np.abs(step - 1.0) < 1e-15):
            break
    return total


def _tail_small(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """P(|T| > t) as the incomplete beta at df / (df + t^2)."""
    a, b = df / 2.0, np.full_like(df, 0.5)
    x = df / (df + t * t)
    front = np.exp(a * np.log(x) + b * np.log1p(-x) - _log_beta(a, 0.5))
    lower = x < (a + 1.0) / (a + b + 2.0)
    direct = front * _beta_fraction(a, b, np.where(lower, x, 0.0)) / a
    mirrored = 1.0 - front * _beta_fraction(b, a, np.where(lower, 0.0, 1.0 - x)) / b
    return np.where(lower, direct, mirrored)


def _tail_large(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """P(|T| > t) through the equivalent normal deviate."""
    a = df - 0.5
    b = 48.0 * a * a
    z2 = a * np.log1p(t * t / df)
    z = np.sqrt(z2)
    top = ((4.0 * z2 + 33.0) * z2 + 240.0) * z2 + 855.0
    z = z * (1.0 + (z2 + 3.0) / b - top / (10.0 * b * (b + 0.8 * z2 * z2 + 100.0)))
    return np.array([math.erfc(v / math.sqrt(2.0)) for v in z])


def two_sided_p(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """P(|T| > |t|) for arrays; nan where an input is missing or df <= 0."""
    t, df = np.abs(np.asarray(t, dtype=float)), np.asarray(df, dtype=float)
    out = np.full(t.shape, np.nan)
    known = np.isfinite(df) & (df > 0) & ~np.isnan(t)
    out[known & np.isinf(t)] = 0.0
    out[known & (t == 0)] = 1.0
    rest = known & np.isfinite(t) & (t > 0)
    small, large = rest & (df < LARGE_DF), rest & (df >= LARGE_DF)
    if small.any():
        out[small] = _tail_small(t[small], df[small])
    if large.any():
        out[large] = _tail_large(t[large], df[large])
    return out


def critical_value(confidence: np.ndarray, df: np.ndarray) -> np.ndarray:
    """The t with P(|T| <= t) = confidence, by bisection."""
    alpha = 1.0 - np.asarray(confidence, dtype=float)
    df = np.asarray(df, dtype=float)
    out = np.full(df.shape, np.nan)
    known = np.isfinite(df) & (df > 0)
    if not known.any():
        return out
    alpha, df = alpha[known], df[known]
    low, high = np.zeros_like(df), np.ones_like(df)
    while (open_ := two_sided_p(high, df) > alpha).any():
        high = np.where(open_, high * 2.0, high)
    for _ in range(200):
        mid = (low + high) / 2.0
        above = two_sided_p(mid, df) > alpha
        low, high = np.where(above, mid, low), np.where(above, high, mid)
    out[known] = (low + high) / 2.0
    return out


@F.pandas_udf(DoubleType())
def _two_sided_p_udf(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(two_sided_p(t.to_numpy(), df.to_numpy()))


@F.pandas_udf(DoubleType())
def _critical_value_udf(confidence: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(critical_value(confidence.to_numpy(), df.to_numpy()))


def t_two_sided_p(t: Column, df: Column) -> Column:
    """Two-sided p-value; null where it is not defined."""
    return F.nanvl(_two_sided_p_udf(t.cast("double"), df.cast("double")), F.lit(None).cast("double"))


def t_critical(confidence: float, df: Column) -> Column:
    """Half-width factor of a two-sided interval; null where it is not defined."""
    return F.nanvl(
        _critical_value_udf(F.lit(float(confidence)), df.cast("double")), F.lit(None).cast("double")
    )
