"""Upper-tail probabilities Spark has no built-in for. They run on one row per group, as Arrow batches."""
from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _each(fn, x):
    """fn of every element. Nothing is kept at module level: ufuncs made from Python functions can't be pickled."""
    return np.array([fn(v) for v in np.ravel(x)], dtype=float).reshape(np.shape(x))


def _lgamma(x):
    return _each(math.lgamma, x)


def _erfc(x):
    return _each(math.erfc, x)


def beta_inc(a, b, x):
    """Regularised incomplete beta I_x(a, b) by the modified Lentz continued fraction, elementwise."""
    a, b, x = np.broadcast_arrays(*(np.asarray(v, float) for v in (a, b, x)))
    swap = x > (a + 1) / (a + b + 2)
    p, q, z = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1 - x, x)
    tiny = 1e-300
    with np.errstate(all="ignore"):
        front = np.exp(_lgamma(p + q) - _lgamma(p) - _lgamma(q)
                       + p * np.log(np.maximum(z, tiny)) + q * np.log1p(-z)) / p
        d = 1 - (p + q) * z / (p + 1)
        d = 1 / np.where(np.abs(d) < tiny, tiny, d)
        c, frac = np.ones_like(d), d.copy()
        for m in range(1, 500):
            for num in (m * (q - m) * z / ((p + 2 * m - 1) * (p + 2 * m)),
                        -(p + m) * (p + q + m) * z / ((p + 2 * m) * (p + 2 * m + 1))):
                d = 1 + num * d
                d = 1 / np.where(np.abs(d) < tiny, tiny, d)
                c = 1 + num / c
                c = np.where(np.abs(c) < tiny, tiny, c)
                frac = frac * d * c
            if np.all(np.abs(d * c - 1) < 1e-15):
                break
        out = np.where(z <= 0, 0.0, front * frac)
    return np.where(swap, 1 - out, out)


def t_tail(t, dof):
    """Two-sided Student-t p-value; NaN where t or dof is undefined."""
    t, dof = np.asarray(t, float), np.asarray(dof, float)
    ok = np.isfinite(t) & (dof > 0)
    safe_t, safe_dof = np.where(ok, t, 0.0), np.where(ok, dof, 1.0)
    return np.where(ok, beta_inc(safe_dof / 2, 0.5, safe_dof / (safe_dof + safe_t ** 2)), np.nan)


def chi2_1_tail(x):
    """Upper tail of the chi-square distribution with one degree of freedom."""
    x = np.asarray(x, float)
    ok = np.isfinite(x) & (x >= 0)
    return np.where(ok, _erfc(np.sqrt(np.where(ok, x, 0.0) / 2)), np.nan)


@F.pandas_udf(DoubleType())
def student_t_p(t: pd.Series, dof: pd.Series) -> pd.Series:
    p = pd.Series(t_tail(t.to_numpy(float), dof.to_numpy(float)))
    return p.where(p.notna(), None)


@F.pandas_udf(DoubleType())
def chi2_1_p(x: pd.Series) -> pd.Series:
    p = pd.Series(chi2_1_tail(x.to_numpy(float)))
    return p.where(p.notna(), None)
