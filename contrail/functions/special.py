"""Distribution tails for test statistics (no SciPy here).

Only the final p-value of a test, one value, goes through these in a pandas UDF; the
statistics themselves are Spark aggregations. Formulas: NIST Digital Library of
Mathematical Functions, 8.4.10 and 8.4.15 (chi-square, finite sums), 8.17.8 (beta
series) and 8.17.4 (its reflection).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf


def chi2_sf(stat: float, dof: float) -> float:
    """P(X >= stat) for X ~ chi-square with a whole number of degrees of freedom."""
    if stat is None or dof is None or dof <= 0 or math.isnan(stat):
        return float("nan")
    if stat <= 0:
        return 1.0
    y, n = stat / 2, int(dof)
    odd = n % 2
    # the sum runs over y^k / Gamma(k + 1) for k = n/2 - 1, n/2 - 2, ... down to 0 or 1/2
    terms = [math.exp(k * math.log(y) - y - math.lgamma(k + 1)) for k in (i + odd / 2 for i in range(n // 2))]
    return min(1.0, math.fsum(terms) + (math.erfc(math.sqrt(y)) if odd else 0.0))


def beta_i(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    if x > a / (a + b):  # the series converges fast below the mean
        return 1 - beta_i(b, a, 1 - x)
    scale = a * math.log(x) + b * math.log1p(-x) - math.log(a) + math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    term = total = 1.0
    k = 0
    while term > total * 1e-17:
        term *= (a + b + k) / (a + 1 + k) * x
        total += term
        k += 1
    return min(1.0, math.exp(scale) * total)


def f_sf(f: float, d1: float, d2: float) -> float:
    """P(X >= f) for X ~ F(d1, d2)."""
    if f is None or d1 is None or d2 is None or d1 <= 0 or d2 <= 0 or math.isnan(f):
        return float("nan")
    if f <= 0:
        return 1.0
    return beta_i(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


@pandas_udf(T.DoubleType())
def _chi2_sf_udf(stat: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series(np.vectorize(chi2_sf, otypes=[float])(stat.astype(float), dof.astype(float)))


@pandas_udf(T.DoubleType())
def _f_sf_udf(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return pd.Series(np.vectorize(f_sf, otypes=[float])(f.astype(float), d1.astype(float), d2.astype(float)))


def chi2_pvalue(stat: Column, dof: Column) -> Column:
    return _chi2_sf_udf(stat.cast("double"), dof.cast("double"))


def f_pvalue(f: Column, d1: Column, d2: Column) -> Column:
    return _f_sf_udf(f.cast("double"), d1.cast("double"), d2.cast("double"))
