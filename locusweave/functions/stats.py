"""Statistical functions: native expressions where one exists, one Arrow function otherwise."""

from __future__ import annotations

import math
import sys
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# The Arrow functions below travel with the query, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rational approximations of erfc on three ranges, W. J. Cody,
# "Rational Chebyshev approximations for the error function", Math. Comp. 23 (1969).
ERFC_A = (3.16112374387056560e00, 1.13864154151050156e02, 3.77485237685302021e02, 3.20937758913846947e03,
          1.85777706184603153e-1)
ERFC_B = (2.36012909523441209e01, 2.44024637934444173e02, 1.28261652607737228e03, 2.84423683343917062e03)
ERFC_C = (5.64188496988670089e-1, 8.88314979438837594e00, 6.61191906371416295e01, 2.98635138197400131e02,
          8.81952221241769090e02, 1.71204761263407058e03, 2.05107837782607147e03, 1.23033935479799725e03,
          2.15311535474403846e-8)
ERFC_D = (1.57449261107098347e01, 1.17693950891312499e02, 5.37181101862009858e02, 1.62138957456669019e03,
          3.29079923573345963e03, 4.36261909014324716e03, 3.43936767414372164e03, 1.23033935480374942e03)
ERFC_P = (3.05326634961232344e-1, 3.60344899949804439e-1, 1.25781726111229246e-1, 1.60837851487422766e-2,
          6.58749161529837803e-4, 1.63153871373020978e-2)
ERFC_Q = (2.56852019228982242e00, 1.87295284992346725e00, 5.27905102951428412e-1, 6.05183413124413191e-2,
          2.33520497626869185e-3)
ERFC_SMALL = 0.46875
ERFC_LARGE = 4.0


def _polynomial(lead: float, inner, last: float, x: str) -> str:
    text = f"({lead:.17e} * {x})"
    for coefficient in inner:
        text = f"(({text} + {coefficient:.17e}) * {x})"
    return f"({text} + {last:.17e})"


def _quotient(x: str, over: tuple, under: tuple, lead: int, last: int) -> str:
    return (
        f"{_polynomial(over[lead], over[:last], over[last], x)} / {_polynomial(1.0, under[:last], under[last], x)}"
    )


def chi2_sf(chi2: str) -> Column:
    """P(X > chi2) of the named column for one degree of freedom, ``erfc(sqrt(chi2 / 2))``, as a native expression.

    Built as one SQL text, which is parsed once instead of term by term.
    """
    s, y, z = f"(`{chi2}` / 2e0)", f"sqrt(`{chi2}` / 2e0)", f"(2e0 / `{chi2}`)"
    small = f"1e0 - {y} * ({_quotient(s, ERFC_A, ERFC_B, 4, 3)})"
    middle = f"exp(-{s}) * ({_quotient(y, ERFC_C, ERFC_D, 8, 7)})"
    large = f"exp(-{s}) * ({1 / math.sqrt(math.pi):.17e} - {z} * ({_quotient(z, ERFC_P, ERFC_Q, 5, 4)})) / {y}"
    return F.expr(
        f"CASE WHEN `{chi2}` <= 0 THEN 1e0 WHEN {y} <= {ERFC_SMALL:e} THEN {small} "
        f"WHEN {y} <= {ERFC_LARGE:e} THEN {middle} WHEN {y} > {ERFC_LARGE:e} THEN {large} END"
    )


def chi2_isf(p: float) -> float:
    """The chi-square value (one degree of freedom) exceeded with probability ``p``; a driver scalar."""
    return NormalDist().inv_cdf(p / 2.0) ** 2


@F.pandas_udf(DoubleType())
def chi2_isf_column(p: pd.Series) -> pd.Series:
    """``chi2_isf`` for a handful of summary rows, one per phenotype."""
    return p.map(lambda v: None if pd.isna(v) else (math.inf if v <= 0 else 0.0 if v >= 1 else chi2_isf(v)))


def neg_log10_p(pval: Column, chi2: Column) -> Column:
    """-log10 p, from the leading terms of the tail where the p-value itself has become zero."""
    s = chi2 / 2.0
    tail = (s + 0.5 * F.log(math.pi * s) - F.log(1.0 - 1.0 / chi2)) / math.log(10.0)
    return F.when(pval > 0, -F.log10(pval)).when((pval == 0) & (chi2 > 1000), tail)


def ln_factorial(n: Column) -> Column:
    """ln n! by Stirling's series, shifted by eight so that it also holds for small n."""
    z = n + 9.0
    lower = n + 1.0
    product = lower
    for step in range(1, 8):
        product = product * (n + float(step + 1))
    inverse = 1.0 / z
    square = inverse * inverse
    series = inverse * (1 / 12 - square * (1 / 360 - square * (1 / 1260 - square * (1 / 1680 - square / 1188))))
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - F.log(product)


def _beta_fraction(a: np.ndarray, b: float, x: np.ndarray) -> np.ndarray:
    """Continued fraction of the incomplete beta function by Lentz's method, all rows at once."""
    tiny = 1e-300
    c = np.ones_like(x)
    d = 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, 2000 + int(5 * math.sqrt(np.max(np.maximum(a, b), initial=0.0)))):
        for numerator in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + numerator * d
            d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1.0 + numerator / np.where(np.abs(c) < tiny, tiny, c)
            step = c * d
            h = h * step
        if np.all(np.abs(step - 1.0) < 1e-15):
            return h
    # The loop needs about as many steps as the square root of the degrees of freedom.
    unsettled = np.abs(step - 1.0)
    if np.any(unsettled > 1e-12):
        raise ArithmeticError(f"the incomplete beta function did not converge; last relative change {unsettled.max():.1e}")
    return h


def student_t_two_sided(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """Two-sided Student-t p-value, I_x(df/2, 1/2) at x = df / (df + t^2); NaN where df < 1."""
    t, df = np.asarray(t, float), np.asarray(df, float)
    out = np.full(t.shape, np.nan)
    ok = np.isfinite(t) & (df >= 1)
    if not ok.any():
        return out
    a, t2 = df[ok] / 2.0, t[ok] ** 2
    x, y = df[ok] / (df[ok] + t2), t2 / (df[ok] + t2)
    values, where = np.unique(a, return_inverse=True)
    log_beta = np.array([math.lgamma(v) + math.lgamma(0.5) - math.lgamma(v + 0.5) for v in values])[where]
    with np.errstate(divide="ignore"):
        front = np.exp(a * np.log(x) + 0.5 * np.log(y) - log_beta)
    direct = x < (a + 1.0) / (a + 2.5)
    p = np.ones_like(x)
    if direct.any():
        p[direct] = front[direct] * _beta_fraction(a[direct], 0.5, x[direct]) / a[direct]
    other = ~direct & (y > 0)
    if other.any():
        half = np.full(other.sum(), 0.5)
        p[other] = 1.0 - front[other] * _beta_fraction(half, a[other], y[other]) / 0.5
    out[ok] = np.clip(p, 0.0, 1.0)
    return out


@F.pandas_udf(DoubleType())
def student_t_p(t: pd.Series, df: pd.Series) -> pd.Series:
    """Arrow-batched ``student_t_two_sided`` over already aggregated rows."""
    p = student_t_two_sided(t.to_numpy(float, na_value=np.nan), df.to_numpy(float, na_value=np.nan))
    return pd.Series(p).where(~np.isnan(p), None)
