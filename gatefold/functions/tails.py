"""Upper tails of the normal, chi-square, t and F distributions, as scalars and as Arrow-batched columns.

Only small per-test tables reach these functions: statistics themselves are computed by Spark.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def _gamma_q(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function."""
    if x <= 0:
        return 1.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:  # series of the lower function
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1
            term *= x / n
            total += term
        return 1.0 - front * total
    tiny = 1e-300  # continued fraction, by Lentz
    b = x + 1 - a
    c, d = 1 / tiny, 1 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1 / (d if abs(d) > tiny else tiny)
        c = b + an / c
        c = c if abs(c) > tiny else tiny
        step = c * d
        h *= step
        if abs(step - 1) < 1e-15:
            break
    return front * h


def chi2_sf(x: float, df: float) -> float:
    return _gamma_q(df / 2, x / 2)


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1.0 - beta_inc(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny = 1e-300
    c, d = 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 10_000):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + num * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + num / c
            c = c if abs(c) > tiny else tiny
            step = c * d
            h *= step
        if abs(step - 1) < 1e-15:
            break
    return front * h


def f_sf(x: float, d1: float, d2: float) -> float:
    return 1.0 if x <= 0 else beta_inc(d2 / 2, d1 / 2, d2 / (d2 + d1 * x))


def t_two_sided(t: float, df: float) -> float:
    return beta_inc(df / 2, 0.5, df / (df + t * t))


def _safe(f, *args: float) -> float | None:
    if any(a is None or not math.isfinite(a) for a in args):
        return None
    return f(*args)


def p_normal(z: Column) -> Column:
    @F.pandas_udf("double")
    def p(z: pd.Series) -> pd.Series:
        return z.map(lambda v: _safe(normal_two_sided, v)).astype(float)

    return p(z)


def p_chi2(x: Column, df: Column) -> Column:
    @F.pandas_udf("double")
    def p(x: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series([_safe(chi2_sf, a, b) if b and b > 0 else None for a, b in zip(x, d, strict=True)], dtype=float)

    return p(x.cast("double"), df.cast("double"))


def p_t(t: Column, df: Column) -> Column:
    @F.pandas_udf("double")
    def p(t: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series([_safe(t_two_sided, a, b) if b and b > 0 else None for a, b in zip(t, d, strict=True)], dtype=float)

    return p(t.cast("double"), df.cast("double"))


def normal_tail_expr(z: Column) -> Column:
    """Two-sided normal p by the five-term rational approximation (error below 1.5e-7), in the engine."""
    a = F.abs(z) / math.sqrt(2.0)
    t = 1.0 / (1.0 + 0.3275911 * a)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return poly * F.exp(-a * a)
