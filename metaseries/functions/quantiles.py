"""Normal and Student quantiles, on the driver and as column expressions."""

from __future__ import annotations

import math
from functools import lru_cache
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Degrees of freedom up to which quantiles are looked up; beyond, an expansion is exact to 1e-8.
LOOKED_UP = 60


def normal_quantile(p: float) -> float:
    return NormalDist().inv_cdf(p)


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the regularised incomplete beta function."""
    tiny = 1e-300
    c, d = 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d or tiny)
    out = d
    for m in range(1, 300):
        for top in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / ((1 + top * d) or tiny)
            c = (1 + top / c) or tiny
            out *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return out


def beta_regularised(a: float, b: float, x: float) -> float:
    if x <= 0 or x >= 1:
        return float(x >= 1)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    return front * _beta_fraction(a, b, x) / a if x < (a + 1) / (a + b + 2) else 1 - front * _beta_fraction(b, a, 1 - x) / b


def student_cdf(t: float, df: float) -> float:
    tail = 0.5 * beta_regularised(df / 2, 0.5, df / (df + t * t))
    return 1 - tail if t > 0 else tail


@lru_cache(maxsize=4096)
def student_quantile(p: float, df: int) -> float:
    """By bisection, for p over 0.5."""
    low, high = 0.0, 1.0
    while student_cdf(high, df) < p:
        high *= 2
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if student_cdf(mid, df) < p else (low, mid)
    return (low + high) / 2


def _terms(p: float) -> list[float]:
    """Coefficients of the expansion of a Student quantile in powers of 1 / df."""
    z = normal_quantile(p)
    return [
        z,
        (z**3 + z) / 4,
        (5 * z**5 + 16 * z**3 + 3 * z) / 96,
        (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384,
        (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160,
    ]


def student_column(df: Column, p: float = 0.975) -> Column:
    """The quantile for an integer column of degrees of freedom; null under 1."""
    held = F.array(*[F.lit(student_quantile(p, i)) for i in range(1, LOOKED_UP + 1)])
    far = sum((F.lit(c) / F.pow(df.cast("double"), F.lit(float(i))) for i, c in enumerate(_terms(p)) if i), F.lit(_terms(p)[0]))
    return F.when(df < 1, None).when(df <= LOOKED_UP, F.element_at(held, F.greatest(df.cast("int"), F.lit(1)))).otherwise(far)


def student_sql(df: str, p: float = 0.975) -> str:
    held = ", ".join(f"CAST({student_quantile(p, i)!r} AS DOUBLE)" for i in range(1, LOOKED_UP + 1))
    far = " + ".join(f"CAST({c!r} AS DOUBLE) / pow(CAST({df} AS DOUBLE), {i})" for i, c in enumerate(_terms(p)))
    return f"CASE WHEN {df} < 1 THEN NULL WHEN {df} <= {LOOKED_UP} THEN list_extract([{held}], CAST({df} AS INTEGER)) ELSE {far} END"
