"""Distribution functions as Column expressions (no Python per row)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def erfc(x: Column) -> Column:
    """Complementary error function: the Maclaurin series of erf below 2, the
    continued fraction exp(-x^2) / sqrt(pi) / (x + (1/2)/(x + 1/(x + (3/2)/(x + ...))))
    beyond; erfc(-x) = 2 - erfc(x)."""
    z = F.abs(x)
    start = F.struct(z.alias("term"), z.alias("total"))
    series = F.aggregate(F.sequence(F.lit(1), F.lit(60)), start, lambda s, k: F.struct(
        (-s["term"] * z * z / k).alias("term"),
        (s["total"] - s["term"] * z * z / k / (2 * k + 1)).alias("total")), lambda s: s["total"])
    tail = F.aggregate(F.sequence(F.lit(80), F.lit(1), F.lit(-1)), F.lit(0.0), lambda s, k: (k / 2.0) / (z + s))
    ans = F.when(z < 2, F.lit(1.0) - F.lit(2 / math.sqrt(math.pi)) * series).otherwise(
        F.exp(-z * z) / F.lit(math.sqrt(math.pi)) / (z + tail))
    return F.when(x >= 0, ans).otherwise(F.lit(2.0) - ans)


def norm_sf(z: Column) -> Column:
    """P(Z > z) for a standard normal."""
    return F.lit(0.5) * erfc(z / F.lit(2.0 ** 0.5))


def kolmogorov_sf(lam: Column, terms: int = 40) -> Column:
    """Kolmogorov's Q(lambda), in [0, 1]; 1 for lambda <= 0. Below 1 the theta
    form 1 - sqrt(2 pi) / lambda sum exp(-(2k-1)^2 pi^2 / (8 lambda^2)) converges
    at once, from 1 on 2 sum (-1)^(k-1) exp(-2 k^2 lambda^2) does."""
    ks = F.sequence(F.lit(1), F.lit(terms))
    far = F.lit(2.0) * F.aggregate(ks, F.lit(0.0), lambda s, k: s + F.when(k % 2 == 1, 1.0).otherwise(-1.0)
                                   * F.exp(F.lit(-2.0) * k * k * lam * lam))
    near = F.lit(1.0) - F.lit(math.sqrt(2 * math.pi)) / lam * F.aggregate(ks, F.lit(0.0), lambda s, k: s + F.exp(
        F.lit(-math.pi ** 2 / 8) * (2 * k - 1) * (2 * k - 1) / (lam * lam)))
    return F.when(lam <= 0, F.lit(1.0)).when(lam < 1, F.least(F.greatest(near, F.lit(0.0)), F.lit(1.0))).otherwise(
        F.least(F.greatest(far, F.lit(0.0)), F.lit(1.0)))


def erfc_sql(x: str) -> str:
    """erfc for the DuckDB oracle by other means: Simpson's rule over the next 8 units."""
    h = 0.002
    points = 4001
    rule = f"CASE WHEN k = 0 OR k = {points - 1} THEN 1.0e0 WHEN k % 2 = 1 THEN 4.0e0 ELSE 2.0e0 END"
    ans = (f"(2.0e0 / sqrt(pi()) * {h}e0 / 3 * (SELECT sum({rule} * exp(-(abs({x}) + k * {h}e0) * (abs({x}) + k * {h}e0))) "
           f"FROM range({points}) r(k)))")
    return f"(CASE WHEN {x} >= 0 THEN {ans} ELSE 2.0 - {ans} END)"


def kolmogorov_sf_sql(lam: str, terms: int = 3000) -> str:
    """Q for the oracle: the alternating series alone, with terms enough for lambda >= 0.05."""
    s = (f"(SELECT sum(CASE WHEN k % 2 = 1 THEN 1.0e0 ELSE -1.0e0 END * exp(-2.0e0 * k * k * ({lam}) * ({lam}))) "
         f"FROM range(1, {terms + 1}) r(k))")
    return f"(CASE WHEN {lam} < 0.05 THEN 1.0 ELSE least(greatest(2.0 * {s}, 0.0), 1.0) END)"
