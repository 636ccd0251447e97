"""Daily series operators (F-family) over ``(key?, d DATE, y DOUBLE)``.

Series are aggregates (one row per key and day), so a series has at most
one row per calendar day however large the input was. Windows below are
partitioned by the series key; a single global series is one partition of
at most a few thousand days. Positions come from ``datediff`` against the
series start (no global row numbering)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _w(key: str | None):
    return Window.partitionBy(key) if key else Window.partitionBy()


def with_position(series: DataFrame, d: str = "d", key: str | None = None) -> DataFrame:
    start = F.min(d).over(_w(key))
    return series.withColumn("i", F.datediff(F.col(d), start))


def interpolate_linear(series: DataFrame, d: str = "d", y: str = "y", key: str | None = None,
                       out: str = "y_filled") -> DataFrame:
    """linear fill by position between the neighbouring values; a
    trailing gap holds the last value, a leading gap stays null. Adds
    ``is_filled``."""
    s = with_position(series, d, key)
    w = _w(key).orderBy("i")
    prev_i = F.last(F.when(F.col(y).isNotNull(), F.col("i")), ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, 0))
    prev_y = F.last(F.col(y), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    next_i = F.first(F.when(F.col(y).isNotNull(), F.col("i")), ignorenulls=True).over(
        w.rowsBetween(0, Window.unboundedFollowing))
    next_y = F.first(F.col(y), ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    s = s.withColumns({"__pi": prev_i, "__py": prev_y, "__ni": next_i, "__ny": next_y})
    lin = F.col("__py") + (F.col("__ny") - F.col("__py")) * (F.col("i") - F.col("__pi")) / (F.col("__ni") - F.col("__pi"))
    filled = (F.when(F.col(y).isNotNull(), F.col(y))
              .when(F.col("__pi").isNull(), F.lit(None).cast("double"))
              .when(F.col("__ni").isNull(), F.col("__py"))
              .otherwise(lin))
    return (s.withColumns({out: filled, "is_filled": F.col(y).isNull() & filled.isNotNull()})
            .drop("__pi", "__py", "__ni", "__ny"))


def forward_fill(series: DataFrame, d: str = "d", y: str = "y", key: str | None = None,
                 out: str = "y_filled") -> DataFrame:
    """carry the last value forward."""
    w = _w(key).orderBy(d).rowsBetween(Window.unboundedPreceding, 0)
    return series.withColumn(out, F.last(F.col(y), ignorenulls=True).over(w))


def gap_check(series: DataFrame, start: str, end: str, d: str = "d", y: str = "y",
              key: str | None = None) -> DataFrame:
    """is [start, end] empty (no non-null value, or no rows)? Chooses
    linear interpolation when it is, forward fill otherwise."""
    keys = [key] if key else []
    inside = F.col(d).between(F.to_date(F.lit(start)), F.to_date(F.lit(end)))
    g = series.groupBy(*keys).agg(F.count(F.when(inside, F.col(y))).alias("values_in_range"))
    return g.select(*keys, F.lit(start).alias("range_start"), F.lit(end).alias("range_end"),
                    "values_in_range", (F.col("values_in_range") == 0).alias("is_gap"),
                    F.when(F.col("values_in_range") == 0, "linear").otherwise("ffill").alias("method"))


def fill_gaps(series: DataFrame, start: str, end: str, d: str = "d", y: str = "y",
              key: str | None = None) -> DataFrame:
    """F3 applied: per series, interpolate when the range is empty, else
    forward fill (the choice joins back as one row per key)."""
    keys = [key] if key else []
    choice = gap_check(series, start, end, d, y, key).select(*keys, "method")
    lin = interpolate_linear(series, d, y, key, out="__lin")
    ff = forward_fill(lin, d, y, key, out="__ff")
    # one row per series key: AQE broadcasts it when its runtime size is
    # under the threshold, else it stays a shuffle join
    j = ff.join(choice, keys, "left") if keys else ff.withColumn(
        "method", choice.select("method").scalar())
    return j.withColumn("y_filled", F.when(F.col("method") == "linear", F.col("__lin")).otherwise(F.col("__ff"))) \
        .drop("__lin", "__ff")


def trend_slope(series: DataFrame, y: str = "y", x: str = "i", key: str | None = None,
                tol: float = 0.01) -> DataFrame:
    """least-squares slope of y on position; > tol increasing,
    < -tol decreasing, else stable."""
    keys = [key] if key else []
    g = series.where(F.col(y).isNotNull()).groupBy(*keys).agg(
        F.regr_slope(F.col(y), F.col(x).cast("double")).alias("slope"))
    return g.withColumn("direction", F.when(F.col("slope") > tol, "increasing")
                        .when(F.col("slope") < -tol, "decreasing").otherwise("stable"))


# ---- F4: STL ----------------------------------------------------------------

def _loess(y: np.ndarray, q: int, deg: int, rw: np.ndarray | None, xs: np.ndarray | None = None) -> np.ndarray:
    """LOESS of ``y`` observed at 0..n-1, evaluated at ``xs`` (default the
    same points): tricube weights over the q nearest points (a contiguous
    window on the regular grid) times robustness weights, local degree
    0/1. When q > n the bandwidth is widened by (q - n) / 2 as in the
    original STL. Cost O(len(xs) * min(q, n))."""
    n = len(y)
    xs = np.arange(n, dtype=float) if xs is None else np.asarray(xs, dtype=float)
    w_rob = np.ones(n) if rw is None else rw
    qe = min(q, n)
    left = np.clip(np.round(xs - (qe - 1) / 2.0).astype(int), 0, n - qe)
    idx = left[:, None] + np.arange(qe)[None, :]
    xw = idx.astype(float)
    h = np.maximum(xs - left, left + qe - 1 - xs)
    if q > n:
        h = h + (q - n) / 2.0
    h = np.maximum(h, 1e-12)[:, None]
    r = np.abs(xw - xs[:, None]) / h
    w = np.where(r < 1.0, (1 - r ** 3) ** 3, 0.0) * w_rob[idx]
    yw = y[idx]
    sw = w.sum(axis=1)
    with np.errstate(invalid="ignore", divide="ignore"):
        mean_y = (w * yw).sum(axis=1) / sw
        if deg == 0:
            res = mean_y
        else:
            xm = (w * xw).sum(axis=1) / sw
            dx = xw - xm[:, None]
            var = (w * dx ** 2).sum(axis=1)
            ok = var > 1e-12 * (h[:, 0] ** 2)
            b = np.where(ok, (w * dx * yw).sum(axis=1) / np.where(ok, var, 1.0), 0.0)
            res = mean_y + b * (xs - xm)
    return np.where(sw > 0, res, np.nan)


def _moving_average(x: np.ndarray, k: int) -> np.ndarray:
    c = np.cumsum(np.insert(x, 0, 0.0))
    return (c[k:] - c[:-k]) / k


def stl(y: np.ndarray, period: int, seasonal: int, trend: int | None = None,
        low_pass: int | None = None, robust: bool = True, inner: int | None = None,
        outer: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Seasonal-trend decomposition by LOESS (Cleveland et al., 1990).
    Returns (trend, seasonal, residual) with trend + seasonal + residual = y."""
    y = np.asarray(y, dtype=float)
    n = len(y)
    if trend is None:
        t = int(np.ceil(1.5 * period / (1 - 1.5 / seasonal)))
        trend = t + 1 if t % 2 == 0 else t
    if low_pass is None:
        low_pass = period + 1 if period % 2 == 0 else period + 2
    inner = inner if inner is not None else (2 if robust else 5)
    outer = outer if outer is not None else (15 if robust else 0)
    rw = np.ones(n)
    tr = np.zeros(n)
    season = np.zeros(n)
    for it in range(outer + 1):
        for _ in range(inner):
            detr = y - tr
            # cycle-subseries smoothing, extended one period on both sides
            c = np.zeros(n + 2 * period)
            for s in range(period):
                idx = np.arange(s, n, period)
                sub = detr[idx]
                m = len(sub)
                if m == 0:
                    continue
                ev = np.arange(-1, m + 1)
                sm = _loess(sub, seasonal, 1, rw[idx], ev)
                c[s + period * (ev + 1)] = sm
            # low-pass filter: MA(period), MA(period), MA(3), then LOESS
            lp = _moving_average(_moving_average(_moving_average(c, period), period), 3)
            lp = _loess(lp, low_pass, 1, None)
            season = c[period:period + n] - lp
            tr = _loess(y - season, trend, 1, rw)
        if it < outer:
            resid = np.abs(y - season - tr)
            h = 6.0 * np.median(resid)
            if h <= 1e-10 * (np.abs(y).max() + 1e-300):   # exact fit: keep unit weights
                rw = np.ones(n)
                continue
            u = np.clip(resid / h, 0, 1)
            rw = np.where(u < 1, (1 - u ** 2) ** 2, 0.0)
    return tr, season, y - season - tr


def stl_decompose(series: DataFrame, d: str = "d", y: str = "y_filled", key: str | None = None,
                  period: int = 7, seasonal: int = 365, robust: bool = True) -> DataFrame:
    """STL per series key with ``applyInPandas`` (one group = one
    series of at most one row per day). Rows with a null value (a leading
    gap) are left out of the fit."""
    keys = [key] if key else []
    src = series.where(F.col(y).isNotNull()).select(*keys, F.col(d).alias("d"), F.col(y).alias("y"))
    if not keys:
        src = src.withColumn("__series", F.lit("all"))
        keys = ["__series"]
    schema = ", ".join(f"`{k}` string" for k in keys) + ", d date, y double, trend double, seasonal double, resid double"

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("d")
        tr, se, re = stl(pdf["y"].to_numpy(), period, seasonal, robust=robust)
        out = pdf.assign(trend=tr, seasonal=se, resid=re)
        for k in keys:
            out[k] = out[k].astype(str)
        return out[[*keys, "d", "y", "trend", "seasonal", "resid"]]

    out = src.groupBy(*keys).applyInPandas(fit, schema)
    return out.drop("__series") if "__series" in out.columns else out


def component_stats(decomp: DataFrame, key: str | None = None) -> DataFrame:
    """Mean, std, min, max of trend, seasonal and residual."""
    keys = [key] if key else []
    long = decomp.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(c).alias("component"), F.col(c).alias("value"))
        for c in ("trend", "seasonal", "resid")])).alias("s")).select(*keys, "s.*")
    return long.groupBy(*keys, "component").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
