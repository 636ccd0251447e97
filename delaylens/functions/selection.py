"""Exact quantiles of whole columns by selection in rounds.

Each round counts the values that are still in question in ``BINS`` ranges (a
plain hash aggregate of at most that many groups, combined on the map side, with
the least and greatest value of each range) and goes on inside the one range that
holds the wanted rank. No task and no buffer ever holds a column's distinct
values: a round shuffles, and hands to the driver, at most ``BINS`` rows for each
bracket, whatever the input. Ranges are even in the value and, in every other
round, in its logarithm, so that a few huge values cannot hold the search back.
Every round splits its bracket, as its least and greatest value lie in different
ranges; a bracket of one value ends the search.

Nulls are passed over. As Spark orders them, NaN is above every number. A
column without values has null quantiles.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 1024
INF = float("inf")
MAX = 1.7976931348623157e308


def _log(v: float) -> float:
    return math.copysign(math.log1p(abs(v)), v)


def _bin(v: Column, lo: float, hi: float, log: bool) -> Column:
    """The range of ``v`` within [lo, hi], a weakly rising function of ``v``."""
    if log and _log(hi) - _log(lo) > 0:
        v, lo, hi = F.signum(v) * F.log1p(F.abs(v)), _log(lo), _log(hi)
    scale = 0.5 if math.isinf(hi - lo) else 1.0
    at = F.floor((v * scale - lo * scale) / (hi * scale - lo * scale) * BINS)
    return F.greatest(F.lit(0), F.least(F.lit(BINS - 1), at)).cast("int")


def order_statistics(df: DataFrame, ranks: dict[str, Sequence[int]], ends: dict) -> dict:
    """{(column, rank): value}; ranks count from 0 among the finite values of a column,
    ``ends`` holds the (least, greatest) of them."""
    found, open_ = {}, {}
    for c, ks in ranks.items():
        for k in ks:
            open_[c, k] = (*ends[c], k)
    log = False
    while True:
        found.update({t: lo for t, (lo, hi, _) in open_.items() if lo == hi})
        open_ = {t: b for t, b in open_.items() if b[0] != b[1]}
        if not open_:
            return found
        brackets = sorted({(c, lo, hi) for (c, _), (lo, hi, _) in open_.items()})
        value = lambda c: F.col(f"`{c}`").cast("double")
        parts = F.array(*[F.when(value(c).between(F.lit(lo), F.lit(hi)),
                                 F.struct(F.lit(i).alias("t"), _bin(value(c), lo, hi, log).alias("b"), value(c).alias("v")))
                          for i, (c, lo, hi) in enumerate(brackets)])
        counts = (df.select(F.explode(parts).alias("p")).where("p is not null").groupBy("p.t", "p.b")
                  .agg(F.count(F.lit(1)).alias("n"), F.min("p.v").alias("lo"), F.max("p.v").alias("hi")).collect())
        ranges: dict[int, list] = {}
        for r in sorted(counts, key=lambda r: (r["t"], r["b"])):
            ranges.setdefault(r["t"], []).append(r)
        for (c, k), (lo, hi, left) in list(open_.items()):
            for r in ranges[brackets.index((c, lo, hi))]:
                if left < r["n"]:
                    open_[c, k] = (r["lo"], r["hi"], left)
                    break
                left -= r["n"]
        log = not log


def exact_quantiles(df: DataFrame, wanted: dict[str, Sequence[float]]) -> dict:
    """{(column, q): value}, interpolated linearly between neighbours. Each round
    reads ``df`` once, so pass a written table or a cheap projection."""
    cols = list(wanted)
    v = {c: F.col(f"`{c}`").cast("double") for c in cols}
    finite = {c: v[c].between(F.lit(-MAX), F.lit(MAX)) for c in cols}
    row = df.agg(*[F.struct(F.count(v[c]).alias("n"), F.count_if(v[c] == F.lit(-INF)).alias("low"),
                            F.count_if(v[c] == F.lit(INF)).alias("high"), F.count_if(finite[c]).alias("finite"),
                            F.min(F.when(finite[c], v[c])).alias("lo"), F.max(F.when(finite[c], v[c])).alias("hi")).alias(f"c{i}")
                   for i, c in enumerate(cols)]).first()
    of = {c: row[f"c{i}"] for i, c in enumerate(cols)}
    places = {(c, q): (of[c]["n"] - 1) * float(q) for c in cols for q in wanted[c] if of[c]["n"]}
    ranks: dict[str, set] = {}
    for (c, _), at in places.items():
        for k in (math.floor(at), math.ceil(at)):
            if 0 <= k - of[c]["low"] < of[c]["finite"]:
                ranks.setdefault(c, set()).add(k - of[c]["low"])
    found = order_statistics(df, {c: sorted(ks) for c, ks in ranks.items()}, {c: (of[c]["lo"], of[c]["hi"]) for c in ranks})

    def at_rank(c: str, k: int) -> float:
        o = of[c]
        if k < o["low"]:
            return -INF
        if k < o["low"] + o["finite"]:
            return found[c, k - o["low"]]
        return INF if k < o["low"] + o["finite"] + o["high"] else math.nan

    out = {(c, q): None for c in cols for q in wanted[c]}
    for (c, q), at in places.items():
        lo, hi = math.floor(at), math.ceil(at)
        a, b = at_rank(c, lo), at_rank(c, hi)
        out[c, q] = a if a == b or lo == hi else (hi - at) * a + (at - lo) * b
    return out
