"""A hot key holding a third of all rows: results stay exact, and the
aggregation is planned partial -> exchange -> final."""

import datetime as dt

import numpy as np
import pandas as pd

from delaylens.operators import evaluate as K, reports as R


def _skewed(spark, n=3000, seed=7):
    rng = np.random.default_rng(seed)
    route = np.where(np.arange(n) < n // 3, "HOT → HUB", [f"R{i % 50}" for i in range(n)])
    delay = rng.integers(0, 120, n).astype(float)
    delay[rng.random(n) < 0.05] = np.nan
    day = [dt.date(2000, 1, 1) + dt.timedelta(days=int(d)) for d in rng.integers(0, 60, n)]
    pdf = pd.DataFrame({"Route": route, "DepDelayMinutes": delay, "DepDate": day})
    return spark.createDataFrame(pdf).repartition(8), pdf


def test_route_stats_with_hot_key(spark):
    df, pdf = _skewed(spark)
    got = R.route_stats(df, min_flights=1).toPandas().set_index("Route").sort_index()
    g = pdf.groupby("Route")["DepDelayMinutes"]
    assert (got["Flight_Count"] == g.count().sort_index()).all()
    assert np.allclose(got["Avg_Delay"], g.mean().sort_index())
    assert np.allclose(got["Median_Delay"], g.median().sort_index())
    assert np.allclose(got["Delay_Std"], g.std().sort_index())
    freq = pdf.assign(p=pdf.DepDelayMinutes > 0).groupby("Route").p.mean().sort_index() * 100
    assert np.allclose(got["Delay_Frequency"], freq)
    plan = R.route_stats(df, min_flights=1)._jdf.queryExecution().executedPlan().toString()
    assert "partial_" in plan and "Exchange" in plan


def test_average_precision_with_hot_score(spark):
    rng = np.random.default_rng(8)
    n = 900
    s = np.where(np.arange(n) < n // 3, 0.5, rng.integers(0, 100, n) / 100.0)
    y = (rng.random(n) < s).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"label": y, "score": s})).repartition(8)
    ap, prev_r = 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        pred = s >= t
        tp = (pred & (y == 1)).sum()
        p, r = tp / pred.sum(), tp / (y == 1).sum()
        ap += (r - prev_r) * p
        prev_r = r
    assert abs(K.average_precision(df).first()[0] - ap) < 1e-12


def test_grouped_quantiles_match_pandas(spark):
    from delaylens.functions.quantile import grouped_quantiles
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"k": rng.integers(0, 5, 700), "v": rng.normal(size=700)})
    pdf.loc[rng.random(700) < 0.1, "v"] = np.nan
    got = grouped_quantiles(spark.createDataFrame(pdf), ["k"], "v", [0.25, 0.5, 0.99], ["a", "b", "c"]).toPandas()
    got = got.set_index("k").sort_index()
    ref = pdf.groupby("k").v.quantile([0.25, 0.5, 0.99]).unstack().sort_index()
    assert np.allclose(got[["a", "b", "c"]].to_numpy(), ref.to_numpy())
