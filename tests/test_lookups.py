"""Rolled-up group means equal per-key means computed directly, with null
keys and null values present."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from delaylens.operators import lookups as E


def _frame(spark, n=400, seed=11):
    rng = np.random.default_rng(seed)
    o = rng.choice(["A", "B", "C", None], n)
    d = rng.choice(["X", "Y", None], n)
    r = [None if a is None or b is None else f"{a} → {b}" for a, b in zip(o, d)]
    v = rng.integers(0, 90, n).astype(float)
    v[rng.random(n) < 0.1] = np.nan
    pdf = pd.DataFrame({"i": np.arange(n), "OriginCity": o, "DestCity": d, "Route": r, "DepDelayMinutes": v,
                        "is_train": rng.random(n) < 0.6})
    return spark.createDataFrame(pdf), pdf


def test_group_stats_lookup_matches_pandas(spark):
    df, pdf = _frame(spark)
    got = E.group_stats_lookup(df).toPandas().sort_values("i").reset_index(drop=True)
    for key, col in (("Route", "RouteAvgDelay"), ("OriginCity", "OriginAvgDelay"), ("DestCity", "DestAvgDelay")):
        ref = pdf[key].map(pdf.groupby(key)["DepDelayMinutes"].mean())
        assert np.allclose(got[col].astype(float), ref.astype(float), equal_nan=True)
    freq = pdf["Route"].map(pdf["Route"].value_counts())
    assert np.allclose(got["RouteFrequency"].astype(float), freq.astype(float), equal_nan=True)


def test_train_priors_match_pandas(spark):
    df, pdf = _frame(spark)
    got = E.train_priors(df).toPandas().sort_values("i").reset_index(drop=True)
    tr = pdf[pdf.is_train]
    glob = tr["DepDelayMinutes"].mean()
    for key, col in (("Route", "Route_Prior"), ("OriginCity", "Origin_Prior")):
        ref = pdf[key].map(tr.groupby(key)["DepDelayMinutes"].mean()).fillna(glob)
        assert np.allclose(got[col], ref)
