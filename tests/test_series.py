import datetime as dt

import numpy as np

from delaylens.operators import series as S


def test_stl_invariants():
    rng = np.random.default_rng(0)
    n = 400
    y = np.sin(np.arange(n) * 2 * np.pi / 7) * 3 + np.arange(n) * 0.02 + rng.normal(size=n) * 0.3
    tr, se, re = S.stl(y, 7, 365)
    assert np.allclose(tr + se + re, y)
    # weekly pattern recovered: seasonal correlates with the true sine
    assert np.corrcoef(se, np.sin(np.arange(n) * 2 * np.pi / 7))[0, 1] > 0.95
    c = np.full(60, 2.5)
    tr, se, re = S.stl(c, 7, 365)
    assert np.abs(se).max() < 1e-9 and np.abs(tr - 2.5).max() < 1e-9


def test_stl_decompose_per_key(spark):
    rows = []
    for key, amp in (("a", 1.0), ("b", 4.0)):
        for i in range(60):
            rows.append((key, dt.date(2020, 1, 1) + dt.timedelta(days=i), float(amp * np.sin(i * 2 * np.pi / 7) + 10)))
    df = spark.createDataFrame(rows, "k string, d date, y_filled double")
    out = S.stl_decompose(df, key="k").toPandas()
    assert len(out) == 120
    assert np.allclose(out.trend + out.seasonal + out.resid, out.y)
    amp = out.groupby("k").seasonal.agg(lambda s: s.max() - s.min())
    assert amp["b"] > amp["a"]
