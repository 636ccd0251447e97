"""Two-sample tests, running totals and ranking metrics against brute force
on small fixtures, plus a metamorphic check (repartitioning changes
nothing)."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from delaylens.functions.prefix import running_totals
from delaylens.operators import evaluate as K, twosample as I


def _frame(spark, a, b):
    rows = [(float(x), "a") for x in a] + [(float(x), "b") for x in b]
    return spark.createDataFrame(rows, "v double, g string")


def test_running_totals_match_cumsum(spark):
    rng = np.random.default_rng(1)
    keys = rng.permutation(500).astype(float)
    vals = rng.integers(0, 10, 500)
    df = spark.createDataFrame(pd.DataFrame({"k": keys, "x": vals}))
    for desc in (False, True):
        got = running_totals(df, "k", ["x"], descending=desc, buckets=7).toPandas().sort_values("k")
        ref = pd.DataFrame({"k": keys, "x": vals}).sort_values("k", ascending=not desc)
        ref["cum"] = ref["x"].cumsum()
        ref = ref.sort_values("k")
        assert np.array_equal(got["cum_x"].to_numpy(), ref["cum"].to_numpy())


def test_ks_statistic_brute_force(spark):
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 30, 300), rng.integers(5, 40, 200)
    df = _frame(spark, a, b)
    got = I.ks_2samp(df, "v", F.col("g") == "a", F.col("g") == "b").first()
    grid = np.union1d(a, b)
    d = max(abs((a <= t).mean() - (b <= t).mean()) for t in grid)
    assert abs(got["ks_statistic"] - d) < 1e-12
    assert 0.0 <= got["ks_pvalue"] <= 1.0


def test_mann_whitney_u_brute_force(spark):
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 20, 120), rng.integers(3, 25, 90)
    df = _frame(spark, a, b)
    got = I.mann_whitney_u(df, "v", F.col("g") == "a", F.col("g") == "b").first()
    u = sum((x > y) + 0.5 * (x == y) for x in a for y in b)
    assert abs(got["u_statistic"] - u) < 1e-9
    assert 0.0 <= got["mw_pvalue"] <= 1.0


def test_repartition_changes_nothing(spark):
    rng = np.random.default_rng(4)
    a, b = rng.integers(0, 50, 400), rng.integers(0, 60, 300)
    df = _frame(spark, a, b)
    r1 = I.ks_2samp(df, "v", F.col("g") == "a", F.col("g") == "b").first()
    r2 = I.ks_2samp(df.repartition(5), "v", F.col("g") == "a", F.col("g") == "b").first()
    assert r1["ks_statistic"] == r2["ks_statistic"]


def _scores(spark, seed=5, n=400):
    rng = np.random.default_rng(seed)
    s = rng.integers(0, 20, n) / 20.0
    y = (rng.random(n) < s).astype(int)
    return spark.createDataFrame(pd.DataFrame({"label": y, "score": s})), y, s


def test_roc_auc_pairwise(spark):
    df, y, s = _scores(spark)
    pos, neg = s[y == 1], s[y == 0]
    auc = np.mean([(p > q) + 0.5 * (p == q) for p in pos for q in neg])
    assert abs(K.roc_auc(df).first()[0] - auc) < 1e-12


def test_average_precision_brute_force(spark):
    df, y, s = _scores(spark)
    ap, prev_r = 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        pred = s >= t
        tp = (pred & (y == 1)).sum()
        p, r = tp / pred.sum(), tp / (y == 1).sum()
        ap += (r - prev_r) * p
        prev_r = r
    assert abs(K.average_precision(df).first()[0] - ap) < 1e-12


def test_threshold_reaches_recall(spark):
    df, y, s = _scores(spark)
    t = K.threshold_for_recall(df, 0.8).first()
    assert t["recall_target_met"]
    pred = s >= t["raw_threshold"]
    assert (pred & (y == 1)).sum() / (y == 1).sum() >= 0.8


def test_confusion_matrix_has_all_cells(spark):
    df = spark.createDataFrame([(1, 1), (1, 1)], "label int, prediction int")
    cells = {(r.actual, r.predicted): r["count"] for r in K.confusion_matrix(df).collect()}
    assert cells == {(0, 0): 0, (0, 1): 0, (1, 0): 0, (1, 1): 2}
