"""Groves, early stopping, stratified folds and pooled isotonic maps."""

import random

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressor

from delaylens.operators import evaluate as K
from delaylens.operators import forest as FO
from delaylens.operators import isotonic as I
from delaylens.operators import ml as M


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(4)
    rows = []
    for i in range(3000):
        x = [rng.random(), rng.randint(0, 5), rng.random()]
        p = 0.15 + 0.7 * (x[0] > 0.5) * (x[1] > 2)
        y = float(rng.random() < p)
        rows.append((i, Vectors.dense(x), y, 1.0 + y, 10 * x[0] + x[1]))
    return spark.createDataFrame(rows, ["id", "features", "label", "weight", "y"]).repartition(4).persist()


def test_groves_average_like_one_forest(frame, monkeypatch):
    """Class probabilities are the mean over all trees, whichever grove they grew in."""
    monkeypatch.setattr(FO, "GROVE_TREES", 3)
    model = FO.Forest(RandomForestClassifier(numTrees=20, maxDepth=4, seed=1, weightCol="weight")).fit(frame)
    assert len(model.groves) > 1 and sum(model.sizes) == 20 == len(model.trees)
    rows = model.transform(frame.limit(50)).collect()
    for r in rows:
        leaves = [t.predictProbability(r["features"]).toArray() for t in model.trees]
        assert np.allclose(np.mean(leaves, axis=0), r["probability"].toArray())
        assert r["prediction"] == float(np.argmax(r["probability"].toArray()))
    assert abs(sum(model.featureImportances.toArray()) - 1) < 1e-9


def test_grove_regression_and_single_grove(frame, monkeypatch):
    est = RandomForestRegressor(numTrees=9, maxDepth=3, seed=2, labelCol="y")
    monkeypatch.setattr(FO, "GROVE_TREES", 2)
    many = FO.Forest(est.copy()).setPredictionCol("p").fit(frame)
    for r in many.transform(frame.limit(20)).collect():
        assert abs(r["p"] - np.mean([t.predict(r["features"]) for t in many.trees])) < 1e-9
    monkeypatch.setattr(FO, "GROVE_TREES", 100)
    one = FO.Forest(est.copy()).fit(frame)
    assert len(one.groves) == 1 and "prediction" in one.transform(frame).columns


def test_model_does_not_depend_on_partitions(frame):
    fits = [FO.Forest(RandomForestClassifier(numTrees=24, maxDepth=4, seed=3)).fit(frame.repartition(n)) for n in (1, 7)]
    a, b = ([r["probability"] for r in f.transform(frame.orderBy("id").limit(100)).collect()] for f in fits)
    assert a == b


def test_boosting_stops_early_without_loss(frame):
    train, test = frame.where("id % 3 > 0"), frame.where("id % 3 = 0")
    early = M.gbt_classifier(60, 3, 0.3, weight="weight").fit(train)
    full = GBTClassifier(maxIter=60, maxDepth=3, stepSize=0.3, weightCol="weight", seed=42, subsamplingRate=0.8).fit(train)
    assert early.getNumTrees < 60 == full.getNumTrees
    a, b = (K.average_precision(m.transform(test).select("label", M.prob1().alias("score")), label="label").first()[0] for m in (early, full))
    assert a > b - 0.02


def test_folds_are_stratified(frame, spark):
    got = M.stratified_folds(frame.drop("features"), "label", 3, cols=["id"]).groupBy("label", "__fold").count().collect()
    for label in (0.0, 1.0):
        sizes = [r["count"] for r in got if r["label"] == label]
        assert len(sizes) == 3 and max(sizes) - min(sizes) <= 1
    few = spark.createDataFrame([(1, 0.0), (2, 1.0), (3, None), (4, 1.0)], "id long, label double")
    assert M.stratified_folds(few, "label", 3, cols=["id"]).where("__fold BETWEEN 0 AND 2").count() == 4
    assert M.stratified_folds(few.limit(0), "label", 3).count() == 0


def plain_pav(points):
    blocks = []
    for x, y, w in sorted(points):
        blocks.append([x, x, w, y * w])
        while len(blocks) > 1 and blocks[-2][3] / blocks[-2][2] >= blocks[-1][3] / blocks[-1][2]:
            b = blocks.pop()
            a = blocks.pop()
            blocks.append([a[0], b[1], a[2] + b[2], a[3] + b[3]])
    return blocks


@pytest.mark.parametrize("kind", ["noise", "falling", "rising", "steps"])
@pytest.mark.parametrize("parts", [1, 2, 7])
def test_pooling_by_ranges_equals_pooling_at_once(spark, kind, parts):
    rng = random.Random(kind)
    n = 600
    value = {"noise": lambda i: float(rng.random() < i / n), "falling": lambda i: float(n - i), "rising": lambda i: float(i),
             "steps": lambda i: float((i // 37) % 5 - i // 200)}[kind]
    points = [(i / n, value(i), float(rng.randint(1, 5))) for i in range(n)]
    got = I.isotonic_blocks(spark.createDataFrame(points, "s double, m double, w double"), "s", "m", "w", parts).collect()
    assert np.allclose(sorted(list(r) for r in got), plain_pav(points))


def test_calibration_of_distinct_scores(spark):
    rng = random.Random(9)
    rows = [(i / 2000, float(rng.random() < (i / 2000) ** 2)) for i in range(2000)]
    model = M.fit_isotonic(spark.createDataFrame(rows, "p double, label double"), "p", "label")
    want = plain_pav([(s, y, 1.0) for s, y in rows])
    for lo, hi, w, t in want:
        for x in (lo, hi):
            assert abs(model.predict(x) - t / w) < 1e-9
    assert len(want) < 200


@pytest.fixture
def dealt_parts(monkeypatch):
    """Partitions of every frame that is dealt for a fit."""
    parts, plain = [], FO.dealt
    monkeypatch.setattr(FO, "dealt", lambda df, columns, n: parts.append(n) or plain(df, columns, n))
    return parts


def test_fits_take_at_most_a_partition_a_core(frame, dealt_parts, monkeypatch):
    monkeypatch.setattr(FO, "TASK_ROWS", 10)
    monkeypatch.setattr(FO, "NODE_ROWS", 1)
    M.rf_classifier(4, 3).fit(frame)
    M.gbt_classifier(4, 2, 0.3).fit(frame)
    M.gbt_regressor(2, 2).fit(frame)
    assert len(dealt_parts) == 3 and 1 < max(dealt_parts) <= FO.cores(frame)


def test_deep_forests_take_fewer_partitions(frame, dealt_parts, monkeypatch):
    monkeypatch.setattr(FO, "TASK_ROWS", 500)
    monkeypatch.setattr(FO, "cores", lambda df: 8)
    monkeypatch.setattr(FO, "GROVE_TREES", 2)
    for depth in (2, 6):
        model = M.rf_classifier(24, depth).fit(frame)
        assert sum(model.sizes) == 24 and all(model.sizes)
    assert dealt_parts == [6, 1]


def test_forest_over_many_rows_grows_grove_by_grove(frame, monkeypatch):
    monkeypatch.setattr(FO, "CORE_CELLS", 5 * 3000 // FO.cores(frame))
    model = M.rf_classifier(24, 3).fit(frame)
    assert 4 < len(model.groves) <= 24 and sum(model.sizes) == 24 == len(model.trees)


def test_remembered_nodes_give_the_same_forest(frame, monkeypatch):
    fits = []
    for depth in (12, 1):
        monkeypatch.setattr(FO, "CACHED_DEPTH", depth)
        fits.append(M.rf_classifier(20, 7, weight="weight").fit(frame))
    a, b = ([r["probability"] for r in f.transform(frame.orderBy("id").limit(100)).collect()] for f in fits)
    assert a == b


@pytest.mark.parametrize("rows", [1, 40_000, 700_000, 1_056_690, 10_600_000, 63_000_000])
@pytest.mark.parametrize("trees, depth", [(1, 5), (24, 12), (100, 15), (200, 10), (300, 12)])
@pytest.mark.parametrize("have", [8, 12])
def test_layout_bounds_what_grows_at_a_time(rows, trees, depth, have):
    """Groves at a time keep within the cells of all cores, unless one tree a grove is too many already."""
    parts, groves, beside = FO.layout(rows, trees, depth, have)
    assert 1 <= parts <= have and 1 <= groves <= trees and 1 <= beside <= max(have, FO.OVERLAP) and beside <= groves
    if groves < trees:
        assert beside * rows * trees / groves <= FO.CORE_CELLS * have


def test_large_forests_overlap():
    """Where every core has rows of a grove, others grow beside it: they fill the time in which the driver works alone."""
    for rows in (700_000, 1_056_690):
        parts, groves, beside = FO.layout(rows, 300, 12, 12)
        assert beside == FO.OVERLAP and groves >= beside
    assert FO.layout(10_600_000, 200, 10, 12)[2] == 2
    assert FO.layout(63_000_000, 200, 10, 12)[2] == 1      # too many rows for a second grove


@pytest.mark.parametrize("fit", [lambda: M.rf_classifier(4, 3), lambda: M.gbt_regressor(2, 2), lambda: M.gbt_classifier(4, 2, 0.3)])
def test_no_task_sorts_more_rows_when_the_input_grows(frame, dealt_parts, monkeypatch, fit):
    """Partitions beyond one a core once each would hold over ``PART_ROWS`` rows."""
    monkeypatch.setattr(FO, "cores", lambda df: 2)
    monkeypatch.setattr(FO, "PART_ROWS", 700)
    fit().fit(frame)
    assert dealt_parts == [5]


def test_boosted_queries_grow_every_round_on_all_rows_and_sample_columns(frame, spark, monkeypatch):
    """J8 as the original has it: no round and no row is held back, columns are sampled as rows are."""
    from delaylens.plans import q_ml
    seen = []
    monkeypatch.setattr(q_ml, "_fit_score", lambda spark, sf, est, weighted=True: (seen.append(est), frame))
    q_ml.boosted_classifier(spark, "")
    [est] = seen
    assert isinstance(est, FO.Boosted) and est.inner.getMaxIter() == 300
    assert float(est.inner.getFeatureSubsetStrategy()) == 0.8 == est.inner.getSubsamplingRate()
    assert M.gbt_classifier(7, 2, 0.5, weight="weight", early=False).fit(frame).getNumTrees == 7
