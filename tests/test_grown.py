"""Forests whose trees grow whole in tasks: splits, bins, scores and when this way is taken."""

import random

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from delaylens.operators import evaluate as K
from delaylens.operators import forest as FO
from delaylens.operators import grown as G
from delaylens.operators import ml as M


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(4)
    rows = []
    for i in range(3000):
        x = [rng.random(), float(rng.randint(0, 5)), rng.random()]
        y = float(rng.random() < 0.15 + 0.7 * (x[0] > 0.5) * (x[1] > 2))
        rows.append((i, Vectors.dense(x), y, 1.0 + y, 1.0 + i % 2, 10 * x[0] + x[1]))
    return spark.createDataFrame(rows, ["id", "features", "label", "weight", "uneven", "y"]).repartition(4).persist()


@pytest.fixture
def in_tasks(monkeypatch):
    monkeypatch.setattr(G, "LEAST_ROWS", 1000)
    monkeypatch.setattr(G, "CHUNK", 500)


def test_forest_of_many_rows_grows_in_tasks_as_well_as_spark(frame, in_tasks, monkeypatch):
    train, test = frame.where("id % 3 > 0"), frame.where("id % 3 = 0")
    est = RandomForestClassifier(numTrees=30, maxDepth=5, seed=1, weightCol="weight", minInstancesPerNode=5)
    model, plain = FO.Forest(est.copy()).fit(train), est.fit(train)
    assert isinstance(model.groves[0], G.GrownModel) and model.getNumTrees == 30
    ap = [K.average_precision(m.transform(test).select("label", M.prob1().alias("score")), label="label").first()[0] for m in (model, plain)]
    assert ap[0] > ap[1] - 0.02
    assert np.allclose(model.featureImportances.toArray(), plain.featureImportances.toArray(), atol=0.1)
    row = model.transform(test).first()
    assert row["prediction"] == float(np.argmax(row["probability"].toArray())) and abs(sum(row["probability"].toArray()) - 1) < 1e-9


def test_regression_in_tasks(frame, in_tasks):
    est = RandomForestRegressor(numTrees=20, maxDepth=6, seed=1, labelCol="y", minInstancesPerNode=2)
    model, plain = FO.Forest(est.copy()).setPredictionCol("p").fit(frame), est.setPredictionCol("p").fit(frame)
    mae = [m.transform(frame).agg(F.avg(F.abs(F.col("p") - F.col("y")))).first()[0] for m in (model, plain)]
    assert mae[0] < 1.2 * mae[1]


def test_grown_model_does_not_depend_on_partitions(frame, in_tasks):
    fits = [M.rf_classifier(8, 4).fit(frame.repartition(n)) for n in (1, 7)]
    a, b = ([r["probability"] for r in f.transform(frame.orderBy("id").limit(100)).collect()] for f in fits)
    assert a == b


def test_other_forests_stay_groves(frame, in_tasks, monkeypatch):
    """Weights that differ within a class, and rows beyond a task's cells."""
    grown = lambda weight: isinstance(M.rf_classifier(4, 2, weight=weight).fit(frame).groves[0], G.GrownModel)
    assert grown("weight") and not grown("uneven")
    monkeypatch.setattr(G, "TASK_CELLS", 3 * 3000 - 1)
    assert not grown("weight")


@pytest.mark.parametrize("classes", [True, False])
def test_every_split_is_the_best_one(classes):
    """Each node against all its cuts, one by one; then the rows' values against the leaves' rows."""
    rng = np.random.default_rng(3)
    x = rng.integers(0, 9, (800, 3)).astype(np.uint8)
    own = np.array([0.7, 1.9])
    y = (rng.random(800) < 0.2 + 0.6 * (x[:, 0] > 4) * (x[:, 1] > 2)).astype(np.uint8) if classes else rng.normal(size=800) + x[:, 0]
    counts = rng.integers(0, 3, 800).astype(np.uint8)
    tree = G.grow(x, y, 9, 4, 3, 5, rng, own if classes else None, counts)

    def explained(rows):
        w = counts[rows].astype(float)
        if not classes:
            return (w * y[rows]).sum() ** 2 / w.sum()
        n = np.array([(w * (y[rows] == c)).sum() * own[c] for c in (0, 1)])
        return (n ** 2).sum() / n.sum()

    members, splits = {0: np.flatnonzero(counts)}, 0
    for k in range(len(tree["left"])):
        rows = members[k]
        if tree["left"][k] < 0:
            w = counts[rows] * (own[y[rows]] if classes else 1.0)
            want = [(w * (y[rows] == c)).sum() / w.sum() for c in (0, 1)] if classes else [(w * y[rows]).sum() / w.sum()]
            assert np.allclose(tree["value"][k], want)
            continue
        found = []
        for f in range(3):
            for cut in range(8):
                low = x[rows, f] <= cut
                if counts[rows[low]].sum() >= 5 and counts[rows[~low]].sum() >= 5:
                    found.append(explained(rows[low]) + explained(rows[~low]))
        low = x[rows, tree["feature"][k]] <= tree["bin"][k]
        assert explained(rows[low]) + explained(rows[~low]) == pytest.approx(max(found))
        members[tree["left"][k]], members[tree["left"][k] + 1] = rows[low], rows[~low]
        splits += 1
    assert splits > 5


def test_bins_hold_all_values_or_equal_shares(monkeypatch):
    few = np.array([3.0, 1.0, 1.0, 7.0])
    assert G.thresholds(*G.points(few), 32).tolist() == [2.0, 5.0]
    assert len(G.thresholds(np.array([4.0]), np.array([9]), 32)) == 0
    many = np.random.default_rng(2).normal(size=200_000)
    cuts = G.thresholds(*(np.concatenate(c) for c in zip(*(G.points(p) for p in np.array_split(many, 7)))), 32)
    shares = np.bincount(np.searchsorted(cuts, many)) / len(many)
    assert len(shares) == 32 and abs(shares - 1 / 32).max() < 0.005


def test_bootstrap_counts():
    table = G.poisson_table()
    assert abs(table.mean() - 1) < 1e-3 and abs((table == 0).mean() - np.exp(-1)) < 1e-3
