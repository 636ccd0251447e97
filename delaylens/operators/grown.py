"""Forests whose trees are grown whole in tasks.

Level-wise induction over a cluster passes the rows once a level and shuffles split
statistics. While the rows of a forest, one byte a feature, fit a task's memory
(``TASK_CELLS``), a task grows its share of the trees from all of them instead:

1. Pack. Dealt rows become chunks of ``CHUNK`` rows with, per feature, at most ``POINTS``
   values that carry the ranks of all rows of the chunk.
2. Bins. Thresholds lie between all values of a feature, or between quantiles of all rows
   (rank error at most 1 / ``POINTS``) when there are more than ``maxBins``.
3. Trees. Binned chunks go to every task that grows trees. A tree draws a bootstrap sample
   (Poisson counts), a feature subset at every node, and splits level by level on the histograms
   of its open nodes, by Gini impurity or variance, as Spark ML's forest does.

Trees depend on the seed and the rows alone. A tree comes back as a few packed arrays; rows are
scored on their bins, tree by tree, in blocks that stay in a core's cache.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylens.session import materialize

#: rows times features of a forest that a task holds, one byte each
TASK_CELLS = 1 << 27
#: rows from which growing in tasks pays off
LEAST_ROWS = 100_000
CHUNK = 1 << 16
POINTS = 1024
#: rows of one pass over a tree's rows
BLOCK = 1 << 19
#: rows scored at a time
SCORED = 1 << 13


def points(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of a column and rows up to each of them since the one before."""
    values, counts = np.unique(x, return_counts=True)
    upto = np.cumsum(counts)
    part = (upto - 1) * POINTS // upto[-1] if len(values) > POINTS else np.arange(len(values))
    last = np.flatnonzero(np.append(part[1:] != part[:-1], True))
    return values[last], np.diff(upto[last], prepend=0)


def thresholds(values: np.ndarray, counts: np.ndarray, bins: int) -> np.ndarray:
    """At most ``bins - 1`` ascending thresholds between values that come with counts."""
    values, at = np.unique(values, return_inverse=True)
    upto = np.cumsum(np.bincount(at, counts))
    if len(values) <= bins:
        return (values[1:] + values[:-1]) / 2
    goal = upto[-1] * np.arange(1, bins) / bins
    at = np.clip(np.searchsorted(upto, goal), 1, len(values) - 2)
    at = np.unique(at - (np.abs(upto[at - 1] - goal) < np.abs(upto[at] - goal)))
    return (values[at + 1] + values[at]) / 2


def poisson_table() -> np.ndarray:
    """Poisson(1) counts by 16 random bits."""
    p, upto, edges = np.exp(-1.0), 0.0, []
    for k in range(1, 10):
        upto += p
        edges.append(round(upto * 65536))
        p /= k
    return np.searchsorted(edges, np.arange(65536), side="right").astype(np.uint8)


def grow(x: np.ndarray, y: np.ndarray, bins: int, depth: int, subset: int, least: int, rng: np.random.Generator,
         class_weight: np.ndarray | None, counts: np.ndarray | None = None) -> dict[str, np.ndarray]:
    """One tree over rows of bins ``x``: its nodes, parents before children. With ``class_weight``
    ``y`` holds classes, else numbers. ``counts`` (drawn if not given) says how often a row was drawn."""
    if counts is None:
        counts = poisson_table()[rng.integers(0, 65536, len(x), dtype=np.uint16)]
    drawn = np.flatnonzero(counts)
    x, c, features = x[drawn], counts[drawn], x.shape[1]
    classes = class_weight is not None
    y = y[drawn]
    kinds = len(class_weight) if classes else 2
    slot, flat = np.zeros(len(x), np.int32), x.reshape(-1)

    def sums(key: np.ndarray, a: int, b: int, size: int) -> np.ndarray:
        """Per key: rows by class, or rows and their sum."""
        if classes:
            return np.bincount(key * kinds + y[a:b], c[a:b], size * kinds).reshape(size, kinds)
        return np.stack([np.bincount(key, c[a:b], size), np.bincount(key, c[a:b] * y[a:b], size)], 1)

    def quality(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weight of a part and what it explains of it."""
        with np.errstate(divide="ignore", invalid="ignore"):
            if not classes:
                return s[..., 0], s[..., 1] ** 2 / s[..., 0]
            w = s * class_weight
            n = w.sum(-1)
            return n, (w ** 2).sum(-1) / n

    raw = lambda s: s.sum(-1) if classes else s[..., 0]
    total = sum((sums(slot[a:a + BLOCK].astype(np.int64), a, a + BLOCK, 1) for a in range(0, len(x), BLOCK)), np.zeros((1, kinds)))
    levels, first = [], 0
    for level in range(depth + 1):
        k = len(total)
        weight, explained = quality(total)
        node = {"total": total, "gain": np.full(k, -1.0), "feature": np.full(k, -1, np.int32), "bin": np.full(k, -1, np.int32),
                "left": np.full(k, -1, np.int32)}
        levels.append(node)
        if level == depth or not k:
            break
        chosen = np.argsort(rng.random((k, features)), axis=1)[:, :subset].astype(np.int64)
        best, left_total = np.full(k, -np.inf), np.zeros((k, kinds))
        for j in range(subset):
            own, hist = chosen[:, j], np.zeros((k * bins, kinds))
            for a in range(0, len(x), BLOCK):
                b = min(a + BLOCK, len(x))
                at = slot[a:b]
                key = flat[np.arange(a * features, b * features, features) + own[at]].astype(np.int64)
                key += at.astype(np.int64) * bins
                hist += sums(key, a, b, k * bins)
            left = hist.reshape(k, bins, kinds).cumsum(1)[:, :-1]
            right = total[:, None] - left
            score = quality(left)[1] + quality(right)[1]
            score = np.where((raw(left) >= least) & (raw(right) >= least), score, -np.inf)
            cut = score.argmax(1)
            found = score[np.arange(k), cut]
            better = found > best
            best = np.where(better, found, best)
            node["feature"] = np.where(better, own, node["feature"]).astype(np.int32)
            node["bin"] = np.where(better, cut, node["bin"]).astype(np.int32)
            left_total[better] = left[better, cut[better]]
        splits = best - explained > 1e-12 * np.abs(explained)
        node["feature"][~splits], node["bin"][~splits] = -1, -1
        node["gain"][splits] = ((best - explained) / weight)[splits]
        rank = np.cumsum(splits) - 1
        node["left"][splits] = first + k + 2 * rank[splits]
        first += k
        children = np.stack([left_total[splits], total[splits] - left_total[splits]], 1).reshape(-1, kinds)
        if level + 1 < depth:
            if not splits.all():
                stays = splits[slot]
                x, y, c, slot = x[stays], y[stays], c[stays], slot[stays]
                flat = x.reshape(-1)
            for a in range(0, len(x), BLOCK):
                at = slot[a:a + BLOCK]
                goes = flat[np.arange(a * features, (a + len(at)) * features, features) + node["feature"][at]] > node["bin"][at]
                slot[a:a + BLOCK] = 2 * rank[at] + goes
        total = children
    return _tidy({name: np.concatenate([n[name] for n in levels]) for name in levels[0]}, class_weight)


def _tidy(tree: dict[str, np.ndarray], class_weight: np.ndarray | None) -> dict[str, np.ndarray]:
    """Values of the nodes: class shares, or the mean; sibling leaves of one prediction become their parent, as in Spark ML."""
    total, left = tree["total"], tree["left"]
    if class_weight is not None:
        stats = total * class_weight
        tree["weight"] = stats.sum(1)
        tree["value"] = stats / np.maximum(tree["weight"], 1e-300)[:, None]
        prediction = stats.argmax(1)
    else:
        tree["weight"] = total[:, 0]
        tree["value"] = total[:, 1:] / np.maximum(total[:, :1], 1e-300)
        prediction = tree["value"][:, 0]
    while True:
        inner = np.flatnonzero(left >= 0)
        a = left[inner]
        same = inner[(left[a] < 0) & (left[a + 1] < 0) & (prediction[a] == prediction[a + 1])]
        if not len(same):
            break
        left[same], tree["gain"][same], tree["feature"][same], tree["bin"][same] = -1, -1.0, -1, -1
    kept, at = np.zeros(len(left), bool), np.zeros(1, np.int64)
    while len(at):
        kept[at] = True
        a = left[at][left[at] >= 0]
        at = np.concatenate([a, a + 1])
    name = np.cumsum(kept) - 1
    tree = {k: v[kept] for k, v in tree.items()}
    tree["left"] = np.where(tree["left"] >= 0, name[tree["left"]], -1)
    return tree


def _pack(features: int):
    schema = pa.schema([("part", pa.int32()), ("chunk", pa.int32()), ("n", pa.int64()), ("x", pa.binary()), ("y", pa.binary()),
                        ("values", pa.list_(pa.binary())), ("counts", pa.list_(pa.binary()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, chunk, xs, ys, held = TaskContext.get().partitionId(), 0, [], [], 0

        def out(x, y):
            found = [points(x[:, f]) for f in range(features)]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(
                (part, chunk, len(x), x.tobytes(), y.tobytes(), [v.astype(np.float64).tobytes() for v, _ in found],
                 [n.astype(np.int64).tobytes() for _, n in found]), schema.types)], schema=schema)

        for batch in batches:
            xs.append(batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, features))
            ys.append(batch.column(1).to_numpy(zero_copy_only=False))
            held += batch.num_rows
            while held >= CHUNK:
                x, y = np.concatenate(xs), np.concatenate(ys)
                yield out(x[:CHUNK], y[:CHUNK])
                xs, ys, held, chunk = [x[CHUNK:]], [y[CHUNK:]], held - CHUNK, chunk + 1
        if held:
            yield out(np.concatenate(xs), np.concatenate(ys))

    return run, "part int, chunk int, n long, x binary, y binary, values array<binary>, counts array<binary>"


def _binned(cuts: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                x = np.frombuffer(batch.column(3)[k].as_py(), np.float64).reshape(-1, len(cuts))
                own = np.stack([np.searchsorted(cut, x[:, f]) for f, cut in enumerate(cuts)], 1).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([batch.column(0)[k:k + 1], batch.column(1)[k:k + 1], pa.array([own.tobytes()]),
                                                  batch.column(4)[k:k + 1]], ["part", "chunk", "x", "y"])
    return run, "part int, chunk int, x binary, y binary"


def _trees(places: dict, n: int, cuts: list[np.ndarray], of_group: list[list[int]], seed: int, class_weight, **how):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, y, group = None, None, None
        for batch in batches:
            if x is None:
                x, y = np.empty((n, len(cuts)), np.uint8), np.empty(n, np.float64 if class_weight is None else np.uint8)
            for k in range(batch.num_rows):
                group = batch.column(0)[k].as_py()
                a, size = places[batch.column(1)[k].as_py(), batch.column(2)[k].as_py()]
                x[a:a + size] = np.frombuffer(batch.column(3)[k].as_py(), np.uint8).reshape(-1, len(cuts))
                y[a:a + size] = np.frombuffer(batch.column(4)[k].as_py(), np.float64)
        for t in of_group[group] if group is not None else []:
            tree = grow(x, y, rng=np.random.Generator(np.random.SFC64([seed & 0xFFFFFFFF, t])), class_weight=class_weight, **how)
            inner = tree["left"] >= 0
            gains = np.bincount(tree["feature"][inner], tree["gain"][inner] * tree["weight"][inner], len(cuts))
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (
                t, np.where(inner, tree["feature"], 0).astype(np.uint16).tobytes(), np.where(inner, tree["bin"], 255).astype(np.uint8).tobytes(),
                np.where(inner, tree["left"], np.arange(len(inner))).astype(np.int32).tobytes(), tree["value"].astype(np.float64).tobytes(),
                gains.tobytes())], ["tree", "feature", "bin", "left", "value", "gains"])

    return run, "tree long, feature binary, bin binary, left binary, value binary, gains binary"


class Trees:
    """Packed trees: per node a feature, a bin, the left child (a leaf's is itself; the right one follows) and values."""

    def __init__(self, cuts: list[np.ndarray], trees: list[tuple], width: int, depth: int):
        self.cuts, self.trees, self.width, self.depth = cuts, trees, width, depth

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(cut, x[:, f]) for f, cut in enumerate(self.cuts)], 1).astype(np.uint8)

    def values(self, x: np.ndarray) -> np.ndarray:
        """Mean over the trees of the values of the leaf of each row."""
        out = np.zeros((len(x), self.width))
        blocks = [(a, min(a + SCORED, len(x))) for a in range(0, len(x), SCORED)]
        features = len(self.cuts)
        flats = [self.bins(x[a:b]).reshape(-1) for a, b in blocks]
        for feature, cut, left, value in self.trees:
            for (a, b), flat in zip(blocks, flats):
                node, base = np.zeros(b - a, np.int32), np.arange(0, (b - a) * features, features)
                for _ in range(self.depth):
                    at = base + feature[node]
                    node = left[node] + (flat[at] > cut[node])
                out[a:b] += value[node]
        return out / len(self.trees)


class GrownModel:
    """``transform`` and ``featureImportances`` as Spark ML's forest has them, scored in numpy."""

    def __init__(self, trees: Trees, gains: np.ndarray, classes: int, features_col: str):
        self.trees, self.gains, self.classes, self.features_col = trees, gains, classes, features_col

    @property
    def getNumTrees(self) -> int:  # noqa: N802
        return len(self.trees.trees)

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802
        each = self.gains / np.maximum(self.gains.sum(1, keepdims=True), 1e-300)
        total = each.sum(0)
        return DenseVector(total / max(total.sum(), 1e-300))

    def scored(self, df: DataFrame, prediction: str) -> DataFrame:
        trees = self.trees

        @F.arrow_udf("array<double>")
        def values(x: pa.Array) -> pa.Array:
            found = trees.values(x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)) if len(x) else np.zeros((0, trees.width))
            return pa.ListArray.from_arrays(np.arange(0, found.size + 1, trees.width, dtype=np.int32), pa.array(found.reshape(-1)))

        out = df.withColumn("__values", values(vector_to_array(self.features_col)))
        if not self.classes:
            return out.withColumn(prediction, F.col("__values")[0]).drop("__values")
        return (out.withColumn("rawPrediction", array_to_vector(F.transform("__values", lambda p: p * self.getNumTrees)))
                .withColumn("probability", array_to_vector("__values"))
                .withColumn(prediction, (F.array_position("__values", F.array_max("__values")) - 1).cast("double")).drop("__values"))


def class_weights(df: DataFrame, label: str, weight: str | None) -> np.ndarray | None:
    """The weight of every class, or None where labels are no small classes or rows of a class differ in it."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    seen = df.groupBy(F.col(label).cast("double").alias("y")).agg(F.min(w).alias("a"), F.max(w).alias("b")).limit(65).collect()
    if len(seen) > 64 or any(r["y"] is None or r["y"] != int(r["y"]) or not 0 <= r["y"] < 64 or r["a"] is None or r["a"] != r["b"] for r in seen):
        return None
    out = np.zeros(max(2, 1 + int(max(r["y"] for r in seen))))
    for r in seen:
        out[int(r["y"])] = r["a"]
    return out


def subset_size(strategy: str, features: int, trees: int, classes: bool) -> int | None:
    """Features looked at in a node, as Spark ML counts them for its default."""
    if strategy != "auto":
        return None
    return features if trees == 1 else int(np.ceil(np.sqrt(features) if classes else features / 3))


def grown(estimator, rows: DataFrame, n: int, cores: int):
    """The estimator's model over ``rows`` (dealt, of ``n`` rows), or None where this way is not open."""
    e, classes = estimator, hasattr(estimator, "getProbabilityCol")
    weight = e.getWeightCol() if e.isSet("weightCol") else None
    features = rows.select(F.size(vector_to_array(e.getFeaturesCol())).alias("k")).first()["k"]
    subset = subset_size(e.getFeatureSubsetStrategy(), features, e.getNumTrees(), classes)
    plain = (e.getSubsamplingRate() == 1.0 and e.getBootstrap() and e.getMinInfoGain() == 0 and e.getMinWeightFractionPerNode() == 0
             and e.getImpurity() == ("gini" if classes else "variance") and e.getMaxBins() <= 255 and e.getMaxDepth() <= 24)
    if n * features > TASK_CELLS or subset is None or not plain or (weight and not classes):
        return None
    per_class = class_weights(rows, e.getLabelCol(), weight) if classes else None
    if classes and per_class is None:
        return None
    run, schema = _pack(features)
    packed = materialize(rows.select(vector_to_array(e.getFeaturesCol()).alias("x"), F.col(e.getLabelCol()).cast("double").alias("y"))
                         .mapInArrow(run, schema), "forest-rows")
    chunks = sorted(packed.select("part", "chunk", "n", "values", "counts").collect(), key=lambda r: (r["part"], r["chunk"]))
    cuts = [thresholds(np.concatenate([np.frombuffer(r["values"][f], np.float64) for r in chunks]),
                       np.concatenate([np.frombuffer(r["counts"][f], np.int64) for r in chunks]), e.getMaxBins()) for f in range(features)]
    starts = np.cumsum([0] + [r["n"] for r in chunks]).tolist()
    places = {(r["part"], r["chunk"]): (a, r["n"]) for r, a in zip(chunks, starts)}
    trees = e.getNumTrees()
    groups = min(trees, 2 * cores)
    run, schema = _binned(cuts)
    binned = packed.mapInArrow(run, schema).withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    run, schema = _trees(places, starts[-1], cuts, [list(range(g, trees, groups)) for g in range(groups)], e.getSeed(), per_class,
                         bins=max(2, 1 + max(len(c) for c in cuts)), depth=e.getMaxDepth(), subset=subset, least=e.getMinInstancesPerNode())
    packed_trees = (binned.select("group", "part", "chunk", "x", "y").repartitionById(groups, F.col("group").cast("int"))
                    .mapInArrow(run, schema))
    rows = sorted(packed_trees.collect(), key=lambda r: r["tree"])      # the model: one row a tree
    width = len(per_class) if classes else 1
    model = Trees(cuts, [(np.frombuffer(r["feature"], np.uint16), np.frombuffer(r["bin"], np.uint8), np.frombuffer(r["left"], np.int32),
                          np.frombuffer(r["value"], np.float64).reshape(-1, width)) for r in rows], width, e.getMaxDepth())
    return GrownModel(model, np.array([np.frombuffer(r["gains"], np.float64) for r in rows]), width if classes else 0, e.getFeaturesCol())
