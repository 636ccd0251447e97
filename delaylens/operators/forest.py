"""Random forests grown as groves, and boosting that stops early.

Tree induction shuffles the statistics of every open node once per task and
level, and sends every task the trees so far; in deep forests these outweigh the
rows by far. A forest is therefore fitted on as many partitions as its rows ask for
(``TASK_ROWS`` rows each, or ``NODE_ROWS`` for every node of the deepest level), at
most one a core unless they would hold over ``PART_ROWS`` rows each, and the trees are dealt into groves that grow side by side, each
with a seed of its own: as many as fill cores that would stay idle, and up to
``OVERLAP``, as between the passes of one grove the driver alone works. While groves
grow, Spark keeps numbers per row and tree: beyond ``CORE_CELLS`` rows times trees a
core the forest grows in more groves, fewer of them at a time. Trees, depth and rows stay the
same: the forest's class probabilities, predictions and importances are means over
trees, so groves are averaged by their number of trees.

Rows are dealt to partitions by a hash of their values and sorted, so a model
does not depend on how its input lay.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylens.operators import grown as G

#: rows a task scans in one pass of tree induction before another partition pays off
TASK_ROWS = 50_000
#: rows that a task sorts at most when rows are dealt
PART_ROWS = 1_000_000
#: rows of a task for every node that the deepest level may hold
NODE_ROWS = 50
#: rows times trees of a grove for every core, of which bagging and node ids keep 4 bytes each
CORE_CELLS = 25_000_000
#: depth up to which a row's node is remembered from level to level; deeper forests take many
#: passes a level, and the chain of updates outweighs the walk from the root
CACHED_DEPTH = 12
#: shares of the rounds that boosting tries in turn
STAGES = (0.15, 0.4, 1.0)
#: trees of a grove at least
GROVE_TREES = 12
#: groves that grow at the same time where all cores have rows of each
OVERLAP = 4


def side_by_side(jobs: Sequence, at_once: int = 4) -> list:
    """Run independent fits in threads of the driver: tree induction is many
    short jobs, and fits that overlap keep the executors busy."""
    with ThreadPoolExecutor(max_workers=max(1, min(at_once, len(jobs)))) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(j)) for j in jobs]]


def cores(df: DataFrame) -> int:
    try:
        return max(1, df.sparkSession.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001 - sessions without a SparkContext handle
        return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def dealt(df: DataFrame, columns: Sequence[str], parts: int) -> DataFrame:
    """The columns in ``parts`` partitions by a hash of the row, sorted by it."""
    kinds = dict(df.dtypes)
    key = F.xxhash64(*[vector_to_array(F.col(c)) if kinds[c].startswith("vector") else F.col(c) for c in columns])
    rows = df.select(*columns, key.alias("__key"))
    return rows.repartition(parts, "__key").sortWithinPartitions("__key", *[c for c in columns if not kinds[c].startswith("vector")]).drop("__key")


def sortable(n: int, parts: int) -> int:
    """``parts``, or as many as keep the ``n`` rows at ``PART_ROWS`` a partition: what a
    task holds while it sorts stays as large when the input grows."""
    return max(parts, -(-n // PART_ROWS))


def layout(n: int, trees: int, depth: int, have: int, task_rows: int | None = None) -> tuple[int, int, int]:
    """Partitions, groves and groves at a time for ``n`` rows on ``have`` cores."""
    parts = max(1, min(have, -(-n // (task_rows or max(TASK_ROWS, NODE_ROWS << depth)))))
    beside = max(1, min(have // parts, trees // GROVE_TREES))
    parts = max(parts, min(have // beside, -(-n // (task_rows or TASK_ROWS))))     # too few trees to fill the cores
    overlap = min(OVERLAP, trees // GROVE_TREES, CORE_CELLS * have // max(1, n * GROVE_TREES))
    beside = max(beside, overlap)
    return parts, max(beside, min(trees, -(-n * trees * beside // (CORE_CELLS * have)))), beside


class Forest:
    """An estimator: the given Spark ML forest, grown in groves."""

    def __init__(self, inner, task_rows: int | None = None):
        self.inner, self.task_rows = inner, task_rows

    def copy(self) -> Forest:
        return Forest(self.inner.copy(), self.task_rows)

    def extractParamMap(self) -> dict:  # noqa: N802 - named as in Spark ML
        return self.inner.extractParamMap()

    def setPredictionCol(self, name: str) -> Forest:  # noqa: N802
        self.inner.setPredictionCol(name)
        return self

    def fit(self, df: DataFrame) -> ForestModel:
        e = self.inner
        columns = [e.getFeaturesCol(), e.getLabelCol()] + ([e.getWeightCol()] if e.isSet("weightCol") else [])
        trees, depth = e.getNumTrees(), e.getMaxDepth()
        n = df.count()
        if n >= G.LEAST_ROWS:      # many rows that still fit a task: trees grow whole in tasks
            have = cores(df)
            model = G.grown(e, dealt(df, list(dict.fromkeys(columns)), sortable(n, max(1, min(have, -(-n // TASK_ROWS))))), n, have)
            if model is not None:
                return ForestModel([model], [trees], e.getPredictionCol())      # a grove of its own kind
        parts, groves, beside = layout(n, trees, depth, cores(df), self.task_rows)
        if not e.isSet("cacheNodeIds"):
            e = e.copy({e.cacheNodeIds: depth <= CACHED_DEPTH})
        rows = dealt(df, list(dict.fromkeys(columns)), sortable(n, parts)).persist(StorageLevel.MEMORY_AND_DISK)
        sizes = [trees // groves + (i < trees % groves) for i in range(groves)]
        grow = [e.copy({e.numTrees: size, e.seed: e.getSeed() + 7919 * i}) for i, size in enumerate(sizes)]
        try:
            return ForestModel(side_by_side([lambda g=g: g.fit(rows) for g in grow], at_once=beside), sizes, e.getPredictionCol())
        finally:
            rows.unpersist()


class ForestModel:
    """Groves as one model: ``transform`` and ``featureImportances`` as Spark ML's forest has them."""

    def __init__(self, groves: list, sizes: list[int], prediction: str):
        self.groves, self.sizes, self.prediction = groves, sizes, prediction
        self.classifies = hasattr(groves[0], "numClasses")

    @property
    def getNumTrees(self) -> int:  # noqa: N802
        return sum(self.sizes)

    @property
    def trees(self) -> list:
        return [t for g in self.groves for t in g.trees]

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802
        total = sum(g.featureImportances.toArray() * n for g, n in zip(self.groves, self.sizes))
        return DenseVector(total / max(total.sum(), 1e-300))

    def transform(self, df: DataFrame) -> DataFrame:
        if isinstance(self.groves[0], G.GrownModel):
            return self.groves[0].scored(df, self.prediction)
        if len(self.groves) == 1:
            return self.groves[0].setPredictionCol(self.prediction).transform(df)
        out, share = df, [n / sum(self.sizes) for n in self.sizes]
        names = [f"__grove{i}" for i in range(len(self.groves))]
        for grove, name in zip(self.groves, names):
            if self.classifies:
                grove = grove.copy().setPredictionCol("").setRawPredictionCol("").setProbabilityCol(name)
                out = grove.transform(out).withColumn(name, vector_to_array(name))
            else:
                out = grove.copy().setPredictionCol(name).transform(out)
        if not self.classifies:
            return out.withColumn(self.prediction, sum((F.col(c) * s for c, s in zip(names, share)), F.lit(0.0))).drop(*names)
        k = self.groves[0].numClasses
        mean = F.array(*[sum((F.col(c)[j] * s for c, s in zip(names, share)), F.lit(0.0)) for j in range(k)])
        out = out.withColumn("__mean", mean).drop(*names)
        return (out.withColumn("rawPrediction", array_to_vector(F.transform("__mean", lambda p: p * sum(self.sizes))))
                .withColumn("probability", array_to_vector("__mean"))
                .withColumn(self.prediction, (F.array_position("__mean", F.array_max("__mean")) - 1).cast("double")).drop("__mean"))


def boosting_parts(df: DataFrame) -> int:
    """Partitions for boosting, a row of thousands of short jobs: at most one a core, as
    every task of each job reports to the driver, while that can be sorted."""
    n = df.count()
    return sortable(n, max(1, min(cores(df), -(-n // TASK_ROWS))))


class Boosted:
    """An estimator: boosted trees on rows dealt into ``boosting_parts``."""

    def __init__(self, inner):
        self.inner = inner

    def copy(self) -> Boosted:
        return Boosted(self.inner.copy())

    def extractParamMap(self) -> dict:  # noqa: N802
        return self.inner.extractParamMap()

    def setPredictionCol(self, name: str) -> Boosted:  # noqa: N802
        self.inner.setPredictionCol(name)
        return self

    def fit(self, df: DataFrame):
        e = self.inner
        columns = list(dict.fromkeys([e.getFeaturesCol(), e.getLabelCol()] + ([e.getWeightCol()] if e.isSet("weightCol") else [])))
        rows = dealt(df, columns, boosting_parts(df)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return e.fit(rows)
        finally:
            rows.unpersist()


class EarlyStopped:
    """An estimator: boosted trees in growing numbers of rounds (``STAGES`` of the
    most), until the loss on a hash-chosen part of the rows (``share``), kept out of
    the fit, had its least before the last fifth of the rounds. Spark's own early stop
    ends at the first round without a gain, which row sampling brings about by chance."""

    def __init__(self, inner, share: float = 0.1, seed: int = 42):
        self.inner, self.share, self.seed = inner, share, seed

    def copy(self) -> EarlyStopped:
        return EarlyStopped(self.inner.copy(), self.share, self.seed)

    def extractParamMap(self) -> dict:  # noqa: N802
        return self.inner.extractParamMap()

    def setPredictionCol(self, name: str) -> EarlyStopped:  # noqa: N802
        self.inner.setPredictionCol(name)
        return self

    def fit(self, df: DataFrame):
        e = self.inner.copy()
        columns = list(dict.fromkeys([e.getFeaturesCol(), e.getLabelCol()] + ([e.getWeightCol()] if e.isSet("weightCol") else [])))
        kinds = dict(df.dtypes)
        place = F.pmod(F.xxhash64(*[vector_to_array(F.col(c)) if kinds[c].startswith("vector") else F.col(c) for c in columns],
                                  F.lit(self.seed)), F.lit(1000))
        parts = boosting_parts(df)
        rows = (dealt(df, columns, parts).withColumn("__validates", place < int(self.share * 1000))
                .persist(StorageLevel.MEMORY_AND_DISK))
        fits, kept_out = (rows.where(w) for w in (~F.col("__validates"), F.col("__validates")))
        try:
            for part in STAGES:
                rounds = max(1, round(part * e.getMaxIter()))
                model = e.copy({e.maxIter: rounds, e.checkpointInterval: 10}).fit(fits)
                if part == STAGES[-1] or kept_out.isEmpty():
                    return model
                losses = model.evaluateEachIteration(kept_out)
                if losses.index(min(losses)) + 1 <= 0.8 * rounds:
                    return model
        finally:
            rows.unpersist()
