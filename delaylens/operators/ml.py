"""Feature preparation and model fitting (J-family) on Spark ML.

Splits are decided per row from a hash of all columns and a seed, so they
are repeatable under any partitioning and need no shuffle or global sort.
Training is distributed by Spark ML (tree induction aggregates split
statistics across executors); only model parameters reach the driver."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (GBTRegressor, IsotonicRegression, LinearRegression,
                                   RandomForestRegressor)
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaylens.functions.guards import numeric_columns
from delaylens.operators.forest import Boosted, EarlyStopped, Forest, side_by_side
from delaylens.operators.isotonic import isotonic_blocks
from delaylens.operators.tables import few_rows
from delaylens.session import materialize

#: memory for split statistics per pass of tree induction: fewer passes over the rows per level
TREE_MEMORY_MB = 512
#: the same for classification forests: statistics of this size are filled faster than larger ones, passes included
FOREST_MEMORY_MB = 128


def label_codes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, label, code): labels of each column ranked by text, from 0.
    The distinct labels are range-partitioned; a label's code is its place in
    its partition plus the labels of the partitions before, so neither the
    driver nor one task holds them all. A written table."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c).cast("string"), F.lit("nan"))
                                         .alias("label")) for c in cols]))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    labels = materialize(df.select(pairs.alias("p")).select("p.*").distinct().repartitionByRange(parts, "column", "label")
                         .withColumn("part", F.spark_partition_id()), "labels")
    inside = F.row_number().over(Window.partitionBy("column", "part").orderBy("label")) - 1
    before = Window.partitionBy("column").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = labels.groupBy("column", "part").agg(F.count(F.lit(1)).alias("n"))
    first = counts.select("column", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    return materialize(labels.withColumn("inside", inside).join(first, ["column", "part"])
                       .select("column", "label", (F.col("first") + F.col("inside")).cast("double").alias("code")), "label-codes")


def label_encode(df: DataFrame, cols: Sequence[str], suffix: str = "_Encoded",
                 fit_on: DataFrame | None = None) -> DataFrame:
    """codes = rank of the value in sorted text; nulls become the
    text 'nan' (as after a CSV round trip). Fitted on ``fit_on`` (all rows
    by default, as the original does); a label not seen there gets the code
    after the last. Codes are plain numbers without nominal metadata (T14)
    and are joined back per column, by broadcast while a count shows few."""
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df
    codes = label_codes(fit_on if fit_on is not None else df, cols)
    out = df
    for c in cols:
        own = codes.where(F.col("column") == c)
        code = few_rows(own.select(F.col("label").alias("__label"), F.col("code").alias(f"{c}{suffix}")))
        out = (out.withColumn("__text", F.coalesce(F.col(c).cast("string"), F.lit("nan")))
               .join(code, F.col("__text") == F.col("__label"), "left").drop("__text", "__label")
               .withColumn(f"{c}{suffix}", F.coalesce(F.col(f"{c}{suffix}"), own.agg(F.count(F.lit(1)).cast("double")).scalar())))
    return out


# ---- J1-J6: assembly, splits, scaling, weights ------------------------------

def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    """J1 (+B8): nulls -> 0 in the feature columns, then one vector column."""
    feats = list(features)
    num = set(numeric_columns(df))
    filled = df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in feats if c in num})
    return VectorAssembler(inputCols=feats, outputCol=out, handleInvalid="error").transform(filled)


HASH_BITS = 48


def hash_place(df: DataFrame, seed: int, cols: Sequence[str] | None = None) -> Column:
    """48 bits of a seeded hash of the row, the same in every engine that has md5."""
    cols = list(cols) if cols else [c for c, t in df.dtypes if not t.startswith("vector")]
    key = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in cols])
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long")


def hash_unit(df: DataFrame, seed: int, cols: Sequence[str] | None = None) -> Column:
    """A uniform number in [0, 1) from a hash of the row and a seed. Splits of
    a split need seeds of their own, else the second one repeats the first."""
    return hash_place(df, seed, cols) / F.lit(float(1 << HASH_BITS))


def time_split(df: DataFrame, train_years: Sequence[int], test_years: Sequence[int], year: str = "Year",
               out: str = "split") -> DataFrame:
    """J2: 'train' / 'test' by year; rows in neither are dropped."""
    y = F.col(year)
    return (df.withColumn(out, F.when(y.isin(*train_years), "train").when(y.isin(*test_years), "test"))
            .where(F.col(out).isNotNull()))


def random_split(df: DataFrame, frac: float = 0.8, seed: int = 42, out: str = "split",
                 cols: Sequence[str] | None = None) -> DataFrame:
    """Hash split, ``frac`` train."""
    return df.withColumn(out, F.when(hash_unit(df, seed, cols) < frac, "train").otherwise("test"))


def stratified_split(df: DataFrame, label: str, frac: float = 0.8, seed: int = 42, out: str = "split",
                     cols: Sequence[str] | None = None, buckets: int = 4096) -> DataFrame:
    """Of every class the ``frac`` share (rounded) that comes first by a
    seeded hash is 'train'. Per class the counts of ``buckets`` hash ranges
    tell in which range the cut falls; only that range is counted hash by
    hash, so no class is sorted in one task. The cuts are one row a class and
    broadcast: a shuffle by class would send the rows to as many tasks as there
    are classes. Rows with equal hashes (equal ``cols``) go together; null is a
    class of its own."""
    width = (1 << HASH_BITS) // buckets
    rows = df.withColumns({"__place": hash_place(df, seed, cols), "__class": F.coalesce(F.col(label).cast("string"), F.lit("null"))})
    rows = rows.withColumn("__range", F.floor(F.col("__place") / width))
    before = Window.partitionBy("__class").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("__class")
    counts = rows.groupBy("__class", "__range").agg(F.count(F.lit(1)).alias("__n"))
    cut = (counts.withColumns({"__before": F.coalesce(F.sum("__n").over(before), F.lit(0)),
                               "__goal": F.round(F.sum("__n").over(whole) * F.lit(frac))})
           .where((F.col("__before") < F.col("__goal")) & (F.col("__goal") <= F.col("__before") + F.col("__n")))
           .select("__class", "__range", (F.col("__goal") - F.col("__before")).alias("__need")))
    inside = rows.join(F.broadcast(cut), ["__class", "__range"]).groupBy("__class", "__place", "__need").agg(F.count(F.lit(1)).alias("__n"))
    upto = Window.partitionBy("__class").orderBy("__place").rowsBetween(Window.unboundedPreceding, -1)
    last = (inside.withColumn("__before", F.coalesce(F.sum("__n").over(upto), F.lit(0)))
            .where(F.col("__before") < F.col("__need")).groupBy("__class").agg(F.max("__place").alias("__last")))
    return (rows.join(F.broadcast(last), "__class", "left")
            .withColumn(out, F.when(F.col("__place") <= F.col("__last"), "train").otherwise("test"))
            .drop("__class", "__place", "__range", "__last"))


def standard_scale(train: DataFrame, df: DataFrame, input_col: str = "features",
                   output_col: str = "scaled"):
    """Z-score fitted on train only (Spark uses ddof=1)."""
    m = StandardScaler(inputCol=input_col, outputCol=output_col, withMean=True, withStd=True).fit(train)
    return m, m.transform(df)


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """weight = n / (k * n_class). The class table has one row per class
    and is broadcast: a shuffle by class would end in as many tasks as classes."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("__nc"))
    n = counts.agg(F.sum("__nc")).scalar()
    k = counts.agg(F.count(F.lit(1))).scalar()
    w = counts.select(label, (n / (k * F.col("__nc"))).cast("double").alias(out))
    return df.join(F.broadcast(w), label, "left")


# ---- J7-J10: classifiers, selection, calibration -----------------------------

def rf_classifier(num_trees: int = 200, max_depth: int = 10, seed: int = 42, label: str = "label",
                  weight: str | None = None, min_instances: int = 1, max_bins: int = 32):
    """J7 (min_samples_split=20 is approximated by minInstancesPerNode=10); grown in groves."""
    p = dict(featuresCol="features", labelCol=label, numTrees=num_trees, maxDepth=max_depth, seed=seed,
             minInstancesPerNode=min_instances, maxBins=max_bins, maxMemoryInMB=FOREST_MEMORY_MB)
    if weight:
        p["weightCol"] = weight
    return Forest(RandomForestClassifier(**p))


def gbt_classifier(max_iter: int = 300, max_depth: int = 6, step: float = 0.07, seed: int = 42,
                   label: str = "label", weight: str | None = None, subsample: float = 0.8, early: bool = True,
                   colsample: float = 0.8):
    """Gradient-boosted trees in place of the external boosting engines, on a ``subsample``
    of the rows a round and a ``colsample`` of the features a split. With ``early`` at most
    ``max_iter`` rounds, fewer once a held-out tenth gains nothing more; without, as in the
    original, all rounds on all rows."""
    p = dict(featuresCol="features", labelCol=label, maxIter=max_iter, maxDepth=max_depth, stepSize=step,
             subsamplingRate=subsample, featureSubsetStrategy=str(float(colsample)), seed=seed)
    if weight:
        p["weightCol"] = weight
    return EarlyStopped(GBTClassifier(**p), seed=seed) if early else Boosted(GBTClassifier(**p))


def prob1(col: str = "probability") -> Column:
    """P(class 1) from a probability vector."""
    return vector_to_array(F.col(col))[1]


@dataclass
class CalibratedModel:
    """``folds`` (base model, isotonic map) pairs; the score is the
    mean of the calibrated fold probabilities."""
    parts: list = field(default_factory=list)

    def transform(self, df: DataFrame, out: str = "score") -> DataFrame:
        cols = []
        cur = df
        for i, (base, iso) in enumerate(self.parts):
            scored = base.transform(cur).withColumn(f"__p{i}", prob1())
            scored = scored.drop("rawPrediction", "probability", "prediction")
            cur = iso.transform(scored).withColumnRenamed("__iso", f"__c{i}")
            cols.append(f"__c{i}")
        return cur.withColumn(out, sum((F.col(c) for c in cols), F.lit(0.0)) / len(cols)).drop(
            *cols, *[f"__p{i}" for i in range(len(self.parts))])

    @property
    def base_models(self) -> list:
        return [b for b, _ in self.parts]


def stratified_folds(df: DataFrame, label: str, k: int = 3, seed: int = 42, out: str = "__fold",
                     cols: Sequence[str] | None = None, buckets: int = 4096) -> DataFrame:
    """Deal every class's rows to ``k`` folds of equal size (within one row): by a
    seeded hash, cut at each k-th of the class. The cuts are found as in
    ``stratified_split``, from counts of hash ranges and then of the hashes in the
    ranges that hold a cut; they reach the rows as one small map by class. Rows with
    equal hashes (equal ``cols``) go together; null is a class of its own."""
    width = (1 << HASH_BITS) // buckets
    rows = df.withColumns({"__place": hash_place(df, seed, cols), "__class": F.coalesce(F.col(label).cast("string"), F.lit("null"))})
    ranged = rows.select("__place", "__class", F.floor(F.col("__place") / width).alias("__range"))
    before = Window.partitionBy("__class").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("__class")
    counts = ranged.groupBy("__class", "__range").agg(F.count(F.lit(1)).alias("__n"))
    cut = (counts.withColumns({"__before": F.coalesce(F.sum("__n").over(before), F.lit(0)), "__all": F.sum("__n").over(whole)})
           .withColumn("__cut", F.explode(F.sequence(F.lit(1), F.lit(k - 1))))
           .withColumn("__goal", F.round(F.col("__all") * F.col("__cut") / k))
           .where((F.col("__before") < F.col("__goal")) & (F.col("__goal") <= F.col("__before") + F.col("__n")))
           .select("__class", "__range", "__cut", (F.col("__goal") - F.col("__before")).alias("__need")))
    inside = (ranged.join(F.broadcast(cut), ["__class", "__range"]).groupBy("__class", "__cut", "__place", "__need").agg(F.count(F.lit(1)).alias("__n")))
    upto = Window.partitionBy("__class", "__cut").orderBy("__place").rowsBetween(Window.unboundedPreceding, -1)
    lasts = (inside.withColumn("__before", F.coalesce(F.sum("__n").over(upto), F.lit(0)))
             .where(F.col("__before") < F.col("__need")).groupBy("__class", "__cut").agg(F.max("__place").alias("__last"))
             .groupBy("__class").agg(F.collect_list("__last").alias("__lasts")))
    cuts = lasts.agg(F.map_from_entries(F.collect_list(F.struct("__class", "__lasts")))).scalar()     # k - 1 numbers a class
    return (rows.withColumn("__cuts", cuts)
            .withColumn("__own", F.coalesce(F.try_element_at("__cuts", F.col("__class")), F.array().cast("array<bigint>")))
            # a cut without rows before it lies below every place
            .withColumn(out, (F.lit(k - 1) - F.size(F.filter("__own", lambda x: x >= F.col("__place")))).cast("int"))
            .drop("__place", "__class", "__cuts", "__own"))


def fit_isotonic(scored: DataFrame, score: str, label: str) -> Model:
    """Isotonic map of a score on the mean label. Rows are combined by score, scores
    pooled range by range (``operators.isotonic``); the model is built from the ends
    of the blocks that are left, between which it interpolates."""
    means = scored.groupBy(score).agg(F.avg(F.col(label).cast("double")).alias("__mean"),
                                      F.count(F.lit(1)).cast("double").alias("__rows"))
    blocks = isotonic_blocks(means, score, "__mean", "__rows")
    ends = blocks.select(F.explode(F.array_distinct(F.array("lo", "hi"))).alias(score), (F.col("total") / F.col("weight")).alias("__mean"),
                         F.lit(1.0).alias("__rows"))
    return IsotonicRegression(featuresCol=score, labelCol="__mean", weightCol="__rows", predictionCol="__iso",
                              isotonic=True).fit(ends)


def fit_calibrated(estimator: Estimator, train: DataFrame, label: str = "label", folds: int = 3,
                   seed: int = 42, cols: Sequence[str] | None = None) -> CalibratedModel:
    """Per stratified fold, fit the estimator on the other folds and an isotonic
    map of its class-1 probability on the held-out fold; folds side by side."""
    t = materialize(stratified_folds(train, label, folds, seed, cols=cols), "folds")

    def one(i: int):
        base = estimator.copy().fit(t.where(F.col("__fold") != i))
        iso = fit_isotonic(base.transform(t.where(F.col("__fold") == i)).withColumn("__p", prob1()), "__p", label)
        iso.setFeaturesCol(f"__p{i}")
        return base, iso

    return CalibratedModel(side_by_side([lambda i=i: one(i) for i in range(folds)]))


def select_classifier(candidates: dict[str, Estimator], train: DataFrame, label: str = "label",
                      frac: float = 0.8, seed: int = 42, cols: Sequence[str] | None = None):
    """Fit each candidate on ``frac`` of train, score average precision
    on the rest; returns (best name, best estimator, metrics DataFrame).
    Raises when a part holds no rows of one class."""
    from delaylens.operators.evaluate import average_precision
    sp = stratified_split(train, label, frac, seed, cols=cols)
    kinds = {r["split"]: r["n"] for r in sp.groupBy("split").agg(F.count_distinct(label).alias("n")).collect()}
    if min(kinds.get("train", 0), kinds.get("test", 0)) < 2:
        raise ValueError(f"selection needs rows of both classes to fit and to validate on; classes per part: {kinds}")
    fit_part, val = sp.where(F.col("split") == "train").drop("split"), sp.where(F.col("split") == "test").drop("split")

    def one(name: str, est: Estimator):
        s = materialize(est.copy().fit(fit_part).transform(val).select(label, prob1().alias("score")), "selection-scored")
        return name, float(average_precision(s, label=label).first()[0])

    rows = side_by_side([lambda n=n, e=e: one(n, e) for n, e in candidates.items()])
    metrics = train.sparkSession.createDataFrame(rows, "model string, val_average_precision double")
    best = max(rows, key=lambda r: r[1])[0]
    return best, candidates[best], metrics


# ---- J13-J15: multiclass, two-stage, regressors ------------------------------

def rf_regressor(num_trees: int = 200, max_depth: int = 15, seed: int = 42, label: str = "y",
                 min_instances: int = 1, features: str = "features"):
    return Forest(RandomForestRegressor(featuresCol=features, labelCol=label, numTrees=num_trees, maxDepth=max_depth,
                                        seed=seed, minInstancesPerNode=min_instances, maxMemoryInMB=TREE_MEMORY_MB))


def gbt_regressor(max_iter: int = 200, max_depth: int = 8, step: float = 0.1, seed: int = 42,
                  label: str = "y", features: str = "features"):
    return Boosted(GBTRegressor(featuresCol=features, labelCol=label, maxIter=max_iter, maxDepth=max_depth,
                                stepSize=step, seed=seed))


def ridge(alpha: float, n: int, label_std_pop: float, label: str = "y", features: str = "features"):
    """Ridge with the original's alpha: Spark scales the objective by 1/n
    and the label by its std, so regParam = alpha / n * std_pop(label)."""
    return LinearRegression(featuresCol=features, labelCol=label, regParam=alpha / n * label_std_pop,
                            elasticNetParam=0.0, standardization=False)


def lasso(alpha: float, label: str = "y", features: str = "features"):
    """Lasso: regParam = alpha with elasticNetParam = 1."""
    return LinearRegression(featuresCol=features, labelCol=label, regParam=alpha, elasticNetParam=1.0,
                            standardization=False)


def two_stage(train: DataFrame, test: DataFrame, label: str = "label", minutes: str = "y",
              clf: Estimator | None = None, reg: Estimator | None = None) -> DataFrame:
    """Classify delayed or not; for predicted-delayed rows predict the
    minutes with a regressor trained on delayed train rows; else 0."""
    clf = clf or rf_classifier(100, 8, label=label, min_instances=10)
    reg = reg or rf_regressor(100, 8, label=minutes, min_instances=10)
    cm = clf.fit(train)
    rm = reg.setPredictionCol("__minutes").fit(train.where(F.col(label) == 1))
    s = cm.transform(test).withColumn("score", prob1()).drop("rawPrediction", "probability")
    s = rm.transform(s)
    return s.withColumn("predicted_minutes", F.when(F.col("prediction") == 1, F.col("__minutes")).otherwise(0.0)) \
        .drop("__minutes")


def feature_importance(model: Model, names: Sequence[str], n: int | None = None):
    """Impurity importances zipped with the feature names (a vector of
    #features on the driver), as a DataFrame sorted descending."""
    imp = model.featureImportances.toArray().tolist()
    rows = sorted(zip(names, imp), key=lambda r: (-r[1], r[0]))
    if n:
        rows = rows[:n]
    return rows
