"""Model runs: input, guard, splits, thresholds, folds and pooled calibration."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import functions as F

from delaylens.operators import evaluate as K, ml as M
from delaylens.plans import modeling as MD, params as P
from delaylens.plans.inputs import KEYS
from delaylens.plans.preprocess import preprocess_complete
from delaylens.sources.files import sample_n
from delaylens.sources.flights import raw_flights

SF = "/root/testdata/sf0.001"


def test_runs_start_from_the_whole_cleaned_table(spark):
    want = preprocess_complete(raw_flights(spark, SF))[0].count()
    frame = MD.model_frame(spark, SF)
    assert frame.count() == want
    assert frame.where(F.col("Year").isin(*P.EXCLUDE_YEARS)).count() == 0
    assert MD.operational_data(spark, SF).count() == want


def test_guard_sees_gap_years(spark):
    left_in = spark.createDataFrame([(1996,), (P.GAP_YEARS[0],)], "Year int")
    with pytest.raises(AssertionError):
        MD.guarded(left_in)
    with pytest.raises(AssertionError):
        MD.model_frame(spark, SF, cleaned=left_in)
    assert MD.guarded(left_in.where("Year = 1996")).count() == 1


def test_stratified_split_is_exact_and_repeatable(spark):
    df = spark.range(5000).withColumn("c", F.when(F.col("id") % 10 == 0, "rare").when(F.col("id") % 1000 == 1, None).otherwise("hot"))
    split = M.stratified_split(df, "c", 0.8, 3, cols=["id"])
    got = {(r["c"], r["split"]): r["count"] for r in split.groupBy("c", "split").count().collect()}
    assert got == {("rare", "train"): 400, ("rare", "test"): 100, ("hot", "train"): 3596, ("hot", "test"): 899,
                   (None, "train"): 4, (None, "test"): 1}
    again = M.stratified_split(df.repartition(7), "c", 0.8, 3, cols=["id"], buckets=16)
    assert split.select("id", "split").exceptAll(again.select("id", "split")).isEmpty()
    assert M.stratified_split(df.limit(0), "c").count() == 0


def test_inner_split_of_the_realistic_run_has_both_parts(spark):
    outer = M.stratified_split(MD.model_frame(spark, SF), "IsDelayed", 0.8, P.SEED, cols=KEYS)
    train = outer.where("split = 'train'").drop("split")
    inner = M.stratified_split(train, "IsDelayed", 0.8, P.SEED + 1, cols=KEYS)
    n = {r["split"]: r["count"] for r in inner.groupBy("split").count().collect()}
    assert abs(n["test"] / (n["test"] + n["train"]) - 0.2) < 0.01


def test_sample_n_is_fine_grained(spark):
    df = spark.range(20_000)
    assert abs(sample_n(df, 100).count() - 100) < 50
    assert sample_n(df, 10 ** 9).count() == 20_000


def test_threshold_needs_both_classes(spark):
    for rows in ([], [(1.0, 0.5)], [(0.0, 0.5)]):
        with pytest.raises(Exception, match="both classes"):
            K.threshold_for_recall(spark.createDataFrame(rows, "label double, score double")).collect()


def test_selection_needs_both_classes(spark):
    df = M.assemble(spark.createDataFrame(pd.DataFrame({"x": np.arange(50.0), "label": np.zeros(50)})), ["x"])
    with pytest.raises(ValueError, match="classes"):
        M.select_classifier({"RF": M.rf_classifier(2, 2)}, df, cols=["x"])


def test_fold_metrics_against_counts(spark):
    rng = np.random.default_rng(3)
    score = rng.random(400).round(2)
    label = (rng.random(400) < score).astype(float)
    thr, precision, recall, *_ = MD.fold_metrics(spark.createDataFrame(pd.DataFrame({"label": label, "score": score})))
    called = score >= thr
    assert precision == pytest.approx(label[called].mean()) and recall == pytest.approx(label[called].sum() / label.sum())
    assert recall >= 0.8 and MD.FOLD_METRICS[:3] == ["threshold", "precision", "recall"]


def test_pooled_isotonic_equals_row_fit(spark):
    rng = np.random.default_rng(1)
    p = rng.integers(0, 20, 2000) / 20.0
    df = spark.createDataFrame(pd.DataFrame({"__p": p, "label": (rng.random(2000) < p).astype(float)}))
    rows = IsotonicRegression(featuresCol="__p", labelCol="label", predictionCol="a").fit(df)
    pooled = M.fit_isotonic(df, "__p", "label")
    grid = spark.createDataFrame([(x / 50,) for x in range(51)], "__p double")
    out = pooled.transform(rows.transform(grid)).toPandas()
    assert np.allclose(out["a"], out["__iso"], atol=1e-9)


def test_label_encode_many_labels(spark):
    df = spark.range(100_000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("x"))
    out = M.label_encode(df, ["x"])
    want = {v: float(i) for i, v in enumerate(sorted(f"k{i}" for i in range(100_000)))}
    got = {r["x"]: r["x_Encoded"] for r in out.collect()}
    assert got == want


def test_label_encode_unseen_label(spark):
    seen = spark.createDataFrame([("b",), ("a",)], "x string")
    out = {r["x"]: r["x_Encoded"] for r in M.label_encode(spark.createDataFrame([("a",), ("z",)], "x string"), ["x"], fit_on=seen).collect()}
    assert out == {"a": 0.0, "z": 2.0}


def test_same_model_however_the_input_lies(spark):
    frame = MD.model_frame(spark, SF).where(F.col("Year").isin(*P.TRAIN_YEARS))

    def scores(df):
        data = MD._prep(df, MD.OPERATIONAL, "lies", parts=4)
        model = M.rf_classifier(5, 4).fit(data)
        return model.transform(data).select(*KEYS, M.prob1().alias("p")).toPandas().sort_values([*KEYS, "p"])["p"].to_numpy()

    assert np.allclose(scores(frame), scores(frame.repartition(13)))


def test_examples_carry_when_and_minutes(spark):
    rows = spark.createDataFrame([(i, 1, 2, 3, "A", "B", 5, 1, "Winter", 12.0, 0.5, 1.0, 1) for i in range(30)],
                                 "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, OriginCity string, DestCity string, "
                                 "CRSDepTimeHour int, DayOfWeek int, Season string, DepDelayMinutes double, score double, label double, prediction int")
    out = MD.example_predictions(rows, 10)
    assert out.count() == 10 and {"DayOfWeek", "Season", "DepDelayMinutes", "CRSDepTimeHour"} <= set(out.columns)


def test_operational_tables_cover_all_rows(spark):
    cleaned = MD.cleaned_table(spark, SF)
    tables = MD.operational_tables(cleaned)
    delayed = cleaned.where("DepDelayMinutes > 0").count()
    assert tables["operational_means"].first()["Delayed_Count"] == delayed
    assert set(tables) == {"cause_report", "operational_means", "worst_hours", "top_routes", "problem_routes"}


def test_mean_importance_averages_folds(spark):
    class Fold:
        def __init__(self, v):
            self.featureImportances = type("V", (), {"toArray": lambda s: np.array(v)})()
    assert MD.mean_importance([Fold([0.2, 0.8]), Fold([0.4, 0.6])], ["a", "b"]) == [("b", pytest.approx(0.7)), ("a", pytest.approx(0.3))]
