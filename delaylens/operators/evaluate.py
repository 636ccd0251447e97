"""Evaluation tables (K-family) over one scored DataFrame with columns
``label`` (0/1), ``score`` (probability of class 1) and ``prediction``.

Threshold curves aggregate by distinct score first (a hot score is one
row) and take running totals with the two-level prefix sum, so no step
sorts the whole table in one task."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaylens.functions.prefix import running_totals


def score_fixture(df: DataFrame, threshold: float = 0.5, hour: str = "CRSDepTimeHour",
                  distance: str = "Distance", delay: str = "DepDelayMinutes") -> DataFrame:
    """Deterministic scores with heavy ties and bin-edge values (no model):
    label = delay > 0, score = ((hour*37 + distance) % 100) / 100."""
    score = ((F.col(hour) * 37 + F.col(distance).cast("bigint")) % 100).cast("double") / 100.0
    return df.select("*", F.when(F.col(delay) > 0, 1).otherwise(0).cast("int").alias("label"),
                     score.alias("score")).withColumn(
        "prediction", F.when(F.col("score") >= threshold, 1).otherwise(0).cast("int"))


def apply_threshold(df: DataFrame, threshold: float | Column, score: str = "score",
                    out: str = "prediction") -> DataFrame:
    """Score >= threshold -> 1 else 0."""
    t = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return df.withColumn(out, F.when(F.col(score) >= t, 1).otherwise(0).cast("int"))


def accuracy(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """K1."""
    return df.agg(F.avg(F.when(F.col(label) == F.col(pred), 1.0).otherwise(0.0)).alias("accuracy"))


def confusion_counts(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    y, p = F.col(label), F.col(pred)
    return df.agg(F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 0)).alias("tn"),
                  F.count_if((y == 0) & (p == 1)).alias("fp"), F.count_if((y == 1) & (p == 0)).alias("fn"))


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """K7: all four cells of the 2x2 matrix, zeros included."""
    c = confusion_counts(df, label, pred)
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    return c.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("actual"), F.lit(b).alias("predicted"), F.col(n).alias("count"))
        for a, b, n in cells])).alias("s")).select("s.*")


def _div(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def classification_report(df: DataFrame, label: str = "label", pred: str = "prediction",
                          classes: Sequence[int] | None = None) -> DataFrame:
    """K2: per-class precision, recall, F1 and support, then macro and
    weighted averages (zero division -> 0). Classes are the distinct
    labels and predictions (a bounded set) unless given."""
    y, p = F.col(label), F.col(pred)
    if classes is None:
        classes = sorted({int(r[0]) for r in df.select(y.alias("c")).union(df.select(p.alias("c")))
                          .distinct().collect() if r[0] is not None})
    aggs = []
    for k in classes:
        aggs += [F.count_if((y == k) & (p == k)).alias(f"tp{k}"), F.count_if(p == k).alias(f"pp{k}"),
                 F.count_if(y == k).alias(f"s{k}")]
    c = df.agg(*aggs)
    rows = []
    for k in classes:
        prec = _div(F.col(f"tp{k}"), F.col(f"pp{k}"))
        rec = _div(F.col(f"tp{k}"), F.col(f"s{k}"))
        f1 = _div(2 * prec * rec, prec + rec)
        rows.append(F.struct(F.lit(str(k)).alias("class"), prec.alias("precision"), rec.alias("recall"),
                             f1.alias("f1_score"), F.col(f"s{k}").alias("support")))
    per = c.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    summ = per.agg(
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1_score").alias("mf"),
        _div(F.sum(F.col("precision") * F.col("support")), F.sum("support")).alias("wp"),
        _div(F.sum(F.col("recall") * F.col("support")), F.sum("support")).alias("wr"),
        _div(F.sum(F.col("f1_score") * F.col("support")), F.sum("support")).alias("wf"),
        F.sum("support").alias("n"))
    extra = summ.select(F.explode(F.array(
        F.struct(F.lit("macro avg").alias("class"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                 F.col("mf").alias("f1_score"), F.col("n").alias("support")),
        F.struct(F.lit("weighted avg").alias("class"), F.col("wp").alias("precision"),
                 F.col("wr").alias("recall"), F.col("wf").alias("f1_score"), F.col("n").alias("support")),
    )).alias("r")).select("r.*")
    return per.unionByName(extra)


def macro_f1(df: DataFrame, label: str = "label", pred: str = "prediction",
             classes: Sequence[int] | None = None) -> DataFrame:
    """K11."""
    rep = classification_report(df, label, pred, classes)
    return rep.where(F.col("class") == "macro avg").select(F.col("f1_score").alias("macro_f1"))


def score_histogram(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(score, pos, neg) per distinct score."""
    return (df.where(F.col(score).isNotNull()).groupBy(F.col(score).cast("double").alias("score"))
            .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")))


def _cum_desc(df: DataFrame, label: str, score: str) -> DataFrame:
    h = score_histogram(df, label, score)
    return running_totals(h, "score", ["pos", "neg"], descending=True)


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """K3: area under ROC by the rank-sum identity, ties as mid-ranks:
    AUC = (R_pos - P(P+1)/2) / (P N)."""
    h = score_histogram(df, label, score).withColumn("t", F.col("pos") + F.col("neg"))
    cum = running_totals(h, "score", ["t"], inclusive=False, prefix="before_")
    a = cum.agg(F.sum(F.col("pos") * (F.col("before_t") + (F.col("t") + 1) / 2.0)).alias("r"),
                F.sum("pos").cast("double").alias("P"), F.sum("neg").cast("double").alias("N"))
    return a.select(F.try_divide(F.col("r") - F.col("P") * (F.col("P") + 1) / 2.0,
                                 F.col("P") * F.col("N")).alias("roc_auc"))


def pr_curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """K5: precision and recall at each distinct threshold (predict 1 when
    score >= threshold), plus the previous point for the trapezoid."""
    c = _cum_desc(df, label, score)
    P = F.col("__P")
    tot = score_histogram(df, label, score).agg(F.sum("pos")).scalar()
    c = c.withColumn("__P", tot.cast("double"))
    tp, fp = F.col("cum_pos"), F.col("cum_neg")
    ptp, pfp = tp - F.col("pos"), fp - F.col("neg")
    return c.select(F.col("score").alias("threshold"), tp.alias("tp"), fp.alias("fp"),
                    F.try_divide(tp.cast("double"), (tp + fp).cast("double")).alias("precision"),
                    F.try_divide(tp.cast("double"), P).alias("recall"),
                    F.when(ptp + pfp == 0, F.lit(1.0)).otherwise(
                        F.try_divide(ptp.cast("double"), (ptp + pfp).cast("double"))).alias("prev_precision"),
                    F.try_divide(ptp.cast("double"), P).alias("prev_recall"))


def pr_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """K5 area: trapezoids between consecutive curve points from (0, 1)."""
    c = pr_curve(df, label, score)
    return c.agg(F.sum((F.col("recall") - F.col("prev_recall"))
                       * (F.col("precision") + F.col("prev_precision")) / 2.0).alias("pr_auc_trapezoid"))


def average_precision(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """K4: sum over thresholds of (R_k - R_{k-1}) * P_k."""
    c = pr_curve(df, label, score)
    return c.agg(F.sum((F.col("recall") - F.col("prev_recall")) * F.col("precision")).alias("average_precision"))


def roc_curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """K6: (threshold, fpr, tpr) at each distinct score."""
    c = _cum_desc(df, label, score)
    h = score_histogram(df, label, score)
    tot = h.agg(F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n"))).scalar()
    P, N = tot.getField("p"), tot.getField("n")
    return c.select(F.col("score").alias("threshold"),
                    F.try_divide(F.col("cum_neg").cast("double"), N.cast("double")).alias("fpr"),
                    F.try_divide(F.col("cum_pos").cast("double"), P.cast("double")).alias("tpr"))


def threshold_for_recall(df: DataFrame, target_recall: float = 0.80, label: str = "label",
                         score: str = "score", clip: tuple[float, float] = (0.01, 0.99)) -> DataFrame:
    """The threshold with the highest precision among those reaching
    ``target_recall`` (lowest threshold on ties); if none, the F1-optimal
    one; clipped. One row. Without rows of both classes there is no such
    threshold and the query raises."""
    c = pr_curve(df, label, score)
    ok = c.where(F.col("recall") >= target_recall)
    best = ok.agg(F.min_by("threshold", F.struct(-F.col("precision"), F.col("threshold"))).alias("t"),
                  F.max("precision").alias("p")).select("t")
    f1 = F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    alt = c.agg(F.min_by("threshold", F.struct(-F.coalesce(f1, F.lit(0.0)), F.col("threshold"))).alias("t"))
    t = F.coalesce(best.select("t").scalar(), alt.select("t").scalar())
    t_clip = F.least(F.greatest(t, F.lit(clip[0])), F.lit(clip[1]))
    ends = c.agg(F.max("tp").alias("__tp"), F.max("fp").alias("__fp"))
    lacking = (F.coalesce("__tp", F.lit(0)) == 0) | (F.coalesce("__fp", F.lit(0)) == 0)
    t_clip = F.when(lacking, F.raise_error(F.lit("a threshold needs scored rows of both classes"))).otherwise(t_clip)
    return ends.select(
        t.alias("raw_threshold"), t_clip.alias("threshold"),
        best.select("t").scalar().isNotNull().alias("recall_target_met"))


def decision_utility(df: DataFrame, label: str = "label", pred: str = "prediction",
                     tp_gain: float = 3, tn_gain: float = 0, fp_cost: float = 1, fn_cost: float = 10) -> DataFrame:
    """K8: 3 TP + 0 TN - 1 FP - 10 FN, and per 1000 rows."""
    c = confusion_counts(df, label, pred)
    u = F.col("tp") * tp_gain + F.col("tn") * tn_gain - F.col("fp") * fp_cost - F.col("fn") * fn_cost
    n = F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")
    return c.select("tp", "tn", "fp", "fn", u.cast("double").alias("utility"),
                    F.try_divide(u * 1000.0, n.cast("double")).alias("utility_per_1000"))


def brier(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """K9."""
    return df.agg(F.avg((F.col(score) - F.col(label)) ** 2).alias("brier_score"))


def reliability(df: DataFrame, n_bins: int = 10, label: str = "label", score: str = "score") -> DataFrame:
    """Uniform bins on [0, 1]; bin = number of inner edges strictly
    below p (edge values fall in the lower bin); empty bins dropped."""
    edges = [float(e) for e in np.linspace(0.0, 1.0 + 1e-8, n_bins + 1)[1:-1]]
    p = F.col(score)
    b = sum((F.when(p > F.lit(e), 1).otherwise(0) for e in edges), F.lit(0))
    return (df.where(p.isNotNull()).groupBy(b.cast("int").alias("bin"))
            .agg(F.avg(p).alias("mean_predicted"), F.avg(F.col(label).cast("double")).alias("observed_rate"),
                 F.count(F.lit(1)).alias("count")))


def regression_metrics(df: DataFrame, y: str = "y", y_hat: str = "y_hat") -> DataFrame:
    """MAE and R^2 (two passes: the mean enters as a scalar subquery)."""
    d = df.where(F.col(y).isNotNull() & F.col(y_hat).isNotNull())
    mean = d.agg(F.avg(y)).scalar()
    a = d.agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(F.col(y) - F.col(y_hat))).alias("mae"),
              F.sum((F.col(y) - F.col(y_hat)) ** 2).alias("ss_res"),
              F.sum((F.col(y) - mean) ** 2).alias("ss_tot"))
    return a.select("n", "mae", F.sqrt(F.col("ss_res") / F.col("n")).alias("rmse"),
                    (F.lit(1.0) - F.try_divide(F.col("ss_res"), F.col("ss_tot"))).alias("r2"))


def residuals(df: DataFrame, y: str = "y", y_hat: str = "y_hat", out: str = "residual") -> DataFrame:
    """K13."""
    return df.withColumn(out, F.col(y) - F.col(y_hat))
