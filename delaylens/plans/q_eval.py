"""K-family queries (and J11/J12) on the deterministic score fixture, so
every metric has a SQL twin without a model."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from delaylens.operators import evaluate as K, reports as R
from delaylens.plans.inputs import KEYS, fl
from delaylens.plans.oracle_base import with_
from delaylens.plans.q_reports import hist_sql
from delaylens.plans.registry import q

K_ = ", ".join(KEYS)
THR = 0.5
SCORED = {"sc": f"""SELECT *, CAST(CASE WHEN score >= {THR} THEN 1 ELSE 0 END AS INTEGER) AS prediction FROM (
  SELECT *, CAST(CASE WHEN DepDelayMinutes > 0 THEN 1 ELSE 0 END AS INTEGER) AS label,
    CAST((CRSDepTimeHour * 37 + CAST(Distance AS BIGINT)) % 100 AS DOUBLE) / 100.0e0 AS score FROM flights)"""}
HIST = {"h": "SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg FROM sc GROUP BY score"}
CURVE = {"cv": """SELECT score AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
  CAST(tp AS DOUBLE) / (tp + fp) AS precision, CAST(tp AS DOUBLE) / P AS recall,
  CASE WHEN (tp - pos) + (fp - neg) = 0 THEN 1.0e0 ELSE CAST(tp - pos AS DOUBLE) / ((tp - pos) + (fp - neg)) END AS prev_precision,
  CAST(tp - pos AS DOUBLE) / P AS prev_recall
FROM (SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
             (SELECT sum(pos) FROM h) AS P FROM h)"""}


def scored(spark, sf):
    return K.score_fixture(fl(spark, sf), THR)


@q("accuracy", with_("flights", extra=SCORED) + "SELECT avg(CASE WHEN label = prediction THEN 1.0e0 ELSE 0.0e0 END) AS accuracy FROM sc")
def accuracy(spark, sf):
    """K1."""
    return K.accuracy(scored(spark, sf))


def _report_sql():
    per = " UNION ALL ".join(f"""SELECT '{k}' AS class,
  COALESCE(CAST(count(*) FILTER (WHERE label = {k} AND prediction = {k}) AS DOUBLE) / NULLIF(count(*) FILTER (WHERE prediction = {k}), 0), 0) AS precision,
  COALESCE(CAST(count(*) FILTER (WHERE label = {k} AND prediction = {k}) AS DOUBLE) / NULLIF(count(*) FILTER (WHERE label = {k}), 0), 0) AS recall,
  CAST(count(*) FILTER (WHERE label = {k}) AS BIGINT) AS support FROM sc""" for k in (0, 1))
    return {"pc": per, "pf": "SELECT class, precision, recall, COALESCE(2 * precision * recall / NULLIF(precision + recall, 0), 0) AS f1_score, support FROM pc"}


REPORT = _report_sql()


@q("classification_report", with_("flights", extra={**SCORED, **REPORT}) + """
SELECT * FROM pf UNION ALL
SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), CAST(sum(support) AS BIGINT) FROM pf UNION ALL
SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
  sum(f1_score * support) / sum(support), CAST(sum(support) AS BIGINT) FROM pf""")
def classification_report(spark, sf):
    """K2."""
    return K.classification_report(scored(spark, sf), classes=[0, 1])


@q("roc_auc", with_("flights", extra={**SCORED, **HIST}) + """
SELECT (r - P * (P + 1) / 2.0) / (P * N) AS roc_auc FROM (
  SELECT sum(CAST(pos AS DOUBLE) * (before_t + (t + 1) / 2.0)) AS r, CAST(sum(pos) AS DOUBLE) AS P, CAST(sum(neg) AS DOUBLE) AS N
  FROM (SELECT *, CAST(COALESCE(sum(t) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS before_t
        FROM (SELECT *, pos + neg AS t FROM h)))""")
def roc_auc(spark, sf):
    """K3."""
    return K.roc_auc(scored(spark, sf))


@q("average_precision", with_("flights", extra={**SCORED, **HIST, **CURVE}) +
   "SELECT sum((recall - prev_recall) * precision) AS average_precision FROM cv")
def average_precision(spark, sf):
    """K4."""
    return K.average_precision(scored(spark, sf))


@q("pr_curve", with_("flights", extra={**SCORED, **HIST, **CURVE}) + "SELECT * FROM cv")
def pr_curve(spark, sf):
    """K5."""
    return K.pr_curve(scored(spark, sf))


@q("pr_auc", with_("flights", extra={**SCORED, **HIST, **CURVE}) +
   "SELECT sum((recall - prev_recall) * (precision + prev_precision) / 2.0) AS pr_auc_trapezoid FROM cv")
def pr_auc(spark, sf):
    """K5 area."""
    return K.pr_auc(scored(spark, sf))


@q("roc_curve", with_("flights", extra={**SCORED, **HIST}) + """
SELECT score AS threshold, CAST(sum(neg) OVER (ORDER BY score DESC) AS DOUBLE) / (SELECT sum(neg) FROM h) AS fpr,
  CAST(sum(pos) OVER (ORDER BY score DESC) AS DOUBLE) / (SELECT sum(pos) FROM h) AS tpr FROM h""")
def roc_curve(spark, sf):
    """K6."""
    return K.roc_curve(scored(spark, sf))


@q("confusion_matrix", with_("flights", extra=SCORED) + """
SELECT a.actual, a.predicted, CAST(count(sc.label) AS BIGINT) AS count
FROM (SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) v(actual, predicted)) a
LEFT JOIN sc ON sc.label = a.actual AND sc.prediction = a.predicted GROUP BY a.actual, a.predicted""")
def confusion_matrix(spark, sf):
    """K7."""
    return K.confusion_matrix(scored(spark, sf))


_CC = """CAST(count(*) FILTER (WHERE label = 1 AND prediction = 1) AS BIGINT) AS tp,
  CAST(count(*) FILTER (WHERE label = 0 AND prediction = 0) AS BIGINT) AS tn,
  CAST(count(*) FILTER (WHERE label = 0 AND prediction = 1) AS BIGINT) AS fp,
  CAST(count(*) FILTER (WHERE label = 1 AND prediction = 0) AS BIGINT) AS fn"""


@q("decision_utility", with_("flights", extra=SCORED) + f"""
SELECT tp, tn, fp, fn, CAST(3 * tp + 0 * tn - fp - 10 * fn AS DOUBLE) AS utility,
  (3 * tp + 0 * tn - fp - 10 * fn) * 1000.0e0 / (tp + tn + fp + fn) AS utility_per_1000 FROM (SELECT {_CC} FROM sc)""")
def decision_utility(spark, sf):
    """K8."""
    return K.decision_utility(scored(spark, sf))


@q("brier", with_("flights", extra=SCORED) + "SELECT avg(pow(score - label, 2)) AS brier_score FROM sc")
def brier(spark, sf):
    """K9."""
    return K.brier(scored(spark, sf))


_EDGES = [float(e) for e in np.linspace(0.0, 1.0 + 1e-8, 11)[1:-1]]


@q("reliability", with_("flights", extra=SCORED) + "SELECT CAST(" + " + ".join(
    f"CASE WHEN score > {e!r} THEN 1 ELSE 0 END" for e in _EDGES) + """ AS INTEGER) AS bin,
  avg(score) AS mean_predicted, avg(CAST(label AS DOUBLE)) AS observed_rate, CAST(count(*) AS BIGINT) AS count
FROM sc WHERE score IS NOT NULL GROUP BY 1""")
def reliability(spark, sf):
    """K10."""
    return K.reliability(scored(spark, sf))


@q("macro_f1", with_("flights", extra={**SCORED, **REPORT}) + "SELECT avg(f1_score) AS macro_f1 FROM pf")
def macro_f1(spark, sf):
    """K11."""
    return K.macro_f1(scored(spark, sf), classes=[0, 1])


def _reg_sql(where=""):
    return f"""SELECT CAST(count(*) AS BIGINT) AS n, avg(abs(DepDelayMinutes - TaxiOut)) AS mae,
  sqrt(sum(pow(DepDelayMinutes - TaxiOut, 2)) / count(*)) AS rmse,
  1.0 - sum(pow(DepDelayMinutes - TaxiOut, 2)) / sum(pow(DepDelayMinutes - (SELECT avg(DepDelayMinutes) FROM flights WHERE DepDelayMinutes IS NOT NULL {where}), 2)) AS r2
FROM flights WHERE DepDelayMinutes IS NOT NULL {where}"""


@q("regression_metrics", with_("flights") + "SELECT 'all' AS subset, * FROM (" + _reg_sql() + ") UNION ALL SELECT 'delayed', * FROM ("
   + _reg_sql("AND DepDelayMinutes > 0") + ")")
def regression_metrics(spark, sf):
    """K12 on the regression fixture (y = delay, y_hat = TaxiOut), all and delayed rows."""
    df = fl(spark, sf)
    a = K.regression_metrics(df, "DepDelayMinutes", "TaxiOut").select(F.lit("all").alias("subset"), "*")
    b = K.regression_metrics(df.where(F.col("DepDelayMinutes") > 0), "DepDelayMinutes", "TaxiOut").select(
        F.lit("delayed").alias("subset"), "*")
    return a.unionByName(b)


@q("residuals", with_("flights", extra={"hx": "SELECT DepDelayMinutes - TaxiOut AS x FROM flights WHERE DepDelayMinutes IS NOT NULL"})
   + hist_sql("hx", 50))
def residuals(spark, sf):
    """Residual histogram (50 bins)."""
    r = K.residuals(fl(spark, sf), "DepDelayMinutes", "TaxiOut")
    return R.histogram(r, "residual", 50)


@q("threshold_for_recall", with_("flights", extra={**SCORED, **HIST, **CURVE}) + """
SELECT COALESCE((SELECT threshold FROM cv WHERE recall >= 0.8 ORDER BY precision DESC, threshold ASC LIMIT 1),
                (SELECT threshold FROM cv ORDER BY COALESCE(2 * precision * recall / NULLIF(precision + recall, 0), 0) DESC, threshold ASC LIMIT 1)) AS raw_threshold,
  least(greatest(COALESCE((SELECT threshold FROM cv WHERE recall >= 0.8 ORDER BY precision DESC, threshold ASC LIMIT 1),
                (SELECT threshold FROM cv ORDER BY COALESCE(2 * precision * recall / NULLIF(precision + recall, 0), 0) DESC, threshold ASC LIMIT 1)), 0.01), 0.99) AS threshold,
  (SELECT count(*) FROM cv WHERE recall >= 0.8) > 0 AS recall_target_met""")
def threshold_for_recall(spark, sf):
    """J11 on the score fixture."""
    return K.threshold_for_recall(scored(spark, sf), 0.80)


@q("apply_threshold", with_("flights", extra=SCORED) + f"SELECT {K_}, score, CAST(CASE WHEN score >= 0.37 THEN 1 ELSE 0 END AS INTEGER) AS prediction FROM sc")
def apply_threshold(spark, sf):
    """J12."""
    return K.apply_threshold(scored(spark, sf).drop("prediction"), 0.37).select(*KEYS, "score", "prediction")
