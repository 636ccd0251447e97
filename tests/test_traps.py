"""One assertion per pandas -> Spark semantic trap (FIXTURES.md section 5)."""

import datetime as dt

from pyspark.sql import functions as F

from delaylens.functions import columns as C
from delaylens.operators import clean, features as B, reports as R, series as S, topk as T
from delaylens.operators import evaluate as K


def test_rate_counts_nulls_as_false(spark):
    df = spark.createDataFrame([(1.0,), (70.0,), (None,)], "x double")
    assert abs(df.agg(C.rate(F.col("x") > 60)).first()[0] - 1 / 3) < 1e-12


def test_weekday_is_monday_zero(spark):
    df = spark.createDataFrame([(dt.date(2026, 12, 1),)], "DepDate date")
    assert B.date_parts(df).first()["DayOfWeek"] == 1


SEV_IN = [None, -3.0, 0.0, 1.0, 15.0, 16.0, 60.0, 61.0]


def test_severity_and_bucket(spark):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(SEV_IN)], "i int, DepDelayMinutes double")
    out = B.add_delay_bucket(B.add_delay_severity(df)).orderBy("i").collect()
    assert [r.DelaySeverity for r in out] == ["On Time"] * 3 + ["Minor Delay"] * 2 + ["Moderate Delay"] * 2 + ["Major Delay"]
    assert [r.DelayBucket for r in out] == [3, 0, 0, 1, 1, 2, 2, 3]


def test_distance_bins_right_closed(spark):
    vals = [-1.0, 0.0, 1.0, 500.0, 501.0, 1000.0, 2000.0, 2001.0, None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(vals)], "i int, Distance double")
    out = [r.DistanceGroup for r in B.add_distance_group(df).orderBy("i").collect()]
    assert out == [None, None, 1, 1, 2, 2, 4, 5, None]


def test_city_split_never_raises(spark):
    df = spark.createDataFrame([(0, "A, B"), (1, "A"), (2, "A, B, C")], "i int, OriginCityName string")
    out = B.split_city_state(df.withColumn("bad", C.bad_city("OriginCityName"))).orderBy("i").collect()
    assert (out[0].OriginCity, out[0].OriginState, out[0].bad) == ("A", "B", False)
    assert (out[1].OriginCity, out[1].OriginState, out[1].bad) == ("A", None, True)
    assert out[2].bad is True


def test_one_row_std_is_null(spark):
    df = spark.createDataFrame([("r", 5.0)], "Route string, DepDelayMinutes double").withColumn(
        "DepDate", F.current_date())
    assert R.route_stats(df, min_flights=1).first()["Delay_Std"] is None


def test_ties_break_on_key(spark):
    df = spark.createDataFrame([("c", 1.0), ("a", 1.0), ("b", 1.0)], "Route string, Avg_Delay double")
    assert [r.Route for r in T.top_k(df, "Avg_Delay", 2, "Route").collect()] == ["a", "b"]


def test_interpolate_linear(spark):
    vals = [1.0, None, None, 4.0, None]
    df = spark.createDataFrame([(dt.date(2020, 1, 1) + dt.timedelta(days=i), v) for i, v in enumerate(vals)],
                               "d date, y double")
    out = [r.y_filled for r in S.interpolate_linear(df).orderBy("d").collect()]
    assert out == [1.0, 2.0, 3.0, 4.0, 4.0]


def test_interpolate_leading_gap_stays_null(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 1), None), (dt.date(2020, 1, 2), 2.0)], "d date, y double")
    assert [r.y_filled for r in S.interpolate_linear(df).orderBy("d").collect()] == [None, 2.0]


def test_reliability_edges_fall_low(spark):
    df = spark.createDataFrame([(0, 0.0), (0, 0.1), (1, 0.1000001), (1, 1.0)], "label int, score double")
    bins = sorted((r.bin, r["count"]) for r in K.reliability(df).collect())
    assert bins == [(0, 2), (1, 1), (9, 1)]


def test_duplicates_with_nulls_collapse(spark):
    df = spark.createDataFrame([(1, None), (1, None)], "a int, b string")
    assert clean.drop_duplicates(df).count() == 1


def test_raw_weekday_survives_derivation(spark):
    df = spark.createDataFrame([(2, dt.date(2026, 12, 1))], "DayofWeek int, DepDate date")
    out = B.date_parts(clean.ingest(df)).first()
    assert (out["DayofWeek_raw"], out["DayOfWeek"]) == (2, 1)


def test_carrier_map_unknown_and_null(spark):
    df = spark.createDataFrame([("WN",), ("ZZ",), (None,)], "Marketing_Airline_Network string")
    assert [r.CarrierName for r in B.map_carrier(df).collect()] == ["Southwest Airlines", "Unknown Airline",
                                                                    "Unknown Airline"]
