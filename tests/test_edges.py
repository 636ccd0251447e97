"""Edges of the two-sample tests, pruned scans, duplicate removal, the scratch folder."""

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from delaylens.functions.stats import erfc, kolmogorov_sf
from delaylens.operators import features as B, series as S, twosample as I
from delaylens.plans import params as P
from delaylens.plans.inputs import trips
from delaylens.sources.flights import shipped_in

SF = "/root/testdata/sf0.001"


def frame(spark, rows):
    return spark.createDataFrame(rows, "g int, v double")


def both(df):
    a, b = F.col("g") == 1, F.col("g") == 2
    return I.ks_2samp(df, "v", a, b).first(), I.mann_whitney_u(df, "v", a, b).first()


def test_empty_sample_gives_null(spark):
    ks, mw = both(frame(spark, [(1, 1.0), (1, 2.0)]))
    assert ks["ks_pvalue"] is None and ks["ks_statistic"] is None and mw["mw_pvalue"] is None
    ks, mw = both(frame(spark, []))
    assert ks["ks_pvalue"] is None and mw["mw_pvalue"] is None


def test_all_ties_and_equal_samples(spark):
    ks, mw = both(frame(spark, [(1, 3.0)] * 5 + [(2, 3.0)] * 4))
    assert ks["ks_statistic"] == 0 and ks["ks_pvalue"] == 1.0 and mw["z"] is None and mw["mw_pvalue"] is None
    ks, _ = both(frame(spark, [(g, float(i)) for g in (1, 2) for i in range(40)]))
    assert ks["ks_pvalue"] == 1.0


def test_kolmogorov_and_erfc_values(spark):
    xs = [-3.0, -0.5, 0.0, 0.3, 1.0, 1.99, 2.0, 2.5, 5.0, 9.0]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", erfc(F.col("x")).alias("y")).collect()
    assert all(r["y"] == pytest.approx(math.erfc(r["x"]), rel=1e-9) for r in got)
    lams = [0.0, 0.005, 0.01, 0.2, 0.5, 0.99, 1.0, 1.5, 3.0]
    want = [1, 1, 1] + [max(0, min(1, 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * x * x) for k in range(1, 3000)))) for x in lams[3:]]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in lams], "x double").select(kolmogorov_sf(F.col("x"))).collect()]
    assert got == pytest.approx(want, abs=1e-9)


def test_year_sets_reach_the_scan(spark):
    plan = trips(spark, SF, years=P.TRAIN_YEARS)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan
    plan = trips(spark, SF, without=P.EXCLUDE_YEARS)._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(l_shipdate" in plan and "IsNull(l_shipdate)" in plan
    assert shipped_in() is None


def test_carrier_name_after_duplicates_changes_nothing(spark):
    rows = [("A, B", "WN"), ("A, B", "WN"), ("A", "WN"), ("A", "WN"), ("A, B, C", "AA"), ("A, B, D", "AA"), ("A, B", "AA"), (None, None), (None, None)]
    df = spark.createDataFrame([(o, "X, Y", c) for o, c in rows], "OriginCityName string, DestCityName string, Marketing_Airline_Network string")
    old = B.map_carrier(B.split_city_state(df)).dropDuplicates()
    new = B.map_carrier(B.split_city_state(df).dropDuplicates())
    assert old.exceptAll(new).isEmpty() and new.exceptAll(old).isEmpty()


def test_stl_parts_add_up_per_series(spark):
    days = pd.date_range("2020-01-01", periods=120)
    rows = [(c, d.date(), float(i % 7) * k + i * 0.01) for k, c in ((1, "a"), (5, "b")) for i, d in enumerate(days)]
    series = spark.createDataFrame(rows, "city string, d date, y_filled double")
    out = S.stl_decompose(series, key="city", seasonal=35).toPandas()
    assert len(out) == 240 and ((out.trend + out.seasonal + out.resid - out.y).abs() < 1e-9).all()


def test_scratch_folder_must_be_shared_on_a_cluster(monkeypatch):
    from delaylens import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    fake = type("S", (), {"sparkContext": Context(), "conf": Conf()})()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(fake)


def test_registered_queries_read_rows():
    import __spark_entry__ as E
    assert not {"find_columns", "required_columns", "dtype_counts"} & set(E.queries())
