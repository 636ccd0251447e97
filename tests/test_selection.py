"""Exact quantiles by selection in rounds, and whole-row duplicates on digests."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from delaylens.functions import selection
from delaylens.functions.selection import exact_quantiles
from delaylens.operators import clean, distinct, filters, reports

QS = (0.0, 0.01, 0.25, 0.5, 0.8, 0.99, 1.0)


def _spark_quantiles(df, col):
    row = df.agg(*[F.percentile(col, q).alias(f"q{i}") for i, q in enumerate(QS)]).first()
    return [row[i] for i in range(len(QS))]


def test_million_distinct_values(spark):
    n = 1_000_000
    df = spark.range(n).select(((F.col("id") * 7919) % n + 0.5).alias("v"), F.exp(F.col("id") % 700).alias("w"),
                               (F.col("id") % 3).alias("few"))
    got = exact_quantiles(df, {"v": QS, "few": QS})
    assert [got["v", q] for q in QS] == [pytest.approx(0.5 + q * (n - 1), rel=1e-15) for q in QS]
    assert [got["few", q] for q in QS] == _spark_quantiles(df, "few")


def test_values_of_all_magnitudes(spark):
    rng = np.random.default_rng(3)
    edge = [0.0, -0.0, 5e-324, -5e-324, 1e-300, 1.7976931348623157e308, -1.7976931348623157e308, 1.0, 1.0 + 2**-52]
    rows = [float(x) for x in np.concatenate([rng.standard_normal(400) * 10.0 ** rng.integers(-300, 300, 400), edge])]
    df = spark.createDataFrame([(x,) for x in rows + rows[:100] + [None]], "v double").repartition(4)
    got = exact_quantiles(df, {"v": QS})
    for q, want in zip(QS, np.quantile(np.array(rows + rows[:100]), QS)):
        assert got["v", q] == pytest.approx(want, rel=1e-12, abs=5e-324)


def test_infinite_nan_null_and_empty(spark):
    inf, nan = math.inf, math.nan
    df = spark.createDataFrame([(x,) for x in [-inf, 1.0, 2.0, 2.0, inf, nan, None]], "v double")
    got = exact_quantiles(df, {"v": [0.0, 0.2, 0.5, 0.8, 1.0]})
    assert [got["v", q] for q in (0.0, 0.2, 0.5, 0.8)] == [-inf, 1.0, 2.0, inf] and math.isnan(got["v", 1.0])
    assert exact_quantiles(df.limit(0), {"v": [0.5]}) == {("v", 0.5): None}
    none = filters.outliers_above_quantile(df.where("v is null"), "v").first()
    assert (none["Threshold"], none["Outliers"]) == (None, 0)
    empty = reports.numeric_profile(df.limit(0), cols=["v"]).first()
    assert (empty["Median"], empty["Outliers_Q99"]) == (None, 0)


def test_one_range_holds_almost_all(spark):
    """A huge value puts all others into one even range."""
    df = spark.range(5000).select(F.when(F.col("id") == 0, 1e300).otherwise(F.col("id") / 7).alias("v"))
    assert [exact_quantiles(df, {"v": QS})["v", q] for q in QS] == _spark_quantiles(df, "v")


def test_no_object_aggregate(spark):
    df = spark.range(1000).selectExpr("cast(id as double) as Delay", "cast(id % 7 as double) as b", "cast(id as string) as k")
    for out in (reports.numeric_profile(df, cols=["Delay"]), filters.outliers_above_quantile(df, "Delay"),
                filters.high_risk_groups(df, "k", "Delay", "b")):
        assert "ObjectHashAggregate" not in out._jdf.queryExecution().executedPlan().toString()
    assert filters.high_risk_groups(df, "k", "Delay", "b").count() == sum(i > 799.2 and i % 7 > 5 for i in range(1000))


ROWS = [(None, 1, 0.0, "x"), (1, None, 0.0, "x"), (None, 1, -0.0, "x"), (1, None, float("nan"), None), (1, None, float("nan"), None),
        (2, 3, 1.5, ""), (2, 3, 1.5, None), (2, 3, 1.5, "")]


def _table(spark, rows):
    return spark.createDataFrame(rows, "a int, b int, c double, __digest_a string").repartition(3)


@pytest.mark.parametrize("small", [distinct.SMALL_DIGESTS, 1])
@pytest.mark.parametrize("narrow", [False, True])
def test_duplicates(spark, monkeypatch, small, narrow):
    """Also when different rows share a digest, and when many digests repeat."""
    monkeypatch.setattr(distinct, "SMALL_DIGESTS", small)
    if narrow:
        named = distinct._named

        def clash(df):
            rows, names = named(df)
            return rows.withColumns({n: F.pmod(n, F.lit(2)) for n in names}), names
        monkeypatch.setattr(distinct, "_named", clash)
    df = _table(spark, ROWS + [(i, i, float(i), str(i)) for i in range(100)])
    assert clean.drop_duplicates(df).columns == df.columns
    assert sorted(map(str, clean.drop_duplicates(df).collect())) == sorted(map(str, df.dropDuplicates().collect()))
    r = reports.duplicate_count(df).first()
    assert (r["Total_Rows"], r["Duplicate_Rows"]) == (108, 3)
    assert r["Duplicate_Percentage"] == pytest.approx(300 / 108)


def test_duplicates_without_repeats_or_rows(spark):
    df = _table(spark, [(i, i, float(i), str(i)) for i in range(50)])
    assert clean.drop_duplicates(df).count() == 50
    assert tuple(reports.duplicate_count(df).first()) == (50, 0, 0.0)
    assert clean.drop_duplicates(df.limit(0)).count() == 0
    assert tuple(reports.duplicate_count(df.limit(0)).first()) == (None, None, None)


def test_few_copies_move_few_rows(spark):
    """Rows without a copy are not shuffled."""
    wide = [F.md5(F.concat(F.col("id").cast("string"), F.lit(str(i)))).alias(f"c{i}") for i in range(20)]
    df = spark.range(20_000).select((F.col("id") % 19_990).alias("id")).select("id", *wide)
    out = clean.drop_duplicates(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan and out.count() == 19_990
    sides = [p for p in plan.split("Union")[-1].split("\n") if "Exchange hashpartitioning" in p]
    assert len(sides) <= 1
