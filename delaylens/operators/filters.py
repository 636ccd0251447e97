"""Filters and predicates (C-family). Plain ``where`` clauses on source
columns are pushed into the parquet scan by Catalyst; sets of years reach it
as date ranges (``sources.flights.shipped_in``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylens.functions import columns as C
from delaylens.functions.selection import exact_quantiles
from delaylens.session import materialize


def filter_carrier(df: DataFrame, code: str = "WN", col: str = "Marketing_Airline_Network") -> DataFrame:
    """C1."""
    return df.where(F.col(col) == code)


def exclude_years(df: DataFrame, years: Sequence[int], year: str = "Year") -> DataFrame:
    """Drop listed years, keep null years."""
    return df.where(C.not_in_years(year, years))


def min_support(stats: DataFrame, min_count: int, count_col: str = "Flight_Count") -> DataFrame:
    """C4: HAVING count >= min_count."""
    return stats.where(F.col(count_col) >= min_count)


def range_filter(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    """Lo <= col <= hi."""
    return df.where(F.col(col).between(lo, hi))


def high_risk_groups(stats: DataFrame, key: str, a: str = "Avg_Delay", b: str = "Major_Delay_Rate",
                     q: float = 0.8) -> DataFrame:
    """Groups strictly above the ``q`` quantile in both metrics. The group
    statistics are written once; both quantiles are selected in rounds over them."""
    stats = materialize(stats, "group-stats")
    cut = exact_quantiles(stats, {a: [q], b: [q]})
    return stats.where((F.col(a) > F.lit(cut[a, q])) & (F.col(b) > F.lit(cut[b, q])))


def outliers_above_quantile(df: DataFrame, col: str, q: float = 0.99) -> DataFrame:
    """Count of values strictly above the ``q`` quantile, which is selected in
    rounds over the column, written once."""
    values = materialize(df.select(col), "values")
    cut = F.lit(exact_quantiles(values, {col: [q]})[col, q]).cast("double")
    return values.agg(F.max(cut).alias("Threshold"), F.count_if(F.col(col) > cut).alias("Outliers"))


def delayed_only(df: DataFrame, col: str = "DepDelayMinutes") -> DataFrame:
    """C8."""
    return df.where(F.col(col) > 0)


def years_present(df: DataFrame, years: Sequence[int], year: str = "Year") -> DataFrame:
    """Rows per forbidden year that is still present (the violation table)."""
    return (df.where(F.col(year).isin(*years)).groupBy(year)
            .agg(F.count(F.lit(1)).alias("Rows")))


def assert_years_absent(df: DataFrame, years: Sequence[int], year: str = "Year") -> None:
    """C9 as a guard: one bounded probe (``limit(1)``), raises on violation."""
    if df.where(F.col(year).isin(*years)).limit(1).count() > 0:
        raise AssertionError(f"excluded years still present: {list(years)}")


def assert_disjoint_split(train: DataFrame, test: DataFrame, year: str = "Year") -> None:
    """Raise when train and test share a year."""
    from delaylens.operators.sets import years_intersect
    common = [r[0] for r in years_intersect(train, test, year).collect()]   # <= #years rows
    if common:
        raise AssertionError(f"train and test share years {common}")
