"""Sorts, limits and top-k (G-family). Every ranking carries an explicit
tie-break on the group key (T11). ``orderBy(...).limit(n)`` plans as
TakeOrderedAndProject: each partition keeps its own top n, so only
n x partitions rows reach the final merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, by: str, n: int, key: str | Sequence[str], ascending: bool = False) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    order = F.asc(by) if ascending else F.desc(by)
    return df.orderBy(order, *[F.asc(k) for k in keys]).limit(n)


def top_routes(stats: DataFrame, n: int = 20, key: str = "Route",
               metrics: Sequence[str] = ("Avg_Delay", "Delay_Frequency", "Major_Delay_Rate")) -> DataFrame:
    """G1: top ``n`` routes by each metric, as one table with the ranking
    name and the 1-based rank. The stats are stacked once per metric and
    ranked in a window partitioned by the metric, so the per-route
    aggregate is computed once; each window partition holds one row per
    route (an aggregate, not raw rows)."""
    stacked = stats.select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("Ranking"), F.col(m).alias("__v"), *[F.col(c) for c in stats.columns])
        for m in metrics])).alias("s")).select("s.*")
    w = Window.partitionBy("Ranking").orderBy(F.desc("__v"), F.asc(key))
    ranked = stacked.withColumn("Rank", F.row_number().over(w)).where(F.col("Rank") <= n)
    return ranked.select("Ranking", "Rank", *stats.columns)


def worst_hours(hourly: DataFrame, n: int = 10, hour: str = "CRSDepTimeHour",
                by: str = "Avg_Delay") -> DataFrame:
    """G2."""
    return top_k(hourly, by, n, hour)


def worst_airports(airports: DataFrame, n: int = 10, key: str = "OriginCity",
                   by: str = "Avg_Delay") -> DataFrame:
    """G3."""
    return top_k(airports, by, n, key)


def busiest_per_group(df: DataFrame, group: str, key: str, n: int = 10) -> DataFrame:
    """Top ``n`` keys by row count within each group. The count is a
    partial/final aggregate; the ranking window then runs over one row per
    (group, key), partitioned by the group."""
    counts = (df.where(F.col(group).isNotNull() & F.col(key).isNotNull())
              .groupBy(group, key).agg(F.count(F.lit(1)).alias("Flights")))
    w = Window.partitionBy(group).orderBy(F.desc("Flights"), F.asc(key))
    return counts.withColumn("Rank", F.row_number().over(w)).where(F.col("Rank") <= n)


def problem_routes(df: DataFrame, n: int = 10, key: str = "Route", delay: str = "DepDelayMinutes",
                   min_flights: int = 100) -> DataFrame:
    """Routes with >= ``min_flights`` non-null delays, top ``n`` by mean."""
    stats = (df.where(F.col(key).isNotNull()).groupBy(key)
             .agg(F.count(delay).alias("Flight_Count"), F.avg(delay).alias("Avg_Delay"))
             .where(F.col("Flight_Count") >= min_flights))
    return top_k(stats, "Avg_Delay", n, key)


def extreme_months(monthly: DataFrame, month: str = "Month", by: str = "Avg_Delay") -> DataFrame:
    """Month with the highest and with the lowest mean (ties -> first
    month), via max_by/min_by over a struct that orders ties by month."""
    hi = F.max_by(F.col(month), F.struct(F.col(by), -F.col(month)))
    lo = F.min_by(F.col(month), F.struct(F.col(by), F.col(month)))
    return monthly.where(F.col(by).isNotNull()).agg(hi.alias("Worst_Month"), lo.alias("Best_Month"),
                                                    F.max(by).alias("Worst_Avg"), F.min(by).alias("Best_Avg"))


def sorted_keys(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-null values ascending."""
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)


def preview(df: DataFrame, n: int = 100, keys: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows in a total order (all columns by default)."""
    keys = list(keys) if keys else df.columns
    return df.orderBy(*[F.asc_nulls_first(k) for k in keys]).limit(n)
