"""Group-statistic lookups (E-family): the index/map alignments of the
original become an aggregate joined back on its key.

The aggregate side has one row per key. It is written once and broadcast while a
count shows few keys; a shuffle by a few keys would send all rows to as many
tasks. Beyond that the planner's shuffle join is kept. A hot key costs nothing
extra: the aggregate is combined map-side and the join side has one row for it.
Windows partitioned by the key are avoided on purpose: they would put
every row of a hot key into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylens.operators.tables import few_rows
from delaylens.session import materialize


def attach_group_stats(df: DataFrame, key: str | Sequence[str], aggs: dict, how: str = "left") -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    cond = F.col(keys[0]).isNotNull()
    for k in keys[1:]:
        cond = cond & F.col(k).isNotNull()
    stats = (df.where(cond)
             .groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()]))
    return df.join(few_rows(materialize(stats, "group-stats")), keys, how)


def group_stats_lookup(df: DataFrame, delay: str = "DepDelayMinutes") -> DataFrame:
    """RouteFrequency (rows), RouteAvgDelay, OriginAvgDelay, DestAvgDelay.

    One pass: rows are pre-aggregated once to (route, origin, destination)
    counts and sums, and the three means are rolled up from that small
    table (mean = sum of sums / sum of counts), so the input is scanned and
    shuffled once instead of once per key."""
    d = F.col(delay)
    base = materialize(df.groupBy("Route", "OriginCity", "DestCity").agg(
        F.count(F.lit(1)).alias("__rows"), F.count(d).alias("__n"), F.sum(d).alias("__s")), "group-sums")

    def mean(key: str, name: str, extra: dict | None = None) -> DataFrame:
        aggs = {name: F.try_divide(F.sum("__s"), F.sum("__n").cast("double")), **(extra or {})}
        return few_rows(base.where(F.col(key).isNotNull()).groupBy(key).agg(*[c.alias(n) for n, c in aggs.items()]))

    route = mean("Route", "RouteAvgDelay", {"RouteFrequency": F.sum("__rows")})
    return (df.join(route, "Route", "left")
            .join(mean("OriginCity", "OriginAvgDelay"), "OriginCity", "left")
            .join(mean("DestCity", "DestAvgDelay"), "DestCity", "left"))


def group_stats_rich(df: DataFrame, delay: str = "DepDelayMinutes", digits: int = 2) -> DataFrame:
    """Route mean/std/count and origin/destination mean/std, rounded
    half-to-even to ``digits`` (pandas ``round``)."""
    r = lambda c: F.bround(c, digits)
    df = attach_group_stats(df, "Route", {"Route_Avg_Delay": r(F.avg(delay)),
                                          "Route_Std_Delay": r(F.stddev_samp(delay)),
                                          "Route_Flight_Count": F.count(delay)})
    df = attach_group_stats(df, "OriginCity", {"Origin_Avg_Delay": r(F.avg(delay)),
                                               "Origin_Std_Delay": r(F.stddev_samp(delay))})
    return attach_group_stats(df, "DestCity", {"Dest_Avg_Delay": r(F.avg(delay)),
                                               "Dest_Std_Delay": r(F.stddev_samp(delay))})


def train_priors(df: DataFrame, is_train: str = "is_train", delay: str = "DepDelayMinutes",
                 keys: Sequence[tuple[str, str]] = (("Route", "Route_Prior"),
                                                    ("OriginCity", "Origin_Prior"))) -> DataFrame:
    """Per-key mean delay from train rows only; keys unseen in train
    get the global train mean. Train rows are pre-aggregated once over all
    prior keys; each prior and the global mean (a scalar subquery) are
    rolled up from that table."""
    d = F.col(delay)
    cols = [k for k, _ in keys]
    base = materialize(df.where(F.col(is_train)).groupBy(*cols).agg(F.count(d).alias("__n"), F.sum(d).alias("__s")), "prior-sums")
    mean = F.try_divide(F.sum("__s"), F.sum("__n").cast("double"))
    glob = base.agg(mean).scalar()
    out = df
    for key, name in keys:
        pri = base.where(F.col(key).isNotNull()).groupBy(key).agg(mean.alias(name))
        out = out.join(few_rows(pri), key, "left")
    return out.withColumns({name: F.coalesce(F.col(name), glob) for _, name in keys})


def train_traffic_prior(df: DataFrame, is_train: str = "is_train",
                        keys: Sequence[str] = ("OriginCity", "CRSDepTimeHour"),
                        name: str = "Origin_Hour_Traffic") -> DataFrame:
    """Train flights per (origin, hour); unseen pairs -> 0."""
    keys = list(keys)
    cnt = (df.where(F.col(is_train)).groupBy(*keys).agg(F.count(F.lit(1)).alias(name)))
    return df.join(few_rows(materialize(cnt, "traffic")), keys, "left").withColumn(name, F.coalesce(F.col(name), F.lit(0)).cast("bigint"))


def densify_calendar(series: DataFrame, d: str = "d", key: str | None = None) -> DataFrame:
    """Every day from min to max (per series key) with the series left
    joined on; missing days get a null value. The calendar is generated
    from a one-row-per-key min/max aggregate with ``sequence``."""
    keys = [key] if key else []
    span = series.groupBy(*keys).agg(F.min(d).alias("__lo"), F.max(d).alias("__hi"))
    cal = span.select(*keys, F.explode(F.sequence("__lo", "__hi", F.expr("INTERVAL 1 DAY"))).alias(d))
    return cal.join(series, keys + [d], "left")


def scalar_baseline(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """The columns of a one-row result attached to every row, each as
    a scalar subquery (evaluated once, no join)."""
    return df.withColumns({c: one_row.select(c).scalar() for c in one_row.columns})


def calendar(spark: SparkSession, lo: str, hi: str, name: str = "d") -> DataFrame:
    return spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(lo)), F.to_date(F.lit(hi)))).alias(name))
