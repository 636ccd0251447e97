"""Grouped reports (D-family).

Every report is one ``groupBy(key).agg(...)`` so Spark plans a partial
(map-side) aggregate, one hash exchange on the key and a final aggregate:
a hot key is combined on the map side before the shuffle and never lands
as raw rows in one task. Exact medians use ``percentile``, whose buffer is
a value->count map bounded by the distinct minute values of a group (for
continuous values, ``functions.quantile`` gives the same result from a
spillable (key, value) histogram).
Null keys are dropped (pandas ``groupby`` semantics) and rates count
nulls as "no" (T1)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from delaylens.functions import columns as C
from delaylens.functions.guards import numeric_columns
from delaylens.functions.selection import exact_quantiles
from delaylens.operators import distinct
from delaylens.session import materialize


def _delay_aggs(delay: str, with_std: bool = False, with_max: bool = False) -> list[Column]:
    d = F.col(delay)
    aggs = [F.count(d).alias("Flight_Count"), F.avg(d).alias("Avg_Delay"),
            F.median(d).alias("Median_Delay")]
    if with_std:
        aggs.append(F.stddev_samp(d).alias("Delay_Std"))
    if with_max:
        aggs.append(F.max(d).alias("Max_Delay"))
    return aggs


def group_delays(df: DataFrame, key: str, delay: str = "DepDelayMinutes",
                 with_std: bool = False) -> DataFrame:
    """D17-D23 core: count (non-null), mean, median [, std] per key."""
    return (df.where(F.col(key).isNotNull()).groupBy(key)
            .agg(*_delay_aggs(delay, with_std)))


# ---- D1-D5: data quality -------------------------------------------------

def missing_report(df: DataFrame) -> DataFrame:
    """Per column null count and % of rows; only > 0; sorted desc.
    One pass: a single aggregate of ``count_if(c IS NULL)`` per column."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(F.col(c).isNull()).alias(f"__m{i}") for i, c in enumerate(cols)])
    stacked = agg.select("__n", F.explode(F.array(*[
        F.struct(F.lit(c).alias("Column"), F.col(f"__m{i}").alias("Missing_Count"))
        for i, c in enumerate(cols)])).alias("s"))
    return (stacked.select("s.Column", "s.Missing_Count",
                           (F.col("s.Missing_Count") * 100.0 / F.col("__n")).alias("Missing_Percentage"))
            .where(F.col("Missing_Count") > 0)
            .orderBy(F.desc("Missing_Count"), "Column"))


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows repeating an earlier row (nulls compare equal) and %. Digests are
    counted; whole rows are compared only where a digest repeats."""
    per = distinct.duplicate_counts(df)
    return per.select(F.col("rows").cast("bigint").alias("Total_Rows"),
                      (F.col("rows") - F.col("distinct_rows")).cast("bigint").alias("Duplicate_Rows")).select(
        "Total_Rows", "Duplicate_Rows",
        F.try_divide(F.col("Duplicate_Rows") * 100.0, F.col("Total_Rows")).alias("Duplicate_Percentage"))


def drop_duplicates_report(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """D3: whole-row distinct and a one-row removed-count report."""
    out = distinct.drop_duplicates(df)
    after = out.agg(F.count(F.lit(1))).scalar()
    rep = (df.agg(F.count(F.lit(1)).alias("Rows_Before"))
           .select("Rows_Before", after.alias("Rows_After"))
           .withColumn("Rows_Removed", F.col("Rows_Before") - F.col("Rows_After")))
    return out, rep


def numeric_profile(df: DataFrame, cols: Sequence[str] | None = None, q: float = 0.99) -> DataFrame:
    """Min, max, mean, median, std and the count above the ``q``
    quantile for numeric '*delay*' columns. The columns are written once; medians
    and quantiles are selected in rounds, the rest is one aggregate."""
    if cols is None:
        num = set(numeric_columns(df))
        cols = [c for c in df.columns if "delay" in c.lower() and c in num]
    values = materialize(df.select(*cols), "numeric-columns")
    at = exact_quantiles(values, {c: [0.5, q] for c in cols})
    stats = values.agg(*[F.struct(F.lit(c).alias("Column"),
                                  F.min(c).cast("double").alias("Min"),
                                  F.max(c).cast("double").alias("Max"),
                                  F.avg(c).alias("Mean"),
                                  F.lit(at[c, 0.5]).cast("double").alias("Median"),
                                  F.stddev_samp(c).alias("Std"),
                                  F.count_if(F.col(c) > F.lit(at[c, q]).cast("double")).alias("Outliers_Q99")).alias(f"__s{i}")
                         for i, c in enumerate(cols)])
    return stats.select(F.explode(F.array(*[F.col(f"__s{i}") for i in range(len(cols))])).alias("r")).select("r.*")


# ---- D6-D11: carrier and cleaning summaries -------------------------------

def carrier_summary(df: DataFrame, total_rows: DataFrame | None = None,
                    date: str = "FlightDate") -> DataFrame:
    """One-row summary of a carrier slice; ``total_rows`` is a one-row
    DataFrame with column ``Total_Rows`` for the % kept."""
    s = df.agg(
        F.count(F.lit(1)).alias("Rows_Kept"),
        F.min(date).alias("Min_Date"), F.max(date).alias("Max_Date"),
        F.count_distinct("OriginCityName").alias("Distinct_Origins"),
        F.count_distinct("DestCityName").alias("Distinct_Destinations"),
        F.avg("DepDelay").alias("Avg_Dep_Delay"), F.max("DepDelay").alias("Max_Dep_Delay"),
        F.count_if(F.col("DepDelay") > 0).alias("Dep_Delayed_Count"),
        F.avg("ArrDelay").alias("Avg_Arr_Delay"), F.max("ArrDelay").alias("Max_Arr_Delay"),
        F.count_if(F.col("ArrDelay") > 0).alias("Arr_Delayed_Count"))
    if total_rows is not None:
        s = s.withColumn("Total_Rows", total_rows.select("Total_Rows").scalar()).withColumn(
            "Pct_Of_Total", F.try_divide(F.col("Rows_Kept") * 100.0, F.col("Total_Rows")))
    return s


def severity_counts(df: DataFrame, delay: str = "DepDelayMinutes") -> DataFrame:
    """On time (==0), (0,15], (15,60], >60 counts and % of rows."""
    d = F.col(delay)
    conds = {"On_Time": d == 0, "Minor": (d > 0) & (d <= 15),
             "Moderate": (d > 15) & (d <= 60), "Major": d > 60}
    aggs = [F.count(F.lit(1)).alias("Total_Rows")]
    for k, c in conds.items():
        aggs += [F.count_if(c).alias(f"{k}_Count"), C.pct(c).alias(f"{k}_Pct")]
    return df.agg(*aggs)


def value_counts(df: DataFrame, col: str, n: int | None = None) -> DataFrame:
    """Frequency of a column's values (nulls dropped), most frequent
    first, ties by value; ``n`` keeps the top n."""
    out = (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
           .orderBy(F.desc("count"), F.asc(col)))
    return out.limit(n) if n else out


def value_counts_many(df: DataFrame, cols: Sequence[str], top: dict[str, int] | None = None) -> DataFrame:
    """D8 for several columns in one pass: (Column, Value, count) from one
    scan and one aggregate over the stacked (column, value) pairs; ``top``
    keeps the n most frequent values of the named columns (ties by value),
    ranked within the aggregated rows of that column."""
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("Column"), F.col(c).cast("string").alias("Value")) for c in cols])).alias("s"))
    counts = (stacked.select("s.*").where(F.col("Value").isNotNull())
              .groupBy("Column", "Value").agg(F.count(F.lit(1)).alias("count")))
    if not top:
        return counts
    # listed columns of one limit are ranked together against that literal, so each task passes on its first n alone
    first = Window.partitionBy("Column").orderBy(F.desc("count"), F.asc("Value"))
    parts = [counts.where(F.col("Column").isin([c for c in top if top[c] == n])).withColumn("__r", F.row_number().over(first))
             .where(F.col("__r") <= n).drop("__r") for n in sorted(set(top.values()))]
    rest = counts.where(~F.col("Column").isin(list(top)))
    return reduce(DataFrame.unionByName, parts, rest)


def cardinality(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct (non-null) values per column, as (column, n_distinct).
    (column, value) pairs are stacked once and combined on the map side."""
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols]))
                      .alias("s")).select("s.*")
    found = pairs.distinct().groupBy("column").agg(F.count("value").alias("n"))
    names = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in cols])).alias("column"))
    return names.join(found, "column", "left").select("column", F.coalesce("n", F.lit(0).cast("long")).alias("n_distinct"))


def year_counts_before_after(df: DataFrame, exclude_years: Sequence[int], year: str = "Year") -> DataFrame:
    """Rows per year before and after C2 in one pass."""
    keep = C.not_in_years(year, exclude_years)
    return (df.groupBy(year).agg(F.count(F.lit(1)).alias("Rows_Before"),
                                 F.count_if(keep).alias("Rows_After"))
            .withColumn("Rows_Removed", F.col("Rows_Before") - F.col("Rows_After"))
            .orderBy(year))


def delay_kpis(df: DataFrame, delay: str = "DepDelayMinutes") -> DataFrame:
    """Avg delay, on-time %, major %."""
    d = F.col(delay)
    return df.agg(F.count(F.lit(1)).alias("Total_Rows"), F.avg(d).alias("Avg_Delay"),
                  C.pct(d == 0).alias("On_Time_Pct"), C.pct(d > 60).alias("Major_Delay_Pct"))


# ---- D12-D15, D30, D33: volumes and periods --------------------------------

def yearly_volume(df: DataFrame, year: str = "Year") -> DataFrame:
    """Rows per year."""
    return df.where(F.col(year).isNotNull()).groupBy(year).agg(F.count(F.lit(1)).alias("FlightCount"))


def monthly_volume(df: DataFrame, year: str = "Year", month: str = "Month") -> DataFrame:
    """Rows per (year, month)."""
    return (df.where(F.col(year).isNotNull() & F.col(month).isNotNull())
            .groupBy(year, month).agg(F.count(F.lit(1)).alias("FlightCount")))


def volume_vs_baseline(df: DataFrame, baseline_year: int, compare_years: Sequence[int],
                       year: str = "Year", month: str = "Month") -> DataFrame:
    """Mean monthly volume per compared year and % change against
    the baseline year's mean monthly volume (E7: one-row broadcast)."""
    m = monthly_volume(df.where(F.col(year).isin(baseline_year, *compare_years)), year, month)
    per_year = m.groupBy(year).agg(F.avg("FlightCount").alias("Avg_Monthly_Flights"))
    base = per_year.where(F.col(year) == baseline_year).select("Avg_Monthly_Flights").scalar()
    return (per_year.where(F.col(year).isin(*compare_years))
            .withColumn("Baseline_Avg_Monthly", base)
            .withColumn("Pct_Change", F.try_divide(
                (F.col("Avg_Monthly_Flights") - F.col("Baseline_Avg_Monthly")) * 100.0,
                F.col("Baseline_Avg_Monthly"))))


def period_delay_stats(df: DataFrame, periods: dict[str, Sequence[int]], year: str = "Year",
                       dep: str = "DepDelayMinutes", arr: str = "ArrDelayMinutes") -> DataFrame:
    """Per period rows, dep/arr mean, median, std, on-time %, major %.
    One pass grouped by a derived ``Period`` column (C3)."""
    d, a = F.col(dep), F.col(arr)
    return (df.withColumn("Period", C.period_of(year, periods)).where(F.col("Period").isNotNull())
            .groupBy("Period").agg(
                F.count(F.lit(1)).alias("flight_count"),
                F.avg(d).alias("dep_delay_mean"), F.median(d).alias("dep_delay_median"),
                F.stddev_samp(d).alias("dep_delay_std"),
                F.avg(a).alias("arr_delay_mean"), F.median(a).alias("arr_delay_median"),
                F.stddev_samp(a).alias("arr_delay_std"),
                C.pct(d == 0).alias("on_time_pct"), C.pct(d > 60).alias("major_delay_pct")))


def month_year_pivot(df: DataFrame, years: Sequence[int], year: str = "Year",
                     month: str = "Month") -> DataFrame:
    """Months x years volume matrix (years listed so the pivot needs
    no extra distinct job)."""
    return (df.where(F.col(month).isNotNull()).groupBy(month)
            .pivot(year, list(years)).agg(F.count(F.lit(1)))
            .select(month, *[F.coalesce(F.col(str(y)), F.lit(0)).cast("bigint").alias(f"y{y}")
                             for y in years]))


def period_contrast(df: DataFrame, gap_years: Sequence[int], normal_years: Sequence[int],
                    year: str = "Year", delay: str = "DepDelayMinutes") -> DataFrame:
    """Rows, avg delay and on-time % for gap years vs normal years."""
    y, d = F.col(year), F.col(delay)
    grp = F.when(y.isin(*gap_years), "gap").when(y.isin(*normal_years), "normal")
    return (df.withColumn("Group", grp).where(F.col("Group").isNotNull()).groupBy("Group")
            .agg(F.count(F.lit(1)).alias("Flights"), F.avg(d).alias("Avg_Delay"),
                 C.pct(d == 0).alias("On_Time_Pct")))


# ---- D16-D24: delay analysis ----------------------------------------------

def route_stats(df: DataFrame, key: str = "Route", delay: str = "DepDelayMinutes",
                date: str = "DepDate", min_flights: int = 100) -> DataFrame:
    """D16 (+E5, C4): count, mean, median, std, max, distinct days, delay
    frequency, major rate, on-time rate; routes with fewer than ``min_flights``
    non-null delays are dropped. One hash aggregate makes a histogram of minutes
    and, by ``bit_or``, 64-day words of the days operated per route; all figures,
    the exact median included, come from that small table. No buffer holds a
    route's values or days."""
    day = F.unix_date(F.col(date))
    # two entries a row: its minutes, and its day as a bit in a word of 64 days
    entries = F.array(F.struct(F.lit(0).alias("kind"), F.col(delay).cast("double").alias("minutes"), F.lit(None).cast("int").alias("word"),
                               F.lit(0).cast("long").alias("bit")),
                      F.struct(F.lit(1).alias("kind"), F.lit(None).cast("double").alias("minutes"), F.floor(day / 64).cast("int").alias("word"),
                               F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(day, F.lit(64)).cast("int")).alias("bit")))
    table = (df.where(F.col(key).isNotNull()).select(key, F.explode(entries).alias("e")).select(key, "e.*")
             .groupBy(key, "kind", "minutes", "word").agg(F.count(F.lit(1)).alias("n"), F.bit_or("bit").alias("days")))
    # at most one row per route and distinct minute from here on
    m, n = F.col("minutes"), F.col("n")
    here = (F.col("kind") == 0) & m.isNotNull()
    flights, some = F.sum(F.when(here, n).otherwise(0)), Window.partitionBy(key)
    upto = some.orderBy("kind", F.col("minutes").asc_nulls_first(), "word").rowsBetween(Window.unboundedPreceding, 0)
    table = table.withColumns({"upto": flights.over(upto), "all": flights.over(some)})
    at = lambda k: F.min(F.when(here & (F.col("upto") > k), m))
    low, high = F.floor((F.col("all") - 1) / 2), F.floor(F.col("all") / 2)
    share = lambda cond: F.sum(F.when(cond & here, n).otherwise(0)) / F.sum(F.when(F.col("kind") == 0, n)) * 100.0
    total, squares = F.sum(F.when(here, m * n)), F.sum(F.when(here, m * m * n))
    count = flights
    return (table.groupBy(key)
            .agg(count.alias("Flight_Count"), (total / count).alias("Avg_Delay"), ((at(low) + at(high)) / 2).alias("Median_Delay"),
                 F.when(count > 1, F.sqrt(F.greatest(squares - total * total / count, F.lit(0.0)) / (count - 1))).alias("Delay_Std"),
                 F.max(F.when(here, m)).alias("Max_Delay"), F.sum(F.bit_count("days")).cast("bigint").alias("Days_Operated"),
                 share(m > 0).alias("Delay_Frequency"), share(m > 60).alias("Major_Delay_Rate"), share(m == 0).alias("On_Time_Rate"))
            .where(F.col("Flight_Count") >= min_flights))


def hourly_delays(df: DataFrame, hour: str = "CRSDepTimeHour", delay: str = "DepDelayMinutes") -> DataFrame:
    """D17."""
    return group_delays(df, hour, delay)


def weekday_delays(df: DataFrame, dow: str = "DayOfWeek", delay: str = "DepDelayMinutes") -> DataFrame:
    """Per weekday (Monday=0) with its name."""
    return group_delays(df, dow, delay).withColumn("DayName", C.name_of(dow, C.DAY_NAMES, 0))


def season_delays(df: DataFrame, season: str = "Season", delay: str = "DepDelayMinutes") -> DataFrame:
    """D19."""
    return group_delays(df, season, delay)


def airport_delays(df: DataFrame, origin: str = "OriginCity", delay: str = "DepDelayMinutes",
                   min_flights: int = 1000) -> DataFrame:
    """D20 (+C4)."""
    return group_delays(df, origin, delay).where(F.col("Flight_Count") >= min_flights)


def monthly_delays(df: DataFrame, month: str = "Month", delay: str = "DepDelayMinutes") -> DataFrame:
    """Per month with std and the month name."""
    return (group_delays(df, month, delay, with_std=True)
            .withColumn("MonthName", C.name_of(month, C.MONTH_NAMES, 1)))


def quarterly_delays(df: DataFrame, quarter: str = "Quarter", delay: str = "DepDelayMinutes") -> DataFrame:
    """Per quarter, labelled 'Q1 (Winter)' ..."""
    return (group_delays(df, quarter, delay)
            .withColumn("QuarterName", C.name_of(quarter, C.QUARTER_NAMES, 1)))


def yearly_delays(df: DataFrame, year: str = "Year", delay: str = "DepDelayMinutes") -> DataFrame:
    """D23."""
    return group_delays(df, year, delay)


def daily_series(df: DataFrame, date: str = "DepDate", delay: str = "DepDelayMinutes",
                 key: str | None = None) -> DataFrame:
    """Mean delay per day (optionally per series key) as (key, d, y)."""
    keys = ([key] if key else []) + [date]
    out = (df.where(F.col(date).isNotNull()).groupBy(*keys)
           .agg(F.avg(delay).alias("y")).withColumnRenamed(date, "d"))
    return out


# ---- D26-D29, D31, D32, D34 -----------------------------------------------

# Cause columns reported by the operational analysis.
CAUSES = ["WeatherDelay", "CarrierDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay"]


def cause_report(df: DataFrame, causes: Sequence[str] = CAUSES, delay: str = "DepDelayMinutes",
                 actionable: Sequence[str] = ("CarrierDelay", "LateAircraftDelay"),
                 monitor: Sequence[str] = ("WeatherDelay", "NASDelay")) -> DataFrame:
    """Per cause avg minutes, % of flights affected (>0), its minutes
    as % of all departure-delay minutes, and an action class (ACTIONABLE /
    MONITOR / none); one aggregate, then unpivot."""
    causes = [c for c in causes if c in df.columns]
    agg = df.agg(F.sum(delay).alias("__tot"),
                 *[F.struct(F.avg(c).alias("Avg_Minutes"),
                            C.pct(F.col(c) > 0).alias("Pct_Flights_Affected"),
                            F.sum(c).alias("Total_Minutes")).alias(f"__c{i}")
                   for i, c in enumerate(causes)])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("Cause"), F.col(f"__c{i}.*"))
                               for i, c in enumerate(causes)]))
    out = agg.select("__tot", rows.alias("r")).select(
        "r.Cause", "r.Avg_Minutes", "r.Pct_Flights_Affected", "r.Total_Minutes",
        F.try_divide(F.col("r.Total_Minutes") * 100.0, F.col("__tot")).alias("Pct_Of_Delay_Minutes"))
    return out.withColumn("Action", F.when(F.col("Cause").isin(*actionable), "ACTIONABLE")
                          .when(F.col("Cause").isin(*monitor), "MONITOR"))


def operational_means(df: DataFrame, delayed: str = "IsDelayed") -> DataFrame:
    """Avg taxi-out, taxi-in, distance; delayed count and %."""
    return df.agg(F.avg("TaxiOut").alias("Avg_TaxiOut"), F.avg("TaxiIn").alias("Avg_TaxiIn"),
                  F.avg("Distance").alias("Avg_Distance"),
                  F.count_if(F.col(delayed) == 1).alias("Delayed_Count"),
                  C.pct(F.col(delayed) == 1).alias("Delayed_Pct"))


def target_stats(df: DataFrame, target: str = "DepDelayMinutes") -> DataFrame:
    """D28."""
    t = F.col(target)
    return df.agg(F.avg(t).alias("Mean"), F.stddev_samp(t).alias("Std"),
                  F.min(t).alias("Min"), F.max(t).alias("Max"))


def class_balance(df: DataFrame, split: str = "Split", label: str = "IsDelayed") -> DataFrame:
    """Delayed count and % per split."""
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("Rows"),
                                 F.count_if(F.col(label) == 1).alias("Delayed_Count"),
                                 C.pct(F.col(label) == 1).alias("Delayed_Pct"))


def histogram(df: DataFrame, col: str, bins: int, lo: float | None = None,
              hi: float | None = None, spark: SparkSession | None = None) -> DataFrame:
    """Equal-width bins over [lo, hi] (data min/max when not given);
    the last bin is closed; empty bins are zero-filled from a bins-row
    range. Values outside [lo, hi] and nulls are ignored."""
    spark = spark or df.sparkSession
    x = F.col(col).cast("double")
    vals = df.select(x.alias("x")).where(F.col("x").isNotNull())
    if lo is not None:
        vals = vals.where(F.col("x") >= lo)
    if hi is not None:
        vals = vals.where(F.col("x") <= hi)
    lo_c = F.lit(float(lo)) if lo is not None else vals.agg(F.min("x")).scalar()
    hi_c = F.lit(float(hi)) if hi is not None else vals.agg(F.max("x")).scalar()
    with_b = lambda d: d.withColumns({"lo": lo_c, "hi": hi_c})
    width = (F.col("hi") - F.col("lo")) / bins
    b = F.least(F.floor(F.try_divide(F.col("x") - F.col("lo"), width)), F.lit(bins - 1))
    b = F.coalesce(b, F.lit(0)).cast("int")
    counts = with_b(vals).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = with_b(spark.range(bins).select(F.col("id").cast("int").alias("bin")))
    return (grid.join(counts, "bin", "left")
            .select("bin", (F.col("lo") + F.col("bin") * width).alias("bin_start"),
                    (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_end"),
                    F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))


def target_correlations(df: DataFrame, features: Sequence[str], target: str, n: int = 10) -> DataFrame:
    """|Pearson r| of each feature with the target, top ``n``."""
    agg = df.agg(*[F.abs(F.corr(F.col(f).cast("double"), F.col(target).cast("double"))).alias(f"__r{i}")
                   for i, f in enumerate(features)])
    rows = agg.select(F.explode(F.array(*[
        F.struct(F.lit(f).alias("Feature"), F.col(f"__r{i}").alias("Abs_Correlation"))
        for i, f in enumerate(features)])).alias("s")).select("s.*")
    return rows.where(F.col("Abs_Correlation").isNotNull()).orderBy(
        F.desc("Abs_Correlation"), "Feature").limit(n)


def hour_actual_vs_pred(df: DataFrame, hour: str = "CRSDepTimeHour", actual: str = "y",
                        pred: str = "y_hat") -> DataFrame:
    """Mean actual and mean prediction per hour."""
    return (df.where(F.col(hour).isNotNull()).groupBy(hour)
            .agg(F.avg(actual).alias("Avg_Actual"), F.avg(pred).alias("Avg_Predicted")))
