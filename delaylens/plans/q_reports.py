"""D-, E-, G- and H-family queries: grouped reports, lookups, top-k and
set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from delaylens.functions import columns as C
from delaylens.functions import guards as G
from delaylens.operators import clean, features as B, filters as CF, lookups as E, reports as R
from delaylens.operators import sets as H, topk as T
from delaylens.plans import params as P
from delaylens.plans.inputs import KEYS, fl, trips
from delaylens.plans.oracle_base import with_
from delaylens.plans.q_rows import ROUTE_STATS_SQL, _names_case, _period_case
from delaylens.plans.q_sources import FLIGHT_COLS
from delaylens.plans.registry import q
from delaylens.plans.analysis import INSIGHT_TEXT as _IT

K = ", ".join(KEYS)
TRIPS_COLS = [c for c in FLIGHT_COLS if c not in ("FlightDate", "OriginCityName", "DestCityName")] + [
    "DepDate", "OriginCity", "OriginState", "DestCity", "DestState", "CarrierName", "Year", "Month",
    "Day", "DayOfWeek", "Quarter", "Season", "Route", "DelaySeverity"]
YEARS = list(range(1995, 2002))
D = "DepDelayMinutes"


def pct_sql(cond: str) -> str:
    return f"avg(CASE WHEN {cond} THEN 1.0e0 ELSE 0.0e0 END) * 100.0e0"


def group_sql(key: str, src: str = "trips", std: bool = False, where: str = "") -> str:
    s = (f"SELECT {key}, CAST(count({D}) AS BIGINT) AS Flight_Count, avg({D}) AS Avg_Delay, "
         f"CAST(median({D}) AS DOUBLE) AS Median_Delay")
    if std:
        s += f", stddev_samp({D}) AS Delay_Std"
    return s + f" FROM {src} WHERE {key} IS NOT NULL {where} GROUP BY {key}"


# ---- D1-D11 ---------------------------------------------------------------

@q("missing_report", with_("trips") + "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS Column, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS Missing_Count, "
    f"count(*) FILTER (WHERE {c} IS NULL) * 100.0e0 / count(*) AS Missing_Percentage FROM trips"
    for c in TRIPS_COLS) + ") WHERE Missing_Count > 0")
def missing_report(spark, sf):
    """D1."""
    return R.missing_report(trips(spark, sf))


@q("duplicate_count", with_("flights") + """
SELECT CAST(count(*) AS BIGINT) AS Total_Rows,
  CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM flights)) AS BIGINT) AS Duplicate_Rows,
  (count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM flights))) * 100.0e0 / count(*) AS Duplicate_Percentage
FROM flights""")
def duplicate_count(spark, sf):
    """D2."""
    return R.duplicate_count(fl(spark, sf))


@q("drop_duplicates", with_("trips") + "SELECT DISTINCT * FROM trips")
def drop_duplicates(spark, sf):
    """D3."""
    return clean.drop_duplicates(trips(spark, sf))


_DELAY_NUM = ["DepDelay", "ArrDelay", "DepDelayMinutes", "ArrDelayMinutes", "WeatherDelay",
              "CarrierDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay"]


@q("numeric_profile", with_("flights") + " UNION ALL ".join(
    f"SELECT '{c}' AS Column, CAST(min({c}) AS DOUBLE) AS Min, CAST(max({c}) AS DOUBLE) AS Max, "
    f"avg({c}) AS Mean, CAST(median({c}) AS DOUBLE) AS Median, stddev_samp({c}) AS Std, "
    f"CAST(count(*) FILTER (WHERE {c} > (SELECT quantile_cont({c}, 0.99) FROM flights)) AS BIGINT) AS Outliers_Q99 "
    f"FROM flights" for c in _DELAY_NUM))
def numeric_profile(spark, sf):
    """D5."""
    return R.numeric_profile(fl(spark, sf))


@q("carrier_summary", with_("flights") + f"""
SELECT CAST(count(*) AS BIGINT) AS Rows_Kept, min(FlightDate) AS Min_Date, max(FlightDate) AS Max_Date,
  CAST(count(DISTINCT OriginCityName) AS BIGINT) AS Distinct_Origins,
  CAST(count(DISTINCT DestCityName) AS BIGINT) AS Distinct_Destinations,
  avg(DepDelay) AS Avg_Dep_Delay, max(DepDelay) AS Max_Dep_Delay,
  CAST(count(*) FILTER (WHERE DepDelay > 0) AS BIGINT) AS Dep_Delayed_Count,
  avg(ArrDelay) AS Avg_Arr_Delay, max(ArrDelay) AS Max_Arr_Delay,
  CAST(count(*) FILTER (WHERE ArrDelay > 0) AS BIGINT) AS Arr_Delayed_Count,
  (SELECT CAST(count(*) AS BIGINT) FROM flights) AS Total_Rows,
  count(*) * 100.0e0 / (SELECT count(*) FROM flights) AS Pct_Of_Total
FROM flights WHERE Marketing_Airline_Network = '{P.CARRIER}'""")
def carrier_summary(spark, sf):
    """D6."""
    df = fl(spark, sf)
    return R.carrier_summary(CF.filter_carrier(df, P.CARRIER), df.agg(F.count(F.lit(1)).alias("Total_Rows")))


@q("severity_counts", with_("flights") + "SELECT CAST(count(*) AS BIGINT) AS Total_Rows, " + ", ".join(
    f"CAST(count(*) FILTER (WHERE {c}) AS BIGINT) AS {k}_Count, {pct_sql(c)} AS {k}_Pct"
    for k, c in [("On_Time", f"{D} = 0"), ("Minor", f"{D} > 0 AND {D} <= 15"),
                 ("Moderate", f"{D} > 15 AND {D} <= 60"), ("Major", f"{D} > 60")]) + " FROM flights")
def severity_counts(spark, sf):
    """D7."""
    return R.severity_counts(fl(spark, sf))


_VC = ["Season", "CarrierName", "DelaySeverity", "Route", "Year"]


@q("value_counts", with_("trips") + " UNION ALL ".join(
    f"SELECT * FROM (SELECT '{c}' AS Column, CAST({c} AS VARCHAR) AS Value, CAST(count(*) AS BIGINT) AS count "
    f"FROM trips WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count DESC, {c} "
    + ("LIMIT 10" if c == "Route" else "") + ")" for c in _VC))
def value_counts(spark, sf):
    """Season, CarrierName, DelaySeverity, Route (top 10), Year."""
    return R.value_counts_many(trips(spark, sf), _VC, top={"Route": 10})


_CARD = ["OriginCity", "OriginState", "DestCity", "DestState", "Route", "Marketing_Airline_Network"]


@q("cardinality", with_("trips") + " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(count(DISTINCT {c}) AS BIGINT) AS n_distinct FROM trips" for c in _CARD))
def cardinality(spark, sf):
    """D9."""
    return R.cardinality(trips(spark, sf), _CARD)


@q("year_counts_before_after", with_("trips") + f"""
SELECT Year, CAST(count(*) AS BIGINT) AS Rows_Before,
  CAST(count(*) FILTER (WHERE Year IS NULL OR Year NOT IN {P.EXCLUDE_YEARS}) AS BIGINT) AS Rows_After,
  CAST(count(*) - count(*) FILTER (WHERE Year IS NULL OR Year NOT IN {P.EXCLUDE_YEARS}) AS BIGINT) AS Rows_Removed
FROM trips GROUP BY Year""")
def year_counts_before_after(spark, sf):
    """D10."""
    return R.year_counts_before_after(trips(spark, sf), P.EXCLUDE_YEARS)


@q("delay_kpis", with_("trips") + f"""
SELECT CAST(count(*) AS BIGINT) AS Total_Rows, avg({D}) AS Avg_Delay, {pct_sql(f'{D} = 0')} AS On_Time_Pct,
  {pct_sql(f'{D} > 60')} AS Major_Delay_Pct FROM trips WHERE Year IS NULL OR Year NOT IN {P.EXCLUDE_YEARS}""")
def delay_kpis(spark, sf):
    """D11 on the gap-free table."""
    return R.delay_kpis(CF.exclude_years(trips(spark, sf), P.EXCLUDE_YEARS))


# ---- D12-D15, D30, D31, D33 -------------------------------------------------

@q("yearly_volume", with_("trips") + "SELECT Year, CAST(count(*) AS BIGINT) AS FlightCount FROM trips WHERE Year IS NOT NULL GROUP BY Year")
def yearly_volume(spark, sf):
    """D12."""
    return R.yearly_volume(trips(spark, sf))


@q("monthly_volume", with_("trips") + "SELECT Year, Month, CAST(count(*) AS BIGINT) AS FlightCount FROM trips "
   "WHERE Year IS NOT NULL AND Month IS NOT NULL GROUP BY Year, Month")
def monthly_volume(spark, sf):
    """D13."""
    return R.monthly_volume(trips(spark, sf))


@q("volume_vs_baseline", with_("trips", extra={
    "m": f"SELECT Year, Month, count(*) AS FlightCount FROM trips WHERE Year IN {(P.BASELINE_YEAR,) + P.GAP_YEARS} GROUP BY Year, Month",
    "py": "SELECT Year, avg(FlightCount) AS Avg_Monthly_Flights FROM m GROUP BY Year"}) + f"""
SELECT Year, Avg_Monthly_Flights, (SELECT Avg_Monthly_Flights FROM py WHERE Year = {P.BASELINE_YEAR}) AS Baseline_Avg_Monthly,
  (Avg_Monthly_Flights - (SELECT Avg_Monthly_Flights FROM py WHERE Year = {P.BASELINE_YEAR})) * 100.0e0
   / (SELECT Avg_Monthly_Flights FROM py WHERE Year = {P.BASELINE_YEAR}) AS Pct_Change
FROM py WHERE Year IN {P.GAP_YEARS}""")
def volume_vs_baseline(spark, sf):
    """D14 (+E7)."""
    return R.volume_vs_baseline(trips(spark, sf), P.BASELINE_YEAR, P.GAP_YEARS)


@q("period_delay_stats", with_("trips") + f"""
SELECT Period, CAST(count(*) AS BIGINT) AS flight_count,
  avg(DepDelayMinutes) AS dep_delay_mean, CAST(median(DepDelayMinutes) AS DOUBLE) AS dep_delay_median,
  stddev_samp(DepDelayMinutes) AS dep_delay_std,
  avg(ArrDelayMinutes) AS arr_delay_mean, CAST(median(ArrDelayMinutes) AS DOUBLE) AS arr_delay_median,
  stddev_samp(ArrDelayMinutes) AS arr_delay_std,
  {pct_sql('DepDelayMinutes = 0')} AS on_time_pct, {pct_sql('DepDelayMinutes > 60')} AS major_delay_pct
FROM (SELECT *, {_period_case()} AS Period FROM trips) WHERE Period IS NOT NULL GROUP BY Period""")
def period_delay_stats(spark, sf):
    """D15."""
    return R.period_delay_stats(trips(spark, sf), P.PERIODS)


@q("month_year_pivot", with_("trips") + "SELECT Month, " + ", ".join(
    f"CAST(count(*) FILTER (WHERE Year = {y}) AS BIGINT) AS y{y}" for y in YEARS)
   + " FROM trips WHERE Month IS NOT NULL GROUP BY Month")
def month_year_pivot(spark, sf):
    """D30."""
    return R.month_year_pivot(trips(spark, sf), YEARS)


_HIST_SRC = f"SELECT CAST({D} AS DOUBLE) AS x FROM trips WHERE {D} IS NOT NULL AND {D} >= 0 AND {D} <= 120"


def hist_sql(src_cte: str, bins: int) -> str:
    return f"""SELECT CAST(g.bin AS INTEGER) AS bin, lo + g.bin * w AS bin_start, lo + (g.bin + 1) * w AS bin_end,
  CAST(COALESCE(c.count, 0) AS BIGINT) AS count
FROM (SELECT range AS bin, lo, w FROM range({bins}),
      (SELECT min(x) AS lo, (max(x) - min(x)) / {bins} AS w FROM {src_cte})) g
LEFT JOIN (SELECT CAST(COALESCE(LEAST(FLOOR((x - lo) / NULLIF(w, 0)), {bins - 1}), 0) AS INTEGER) AS bin,
                  count(*) AS count
           FROM {src_cte}, (SELECT min(x) AS lo, (max(x) - min(x)) / {bins} AS w FROM {src_cte}) b
           GROUP BY 1) c ON g.bin = c.bin"""


@q("histogram", with_("trips", extra={"hx": _HIST_SRC}) + hist_sql("hx", 30))
def histogram(spark, sf):
    """30 equal-width bins of departure delay within 0-120."""
    df = CF.range_filter(trips(spark, sf), D, 0, 120)
    return R.histogram(df, D, 30)


@q("period_contrast", with_("trips") + f"""
SELECT CASE WHEN Year IN {P.GAP_YEARS} THEN 'gap' ELSE 'normal' END AS "Group",
  CAST(count(*) AS BIGINT) AS Flights, avg({D}) AS Avg_Delay, {pct_sql(f'{D} = 0')} AS On_Time_Pct
FROM trips WHERE Year IN {P.GAP_YEARS + P.NORMAL_YEARS} GROUP BY 1""")
def period_contrast(spark, sf):
    """D33."""
    return R.period_contrast(trips(spark, sf), P.GAP_YEARS, P.NORMAL_YEARS)


# ---- D16-D24 ---------------------------------------------------------------

@q("route_stats", with_("trips") + ROUTE_STATS_SQL.format(min_flights=P.MIN_ROUTE_FLIGHTS))
def route_stats(spark, sf):
    """D16 (+C4)."""
    return R.route_stats(trips(spark, sf), min_flights=P.MIN_ROUTE_FLIGHTS)


@q("hourly_delays", with_("trips") + group_sql("CRSDepTimeHour"))
def hourly_delays(spark, sf):
    """D17."""
    return R.hourly_delays(trips(spark, sf))


@q("weekday_delays", with_("trips") + f"SELECT *, {_names_case('DayOfWeek', C.DAY_NAMES, 0)} AS DayName FROM ("
   + group_sql("DayOfWeek") + ")")
def weekday_delays(spark, sf):
    """D18."""
    return R.weekday_delays(trips(spark, sf))


@q("season_delays", with_("trips") + group_sql("Season"))
def season_delays(spark, sf):
    """D19."""
    return R.season_delays(trips(spark, sf))


@q("airport_delays", with_("trips") + "SELECT * FROM (" + group_sql("OriginCity")
   + f") WHERE Flight_Count >= {P.MIN_AIRPORT_FLIGHTS}")
def airport_delays(spark, sf):
    """D20 (+C4)."""
    return R.airport_delays(trips(spark, sf), min_flights=P.MIN_AIRPORT_FLIGHTS)


@q("monthly_delays", with_("trips") + f"SELECT *, {_names_case('Month', C.MONTH_NAMES, 1)} AS MonthName FROM ("
   + group_sql("Month", std=True) + ")")
def monthly_delays(spark, sf):
    """D21."""
    return R.monthly_delays(trips(spark, sf))


@q("quarterly_delays", with_("trips") + f"SELECT *, {_names_case('Quarter', C.QUARTER_NAMES, 1)} AS QuarterName FROM ("
   + group_sql("Quarter") + ")")
def quarterly_delays(spark, sf):
    """D22."""
    return R.quarterly_delays(trips(spark, sf))


@q("yearly_delays", with_("trips") + group_sql("Year"))
def yearly_delays(spark, sf):
    """D23."""
    return R.yearly_delays(trips(spark, sf))


DAILY_SQL = f"SELECT DepDate AS d, avg({D}) AS y FROM trips WHERE DepDate IS NOT NULL GROUP BY DepDate"


@q("daily_series", with_("trips") + DAILY_SQL)
def daily_series(spark, sf):
    """D24."""
    return R.daily_series(trips(spark, sf))


# ---- D26-D29, D32, D34 -----------------------------------------------------

_C5 = ["WeatherDelay", "CarrierDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay"]
_ACTION = {"CarrierDelay": "'ACTIONABLE'", "LateAircraftDelay": "'ACTIONABLE'", "WeatherDelay": "'MONITOR'",
           "NASDelay": "'MONITOR'"}


@q("cause_report", with_("flights") + " UNION ALL ".join(
    f"SELECT '{c}' AS Cause, avg({c}) AS Avg_Minutes, {pct_sql(f'{c} > 0')} AS Pct_Flights_Affected, "
    f"sum({c}) AS Total_Minutes, sum({c}) * 100.0e0 / sum({D}) AS Pct_Of_Delay_Minutes, "
    f"CAST({_ACTION.get(c, 'NULL')} AS VARCHAR) AS Action FROM flights"
    for c in _C5))
def cause_report(spark, sf):
    """D26."""
    return R.cause_report(fl(spark, sf))


@q("operational_means", with_("flights") + f"""
SELECT avg(TaxiOut) AS Avg_TaxiOut, avg(TaxiIn) AS Avg_TaxiIn, avg(Distance) AS Avg_Distance,
  CAST(count(*) FILTER (WHERE {D} > 0) AS BIGINT) AS Delayed_Count, {pct_sql(f'{D} > 0')} AS Delayed_Pct FROM flights""")
def operational_means(spark, sf):
    """D27."""
    return R.operational_means(B.add_is_delayed(fl(spark, sf)))


@q("target_stats", with_("flights") + f"SELECT avg({D}) AS Mean, stddev_samp({D}) AS Std, min({D}) AS Min, max({D}) AS Max FROM flights")
def target_stats(spark, sf):
    """D28."""
    return R.target_stats(fl(spark, sf))


_SPLIT = (f"CASE WHEN Year IN {P.TRAIN_YEARS} THEN 'train' WHEN Year IN {P.TEST_YEARS} THEN 'test' END")


@q("class_balance", with_("trips") + f"""
SELECT Split, CAST(count(*) AS BIGINT) AS Rows, CAST(count(*) FILTER (WHERE {D} > 0) AS BIGINT) AS Delayed_Count,
  {pct_sql(f'{D} > 0')} AS Delayed_Pct FROM (SELECT *, {_SPLIT} AS Split FROM trips) WHERE Split IS NOT NULL GROUP BY Split""")
def class_balance(spark, sf):
    """Delayed share per time split."""
    df = B.add_is_delayed(trips(spark, sf))
    y = F.col("Year")
    df = df.withColumn("Split", F.when(y.isin(*P.TRAIN_YEARS), "train").when(y.isin(*P.TEST_YEARS), "test"))
    return R.class_balance(df.where(F.col("Split").isNotNull()))


_CORR_FEATS = ["CRSDepTimeHour", "Distance", "TaxiOut", "TaxiIn", "Month", "DayOfWeek", "Quarter",
               "WeatherDelay", "CarrierDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay"]


@q("target_correlations", with_("trips") + "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{f}' AS Feature, abs(corr(CAST({f} AS DOUBLE), {D})) AS Abs_Correlation FROM trips"
    for f in _CORR_FEATS) + ") WHERE Abs_Correlation IS NOT NULL AND NOT isnan(Abs_Correlation) ORDER BY Abs_Correlation DESC, Feature LIMIT 10")
def target_correlations(spark, sf):
    """D32."""
    return R.target_correlations(trips(spark, sf), _CORR_FEATS, D, 10)


@q("hour_actual_vs_pred", with_("flights") + f"""
SELECT CRSDepTimeHour, avg({D}) AS Avg_Actual, avg(TaxiOut) AS Avg_Predicted FROM flights
WHERE CRSDepTimeHour IS NOT NULL GROUP BY CRSDepTimeHour""")
def hour_actual_vs_pred(spark, sf):
    """D34 on the regression fixture (y = delay, y_hat = TaxiOut)."""
    return R.hour_actual_vs_pred(fl(spark, sf), actual=D, pred="TaxiOut")


# ---- E-family ----------------------------------------------------------------

@q("group_stats_lookup", with_("trips") + f"""
SELECT {K}, t.Route, r.RouteFrequency, r.RouteAvgDelay, o.OriginAvgDelay, d.DestAvgDelay FROM trips t
LEFT JOIN (SELECT Route, CAST(count(*) AS BIGINT) AS RouteFrequency, avg({D}) AS RouteAvgDelay FROM trips WHERE Route IS NOT NULL GROUP BY Route) r ON t.Route = r.Route
LEFT JOIN (SELECT OriginCity, avg({D}) AS OriginAvgDelay FROM trips WHERE OriginCity IS NOT NULL GROUP BY OriginCity) o ON t.OriginCity = o.OriginCity
LEFT JOIN (SELECT DestCity, avg({D}) AS DestAvgDelay FROM trips WHERE DestCity IS NOT NULL GROUP BY DestCity) d ON t.DestCity = d.DestCity""")
def group_stats_lookup(spark, sf):
    """E1."""
    return E.group_stats_lookup(trips(spark, sf)).select(
        *KEYS, "Route", "RouteFrequency", "RouteAvgDelay", "OriginAvgDelay", "DestAvgDelay")


@q("group_stats_rich", with_("trips") + f"""
SELECT {K}, t.Route, r.Route_Avg_Delay, r.Route_Std_Delay, r.Route_Flight_Count, o.Origin_Avg_Delay, o.Origin_Std_Delay,
  d.Dest_Avg_Delay, d.Dest_Std_Delay FROM trips t
LEFT JOIN (SELECT Route, round_even(avg({D}), 2) AS Route_Avg_Delay, round_even(stddev_samp({D}), 2) AS Route_Std_Delay,
  CAST(count({D}) AS BIGINT) AS Route_Flight_Count FROM trips WHERE Route IS NOT NULL GROUP BY Route) r ON t.Route = r.Route
LEFT JOIN (SELECT OriginCity, round_even(avg({D}), 2) AS Origin_Avg_Delay, round_even(stddev_samp({D}), 2) AS Origin_Std_Delay
  FROM trips WHERE OriginCity IS NOT NULL GROUP BY OriginCity) o ON t.OriginCity = o.OriginCity
LEFT JOIN (SELECT DestCity, round_even(avg({D}), 2) AS Dest_Avg_Delay, round_even(stddev_samp({D}), 2) AS Dest_Std_Delay
  FROM trips WHERE DestCity IS NOT NULL GROUP BY DestCity) d ON t.DestCity = d.DestCity""")
def group_stats_rich(spark, sf):
    """E2."""
    return E.group_stats_rich(trips(spark, sf)).select(
        *KEYS, "Route", "Route_Avg_Delay", "Route_Std_Delay", "Route_Flight_Count", "Origin_Avg_Delay",
        "Origin_Std_Delay", "Dest_Avg_Delay", "Dest_Std_Delay")


_TRAIN = f"Year IN {P.TRAIN_YEARS}"
_TT = f"SELECT *, COALESCE({_TRAIN}, false) AS is_train FROM trips WHERE Year IN {P.TRAIN_YEARS + P.TEST_YEARS}"


def _split_df(spark, sf):
    df = trips(spark, sf).where(F.col("Year").isin(*(P.TRAIN_YEARS + P.TEST_YEARS)))
    return df.withColumn("is_train", F.coalesce(F.col("Year").isin(*P.TRAIN_YEARS), F.lit(False)))


@q("train_priors", with_("trips", extra={"tt": _TT}) + f"""
SELECT {K}, t.is_train, COALESCE(r.p, (SELECT avg({D}) FROM tt WHERE is_train)) AS Route_Prior,
  COALESCE(o.p, (SELECT avg({D}) FROM tt WHERE is_train)) AS Origin_Prior FROM tt t
LEFT JOIN (SELECT Route, avg({D}) AS p FROM tt WHERE is_train AND Route IS NOT NULL GROUP BY Route) r ON t.Route = r.Route
LEFT JOIN (SELECT OriginCity, avg({D}) AS p FROM tt WHERE is_train AND OriginCity IS NOT NULL GROUP BY OriginCity) o ON t.OriginCity = o.OriginCity""")
def train_priors(spark, sf):
    """Leakage-safe priors from train years only."""
    return E.train_priors(_split_df(spark, sf)).select(*KEYS, "is_train", "Route_Prior", "Origin_Prior")


@q("train_traffic_prior", with_("trips", extra={"tt": _TT}) + f"""
SELECT {K}, t.is_train, CAST(COALESCE(c.n, 0) AS BIGINT) AS Origin_Hour_Traffic FROM tt t
LEFT JOIN (SELECT OriginCity, CRSDepTimeHour, count(*) AS n FROM tt WHERE is_train GROUP BY 1, 2) c
  ON t.OriginCity = c.OriginCity AND t.CRSDepTimeHour = c.CRSDepTimeHour""")
def train_traffic_prior(spark, sf):
    """E4."""
    return E.train_traffic_prior(_split_df(spark, sf)).select(*KEYS, "is_train", "Origin_Hour_Traffic")


@q("align_group_metrics", with_("trips") + ROUTE_STATS_SQL.format(min_flights=0))
def align_group_metrics(spark, sf):
    """E5: the per-route metrics the original pasted on by index are one
    aggregate (every route, no support floor)."""
    return R.route_stats(trips(spark, sf), min_flights=0)


@q("densify_calendar", with_("trips", extra={
    "s": f"SELECT DepDate AS d, avg({D}) AS y FROM trips WHERE DepDate IS NOT NULL AND (Year IS NULL OR Year NOT IN {P.EXCLUDE_YEARS}) GROUP BY DepDate"}) + """
SELECT c.d, s.y FROM (SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS d FROM s) c
LEFT JOIN s ON c.d = s.d""")
def densify_calendar(spark, sf):
    """The gap-free daily series reindexed to every day."""
    s = R.daily_series(CF.exclude_years(trips(spark, sf), P.EXCLUDE_YEARS))
    return E.densify_calendar(s)


@q("scalar_baseline", with_("flights") + f"""
SELECT {K}, {D}, (SELECT avg({D}) FROM flights) AS Global_Avg, {D} - (SELECT avg({D}) FROM flights) AS Diff FROM flights""")
def scalar_baseline(spark, sf):
    """E7."""
    df = fl(spark, sf)
    out = E.scalar_baseline(df.select(*KEYS, D), df.agg(F.avg(D).alias("Global_Avg")))
    return out.withColumn("Diff", F.col(D) - F.col("Global_Avg"))


@q("align_rows", with_("trips", extra={"tt": _TT}) + f"""
SELECT {K}, is_train, CAST(CASE WHEN {D} > 0 THEN 1 ELSE 0 END AS INTEGER) AS IsDelayed, {D} FROM tt""")
def align_rows(spark, sf):
    """Targets, ids and split travel in one DataFrame through the
    split; nothing is re-joined by position."""
    df = B.add_is_delayed(_split_df(spark, sf))
    return df.select(*KEYS, "is_train", "IsDelayed", D)


# ---- G-family ----------------------------------------------------------------

def _top_sql(src: str, by: str, n: int, key: str, extra_cols: str = "*") -> str:
    return f"SELECT {extra_cols} FROM {src} ORDER BY {by} DESC, {key} LIMIT {n}"


_RS = {"rs": ROUTE_STATS_SQL.format(min_flights=P.MIN_ROUTE_FLIGHTS)}


@q("top_routes", with_("trips", extra=_RS) + " UNION ALL ".join(
    f"SELECT * FROM (SELECT '{m}' AS Ranking, CAST(row_number() OVER (ORDER BY {m} DESC, Route) AS INTEGER) AS Rank, * "
    f"FROM rs ORDER BY {m} DESC, Route LIMIT 20)" for m in ("Avg_Delay", "Delay_Frequency", "Major_Delay_Rate")))
def top_routes(spark, sf):
    """G1."""
    return T.top_routes(R.route_stats(trips(spark, sf), min_flights=P.MIN_ROUTE_FLIGHTS), 20)


@q("worst_hours", with_("trips", extra={"h": group_sql("CRSDepTimeHour")}) + _top_sql("h", "Avg_Delay", 10, "CRSDepTimeHour"))
def worst_hours(spark, sf):
    """G2."""
    return T.worst_hours(R.hourly_delays(trips(spark, sf)), 10)


@q("worst_airports", with_("trips", extra={"a": group_sql("OriginCity")}) + _top_sql("a", "Avg_Delay", 10, "OriginCity"))
def worst_airports(spark, sf):
    """G3 (no support floor: the driver's tables have 25 origins)."""
    return T.worst_airports(R.group_delays(trips(spark, sf), "OriginCity"), 10)


@q("busiest_routes", with_("trips") + f"""
SELECT * FROM (SELECT Period, Route, Flights, CAST(row_number() OVER (PARTITION BY Period ORDER BY Flights DESC, Route) AS INTEGER) AS Rank
  FROM (SELECT Period, Route, CAST(count(*) AS BIGINT) AS Flights FROM (SELECT *, {_period_case()} AS Period FROM trips)
        WHERE Period IS NOT NULL AND Route IS NOT NULL GROUP BY Period, Route)) WHERE Rank <= 10""")
def busiest_routes(spark, sf):
    """Top 10 routes by flights in each period."""
    return T.busiest_per_group(B.add_period(trips(spark, sf), P.PERIODS), "Period", "Route", 10)


@q("problem_routes", with_("trips", extra={"p": f"SELECT Route, CAST(count({D}) AS BIGINT) AS Flight_Count, avg({D}) AS Avg_Delay FROM trips WHERE Route IS NOT NULL GROUP BY Route HAVING count({D}) >= {P.MIN_ROUTE_FLIGHTS}"})
   + _top_sql("p", "Avg_Delay", 10, "Route"))
def problem_routes(spark, sf):
    """G5."""
    return T.problem_routes(trips(spark, sf), 10, min_flights=P.MIN_ROUTE_FLIGHTS)


@q("extreme_months", with_("trips", extra={"m": group_sql("Month", std=True)}) + """
SELECT (SELECT Month FROM m ORDER BY Avg_Delay DESC, Month LIMIT 1) AS Worst_Month,
  (SELECT Month FROM m ORDER BY Avg_Delay ASC, Month LIMIT 1) AS Best_Month,
  max(Avg_Delay) AS Worst_Avg, min(Avg_Delay) AS Best_Avg FROM m""")
def extreme_months(spark, sf):
    """G6."""
    return T.extreme_months(R.monthly_delays(trips(spark, sf)))


@q("sorted_keys", with_("trips") + "SELECT DISTINCT Year FROM trips WHERE Year IS NOT NULL ORDER BY Year")
def sorted_keys(spark, sf):
    """G8."""
    return T.sorted_keys(trips(spark, sf), "Year")


# ---- H-family ----------------------------------------------------------------

def _routes_in(years):
    return f"SELECT DISTINCT Route FROM trips WHERE Year IN {years} AND Route IS NOT NULL"


@q("routes_dropped", with_("trips") + f"{_routes_in(P.PRE_YEARS)} EXCEPT {_routes_in(P.GAP_YEARS)}")
def routes_dropped(spark, sf):
    """H1."""
    return H.keys_dropped(trips(spark, sf), "Route", P.PRE_YEARS, P.GAP_YEARS)


@q("routes_added", with_("trips") + f"{_routes_in(P.GAP_YEARS)} EXCEPT {_routes_in(P.PRE_YEARS)}")
def routes_added(spark, sf):
    """H2."""
    return H.keys_added(trips(spark, sf), "Route", P.PRE_YEARS, P.GAP_YEARS)


@q("route_change_counts", with_("trips") + f"""
SELECT CAST(count(*) AS BIGINT) AS Total_Routes, CAST(count(*) FILTER (WHERE b = 1 AND a = 0) AS BIGINT) AS Routes_Dropped,
  CAST(count(*) FILTER (WHERE a = 1 AND b = 0) AS BIGINT) AS Routes_Added
FROM (SELECT Route, max(CASE WHEN Year IN {P.PRE_YEARS} THEN 1 ELSE 0 END) AS b,
             max(CASE WHEN Year IN {P.GAP_YEARS} THEN 1 ELSE 0 END) AS a FROM trips WHERE Route IS NOT NULL GROUP BY Route)""")
def route_change_counts(spark, sf):
    """H3."""
    return H.key_change_counts(trips(spark, sf), "Route", P.PRE_YEARS, P.GAP_YEARS)


@q("years_intersect", with_("trips") + f"""
SELECT DISTINCT Year FROM trips WHERE Year IN {P.PRE_YEARS + P.GAP_YEARS}
INTERSECT SELECT DISTINCT Year FROM trips WHERE Year IN {P.GAP_YEARS + P.POST_YEARS}""")
def years_intersect(spark, sf):
    """H4."""
    df = trips(spark, sf)
    return H.years_intersect(df.where(F.col("Year").isin(*(P.PRE_YEARS + P.GAP_YEARS))),
                             df.where(F.col("Year").isin(*(P.GAP_YEARS + P.POST_YEARS))))


@q("union_chunks", with_("trips") + f"SELECT {K}, Year FROM trips WHERE Year IS NOT NULL")
def union_chunks(spark, sf):
    """H5: per-period slices (and the remaining years) concatenated back."""
    df = trips(spark, sf).select(*KEYS, "Year")
    y = F.col("Year")
    listed = P.PRE_YEARS + P.GAP_YEARS + P.POST_YEARS
    parts = [df.where(y.isin(*ys)) for ys in P.PERIODS.values()] + [df.where(~y.isin(*listed))]
    return H.union_chunks(parts)


@q("insights", with_("trips", extra={
    "rs": ROUTE_STATS_SQL.format(min_flights=P.MIN_ROUTE_FLIGHTS),
    "hr": group_sql("CRSDepTimeHour"),
    "mo": group_sql("Month", std=True)}) + f"""
SELECT '{_IT["route"][0]}' AS category,
  printf('{_IT["route"][1]}',
    (SELECT count(*) FROM rs WHERE Avg_Delay > (SELECT quantile_cont(Avg_Delay, 0.8) FROM rs)
       AND Major_Delay_Rate > (SELECT quantile_cont(Major_Delay_Rate, 0.8) FROM rs))) AS finding,
  '{_IT["route"][2]}' AS recommendation
UNION ALL
SELECT '{_IT["time"][0]}', printf('{_IT["time"][1]}', string_agg(printf('%02d:00', CRSDepTimeHour), ', ' ORDER BY Avg_Delay DESC, CRSDepTimeHour)),
  '{_IT["time"][2]}'
FROM (SELECT CRSDepTimeHour, Avg_Delay FROM hr ORDER BY Avg_Delay DESC, CRSDepTimeHour LIMIT 3)
UNION ALL
SELECT '{_IT["season"][0]}', printf('{_IT["season"][1]}',
    {_names_case('(SELECT Month FROM mo ORDER BY Avg_Delay DESC, Month LIMIT 1)', C.MONTH_NAMES, 1)}, (SELECT max(Avg_Delay) FROM mo),
    {_names_case('(SELECT Month FROM mo ORDER BY Avg_Delay ASC, Month LIMIT 1)', C.MONTH_NAMES, 1)}, (SELECT min(Avg_Delay) FROM mo)),
  '{_IT["season"][2]}'""")
def insights(spark, sf):
    """Findings from the high-risk route count (C6), the worst three
    hours (G2) and the extreme months (G6); the trend finding (F5 on the
    STL trend) is added by the analysis plan."""
    from delaylens.plans.analysis import insights as build
    df = trips(spark, sf)
    return build(R.route_stats(df, min_flights=P.MIN_ROUTE_FLIGHTS), R.hourly_delays(df),
                 R.monthly_delays(df), None)
