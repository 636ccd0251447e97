"""B- and C-family queries: row derivations, cleaning and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from delaylens.functions import columns as C
from delaylens.functions import guards as G
from delaylens.operators import clean, features as B, filters as CF, reports as R
from delaylens.operators.sets import years_intersect
from delaylens.plans import params as P
from delaylens.plans.inputs import KEYS, fl, raw, trips
from delaylens.plans.oracle_base import severity_case, with_
from delaylens.plans.registry import q

K = ", ".join(KEYS)
REDUNDANT = ("DepDelay, ArrDelay, CRSDepTimeHourDis, WheelsOffHourDis, CRSArrTimeHourDis, "
             "WheelsOnHourDis")


@q("drop_redundant", with_("raw") + f"SELECT * EXCLUDE ({REDUNDANT}) FROM raw")
def drop_redundant(spark, sf):
    """B1 (pass before derivation: the weekday and carrier twins do not exist yet)."""
    return clean.drop_redundant(raw(spark, sf))


@q("drop_raw_dateparts", with_("raw") + "SELECT * EXCLUDE (Year, Month, DayofMonth) FROM raw")
def drop_raw_dateparts(spark, sf):
    """B2."""
    return clean.drop_raw_dateparts(raw(spark, sf))


@q("parse_date", with_("flights") + "SELECT * EXCLUDE (FlightDate), FlightDate AS DepDate FROM flights")
def parse_date(spark, sf):
    """B3."""
    return B.parse_date(fl(spark, sf))


@q("split_city_state", with_("flights") + f"""
SELECT {K}, string_split(OriginCityName, ', ')[1] AS OriginCity, string_split(OriginCityName, ', ')[2] AS OriginState,
  string_split(DestCityName, ', ')[1] AS DestCity, string_split(DestCityName, ', ')[2] AS DestState,
  len(string_split(OriginCityName, ', ')) <> 2 AS BadOrigin
FROM flights""")
def split_city_state(spark, sf):
    """B4 with the malformed-value flag."""
    df = fl(spark, sf).withColumn("BadOrigin", C.bad_city("OriginCityName"))
    return B.split_city_state(df).select(*KEYS, "OriginCity", "OriginState", "DestCity", "DestState",
                                         "BadOrigin")


@q("map_carrier", with_("trips") + f"SELECT {K}, Marketing_Airline_Network, CarrierName FROM trips")
def map_carrier(spark, sf):
    """B5."""
    return B.map_carrier(fl(spark, sf)).select(*KEYS, "Marketing_Airline_Network", "CarrierName")


@q("unmapped_count", with_("flights") + f"""
SELECT CAST(count(*) FILTER (WHERE Marketing_Airline_Network IS NULL OR Marketing_Airline_Network NOT IN
  ({", ".join(f"'{c}'" for c in C.AIRLINE_NAMES)})) AS BIGINT) AS Unmapped_Rows,
  CAST(count(DISTINCT Marketing_Airline_Network) AS BIGINT) AS Distinct_Codes
FROM flights""")
def unmapped_count(spark, sf):
    """B6 (+D9 distinct codes)."""
    df = fl(spark, sf)
    return df.agg(F.count_if(C.carrier_name_raw("Marketing_Airline_Network").isNull()).alias("Unmapped_Rows"),
                  F.count_distinct("Marketing_Airline_Network").alias("Distinct_Codes"))


@q("fill_delay_nulls", with_("flights") + f"""
SELECT {K}, COALESCE(DepDelayMinutes, 0) AS DepDelayMinutes, COALESCE(ArrDelayMinutes, 0) AS ArrDelayMinutes
FROM flights""")
def fill_delay_nulls(spark, sf):
    """B7."""
    return clean.fill_delay_nulls(fl(spark, sf)).select(*KEYS, "DepDelayMinutes", "ArrDelayMinutes")


_NUM = ["CRSDepTimeHour", "cause_slot", "DepDelay", "ArrDelay", "Distance", "TaxiOut", "TaxiIn",
        "DepDelayMinutes", "ArrDelayMinutes", "WeatherDelay", "CarrierDelay", "NASDelay",
        "SecurityDelay", "LateAircraftDelay"]


@q("fill_features", with_("flights") + f"SELECT {K}, "
   + ", ".join(f"COALESCE({c}, 0) AS {c}" for c in _NUM) + " FROM flights")
def fill_features(spark, sf):
    """Every numeric column null -> 0."""
    return clean.fill_features(fl(spark, sf)).select(*KEYS, *_NUM)


@q("date_parts", with_("trips") + f"SELECT {K}, DepDate, Year, Month, Day, DayOfWeek, Quarter FROM trips")
def date_parts(spark, sf):
    """B9 (weekday Monday=0)."""
    return B.date_parts(B.parse_date(fl(spark, sf))).select(*KEYS, "DepDate", "Year", "Month", "Day",
                                                            "DayOfWeek", "Quarter")


@q("season", with_("trips") + f"SELECT {K}, Month, Season FROM trips")
def season(spark, sf):
    """B10."""
    return trips(spark, sf).select(*KEYS, "Month", "Season")


@q("route", with_("trips") + f"SELECT {K}, Route FROM trips")
def route(spark, sf):
    """B11."""
    return trips(spark, sf).select(*KEYS, "Route")


@q("delay_severity", with_("flights") + f"SELECT {K}, DepDelayMinutes, {severity_case('DepDelayMinutes')} AS DelaySeverity FROM flights")
def delay_severity(spark, sf):
    """B12."""
    return B.add_delay_severity(fl(spark, sf)).select(*KEYS, "DepDelayMinutes", "DelaySeverity")


_BUCKET = ("CAST(CASE WHEN DepDelayMinutes IS NULL THEN 3 WHEN DepDelayMinutes <= 0 THEN 0 "
           "WHEN DepDelayMinutes <= 15 THEN 1 WHEN DepDelayMinutes <= 60 THEN 2 ELSE 3 END AS INTEGER)")


@q("delay_bucket", with_("flights") + f"SELECT {K}, DepDelayMinutes, {_BUCKET} AS DelayBucket FROM flights")
def delay_bucket(spark, sf):
    """B13 (null -> bucket 3)."""
    return B.add_delay_bucket(fl(spark, sf)).select(*KEYS, "DepDelayMinutes", "DelayBucket")


_ISDEL = "CAST(CASE WHEN DepDelayMinutes > 0 THEN 1 ELSE 0 END AS INTEGER)"


@q("is_delayed", with_("flights") + f"SELECT {K}, {_ISDEL} AS IsDelayed FROM flights")
def is_delayed(spark, sf):
    """B14."""
    return B.add_is_delayed(fl(spark, sf)).select(*KEYS, "IsDelayed")


_CAUSES = ["WeatherDelay", "CarrierDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay"]


@q("cause_flags", with_("flights") + f"SELECT {K}, "
   + ", ".join(f"CAST(CASE WHEN {c} > 0 THEN 1 ELSE 0 END AS INTEGER) AS {c}_Binary, {c} AS {c}_Minutes"
               for c in _CAUSES) + " FROM flights")
def cause_flags(spark, sf):
    """B15 with the minutes copies."""
    out = B.add_cause_flags(fl(spark, sf), minutes_copies=True)
    return out.select(*KEYS, *[x for c in _CAUSES for x in (f"{c}_Binary", f"{c}_Minutes")])


@q("time_flags", with_("trips") + f"""
SELECT {K}, CAST(CASE WHEN DayOfWeek >= 5 THEN 1 ELSE 0 END AS INTEGER) AS IsWeekend,
  CAST(CASE WHEN CRSDepTimeHour >= 18 THEN 1 ELSE 0 END AS INTEGER) AS IsEvening,
  CAST(CASE WHEN CRSDepTimeHour <= 10 THEN 1 ELSE 0 END AS INTEGER) AS IsMorning,
  CAST(CASE WHEN CRSDepTimeHour BETWEEN 7 AND 9 OR CRSDepTimeHour BETWEEN 17 AND 19 THEN 1 ELSE 0 END AS INTEGER) AS IsPeakHour
FROM trips""")
def time_flags(spark, sf):
    """B16."""
    return B.add_time_flags(trips(spark, sf)).select(*KEYS, "IsWeekend", "IsEvening", "IsMorning",
                                                     "IsPeakHour")


@q("hour_of_day", with_("flights") + f"SELECT {K}, CRSDepTimeHour AS HourOfDay FROM flights")
def hour_of_day(spark, sf):
    """B17."""
    return B.add_hour_of_day(fl(spark, sf)).select(*KEYS, "HourOfDay")


def _dist_case(labels=None):
    edges = C.DISTANCE_EDGES
    out = f"CASE WHEN Distance IS NULL OR Distance <= {edges[0]} THEN NULL "
    for i, hi in enumerate(edges[1:], start=1):
        v = f"'{labels[i - 1]}'" if labels else str(i)
        out += f"WHEN Distance <= {hi} THEN {v} "
    last = f"'{labels[-1]}'" if labels else str(len(edges))
    out += f"ELSE {last} END"
    return out if labels else f"CAST({out} AS INTEGER)"


@q("distance_group", with_("flights") + f"SELECT {K}, Distance, {_dist_case()} AS DistanceGroup, "
   f"{_dist_case(C.DISTANCE_LABELS)} AS DistanceLabel FROM flights")
def distance_group(spark, sf):
    """Right-closed bins as codes and labels."""
    df = B.add_distance_group(fl(spark, sf))
    df = B.add_distance_group(df, dst="DistanceLabel", labels=C.DISTANCE_LABELS)
    return df.select(*KEYS, "Distance", "DistanceGroup", "DistanceLabel")


@q("season_ordinal", with_("trips") + f"""
SELECT {K}, Season, CAST(CASE Season WHEN 'Spring' THEN 0 WHEN 'Summer' THEN 1 WHEN 'Fall' THEN 2
  WHEN 'Winter' THEN 3 END AS INTEGER) AS SeasonEncoded FROM trips""")
def season_ordinal(spark, sf):
    """B19."""
    return B.add_season_ordinal(trips(spark, sf)).select(*KEYS, "Season", "SeasonEncoded")


_ENC = ["Route", "OriginCity", "DestCity", "CarrierName", "Season"]


@q("label_encode", with_("trips") + f"SELECT {K}, "
   + ", ".join(f"CAST(dense_rank() OVER (ORDER BY COALESCE({c}, 'nan')) - 1 AS DOUBLE) AS {c}_Encoded"
               for c in _ENC) + " FROM trips")
def label_encode(spark, sf):
    """Alphabetical integer codes (StringIndexer, alphabetAsc)."""
    from delaylens.operators.ml import label_encode as enc
    return enc(trips(spark, sf), _ENC).select(*KEYS, *[f"{c}_Encoded" for c in _ENC])


def _names_case(col, names, base):
    return "CASE " + " ".join(f"WHEN {col} = {i + base} THEN '{n}'" for i, n in enumerate(names)) + " END"


@q("calendar_labels", with_("trips") + f"""
SELECT {K}, DayOfWeek, {_names_case('DayOfWeek', C.DAY_NAMES, 0)} AS DayName,
  Month, {_names_case('Month', C.MONTH_NAMES, 1)} AS MonthName,
  Quarter, {_names_case('Quarter', C.QUARTER_NAMES, 1)} AS QuarterName FROM trips""")
def calendar_labels(spark, sf):
    """B21."""
    return B.add_calendar_labels(trips(spark, sf)).select(
        *KEYS, "DayOfWeek", "DayName", "Month", "MonthName", "Quarter", "QuarterName")


@q("short_label", with_("trips") + f"""
SELECT {K}, Route, CASE WHEN length(Route) > 20 THEN substring(Route, 1, 20) || '...' ELSE Route END AS ShortLabel
FROM trips""")
def short_label(spark, sf):
    """B22."""
    return B.add_short_label(trips(spark, sf)).select(*KEYS, "Route", "ShortLabel")


def _period_case(col="Year", short=False):
    out = "CASE " + " ".join(
        f"WHEN {col} IN {tuple(ys)} THEN '{(n.split(' (')[0] if short else n)}'" for n, ys in P.PERIODS.items())
    return out + " END"


@q("period_label", with_("trips") + f"SELECT {K}, Year, {_period_case()} AS Period, "
   f"{_period_case(short=True)} AS PeriodShort FROM trips")
def period_label(spark, sf):
    """B23."""
    df = B.add_period(trips(spark, sf), P.PERIODS)
    df = B.add_period(df, P.PERIODS, dst="PeriodShort", short=True)
    return df.select(*KEYS, "Year", "Period", "PeriodShort")


@q("select_available", with_("trips") + """
SELECT CRSDepTimeHour, DayOfWeek, Month, Distance, CAST(dense_rank() OVER (ORDER BY COALESCE(Route, 'nan')) - 1 AS DOUBLE) AS Route_Encoded,
  CAST(dense_rank() OVER (ORDER BY COALESCE(Season, 'nan')) - 1 AS DOUBLE) AS Season_Encoded FROM trips""")
def select_available(spark, sf):
    """Wanted features that exist plus encoded columns."""
    from delaylens.operators.ml import label_encode as enc
    df = enc(trips(spark, sf), ["Route", "Season"])
    return G.select_available(df, ["CRSDepTimeHour", "DayOfWeek", "Month", "NotAColumn", "Distance"],
                              extra=["Route_Prior"])


# ---- C-family -------------------------------------------------------------

@q("filter_carrier", with_("flights") + f"SELECT * FROM flights WHERE Marketing_Airline_Network = '{P.CARRIER}'")
def filter_carrier(spark, sf):
    """C1."""
    return CF.filter_carrier(fl(spark, sf), P.CARRIER)


@q("exclude_years", with_("trips") + f"SELECT * FROM trips WHERE Year IS NULL OR Year NOT IN {P.EXCLUDE_YEARS}")
def exclude_years(spark, sf):
    """C2."""
    return CF.exclude_years(trips(spark, sf, without=P.EXCLUDE_YEARS), P.EXCLUDE_YEARS)


@q("period_filter", with_("trips") + f"SELECT {K}, Year, {_period_case()} AS Period FROM trips "
   f"WHERE Year IN {P.PRE_YEARS + P.GAP_YEARS + P.POST_YEARS}")
def period_filter(spark, sf):
    """One Period column instead of three scans."""
    df = B.add_period(trips(spark, sf, P.PRE_YEARS + P.GAP_YEARS + P.POST_YEARS), P.PERIODS)
    return df.where(F.col("Period").isNotNull()).select(*KEYS, "Year", "Period")


@q("min_support", with_("trips") + f"""
SELECT Route, CAST(count(DepDelayMinutes) AS BIGINT) AS Flight_Count FROM trips WHERE Route IS NOT NULL
GROUP BY Route HAVING count(DepDelayMinutes) >= {P.MIN_ROUTE_FLIGHTS}""")
def min_support(spark, sf):
    """C4."""
    stats = trips(spark, sf).where(F.col("Route").isNotNull()).groupBy("Route").agg(
        F.count("DepDelayMinutes").alias("Flight_Count"))
    return CF.min_support(stats, P.MIN_ROUTE_FLIGHTS)


@q("range_filter", with_("flights") + f"SELECT {K}, DepDelayMinutes FROM flights WHERE DepDelayMinutes BETWEEN 0 AND 120")
def range_filter(spark, sf):
    """C5."""
    return CF.range_filter(fl(spark, sf), "DepDelayMinutes", 0, 120).select(*KEYS, "DepDelayMinutes")


ROUTE_STATS_SQL = f"""SELECT Route, CAST(count(DepDelayMinutes) AS BIGINT) AS Flight_Count,
  avg(DepDelayMinutes) AS Avg_Delay, CAST(median(DepDelayMinutes) AS DOUBLE) AS Median_Delay,
  stddev_samp(DepDelayMinutes) AS Delay_Std, max(DepDelayMinutes) AS Max_Delay,
  CAST(count(DISTINCT DepDate) AS BIGINT) AS Days_Operated,
  avg(CASE WHEN DepDelayMinutes > 0 THEN 1.0 ELSE 0.0 END) * 100.0 AS Delay_Frequency,
  avg(CASE WHEN DepDelayMinutes > 60 THEN 1.0 ELSE 0.0 END) * 100.0 AS Major_Delay_Rate,
  avg(CASE WHEN DepDelayMinutes = 0 THEN 1.0 ELSE 0.0 END) * 100.0 AS On_Time_Rate
FROM trips WHERE Route IS NOT NULL GROUP BY Route HAVING count(DepDelayMinutes) >= {{min_flights}}"""


@q("high_risk_groups", with_("trips", extra={"rs": ROUTE_STATS_SQL.format(min_flights=P.MIN_ROUTE_FLIGHTS)}) + """
SELECT * FROM rs WHERE Avg_Delay > (SELECT quantile_cont(Avg_Delay, 0.8) FROM rs)
  AND Major_Delay_Rate > (SELECT quantile_cont(Major_Delay_Rate, 0.8) FROM rs)""")
def high_risk_groups(spark, sf):
    """C6."""
    return CF.high_risk_groups(R.route_stats(trips(spark, sf), min_flights=P.MIN_ROUTE_FLIGHTS), "Route")


@q("outliers_q99", with_("flights") + """
SELECT (SELECT quantile_cont(DepDelayMinutes, 0.99) FROM flights) AS Threshold,
  CAST(count(*) FILTER (WHERE DepDelayMinutes > (SELECT quantile_cont(DepDelayMinutes, 0.99) FROM flights)) AS BIGINT) AS Outliers
FROM flights""")
def outliers_q99(spark, sf):
    """C7."""
    return CF.outliers_above_quantile(fl(spark, sf), "DepDelayMinutes", 0.99)


@q("delayed_only", with_("flights") + f"SELECT {K}, DepDelayMinutes FROM flights WHERE DepDelayMinutes > 0")
def delayed_only(spark, sf):
    """C8."""
    return CF.delayed_only(fl(spark, sf)).select(*KEYS, "DepDelayMinutes")


@q("assert_years_absent", with_("trips") + f"""
SELECT Year, CAST(count(*) AS BIGINT) AS Rows FROM trips WHERE Year IN {P.EXCLUDE_YEARS} GROUP BY Year""")
def assert_years_absent(spark, sf):
    """The violation table on the unfiltered input (non-empty here);
    ``filters.assert_years_absent`` raises on it."""
    return CF.years_present(trips(spark, sf), P.EXCLUDE_YEARS)


@q("assert_disjoint_split", with_("trips") + f"""
SELECT DISTINCT Year FROM trips WHERE Year IN {P.TRAIN_YEARS}
INTERSECT SELECT DISTINCT Year FROM trips WHERE Year IN {P.TEST_YEARS}""")
def assert_disjoint_split(spark, sf):
    """Common years of the train and test splits (empty = disjoint)."""
    df = trips(spark, sf)
    return years_intersect(df.where(F.col("Year").isin(*P.TRAIN_YEARS)),
                           df.where(F.col("Year").isin(*P.TEST_YEARS)))
