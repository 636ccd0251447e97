"""P-family queries: the user-level entry points."""

from __future__ import annotations

from pyspark.sql import functions as F

from delaylens.operators import ml as ML, reports as R
from delaylens.operators.tables import one_table
from delaylens.plans import modeling as MD
from delaylens.plans.analysis import TABLE_KEYS, delay_analysis as _delay, impact_analysis as _impact
from delaylens.plans.oracle_base import CARRIER_CASE, DERIVED, with_
from delaylens.plans import params as P
from delaylens.plans.inputs import KEYS, trips
from delaylens.plans.preprocess import preprocess_complete as _complete, preprocess_staged as _staged, write_handover
from delaylens.session import scratch_path
from delaylens.plans.q_ml import code_sql
from delaylens.plans.q_reports import _top_sql, group_sql
from delaylens.plans.registry import ORACLES, q
from delaylens.plans.q_stats import ADVICE_SQL, SERIES_SQL
from delaylens.sources.flights import raw_flights

HOUR_DIS = "CRSDepTimeHourDis, WheelsOffHourDis, CRSArrTimeHourDis, WheelsOnHourDis"
SPLIT = f"""FlightDate AS DepDate,
  string_split(OriginCityName, ', ')[1] AS OriginCity, string_split(OriginCityName, ', ')[2] AS OriginState,
  string_split(DestCityName, ', ')[1] AS DestCity, string_split(DestCityName, ', ')[2] AS DestState,
  {CARRIER_CASE} AS CarrierName"""
KEEP = f"WHERE Year IS NULL OR Year NOT IN {P.EXCLUDE_YEARS}"


@q("preprocess_complete", with_("raw", extra={
    "b": f"SELECT * EXCLUDE (DepDelay, ArrDelay, {HOUR_DIS}, Year, Month, DayofMonth, FlightDate, OriginCityName, DestCityName), {SPLIT} FROM raw",
    "d": "SELECT DISTINCT * FROM b",
    "g": f"SELECT *, {DERIVED} FROM d"}) + f"SELECT * FROM g {KEEP}")
def preprocess_complete(spark, sf):
    """The cleaned table (redundancy pass first, nulls kept), written
    as the Year-partitioned hand-over and read back."""
    return write_handover(_complete(raw_flights(spark, sf))[0], scratch_path(spark, "cleaned-complete"))


@q("preprocess_staged", with_("raw", extra={
    "b": f"SELECT * EXCLUDE (Year, Month, DayofMonth, FlightDate, OriginCityName, DestCityName), {SPLIT} FROM raw",
    "d": "SELECT DISTINCT * FROM b",
    "f": "SELECT * REPLACE (COALESCE(DepDelayMinutes, 0) AS DepDelayMinutes, COALESCE(ArrDelayMinutes, 0) AS ArrDelayMinutes) FROM d",
    "g": f"SELECT *, {DERIVED} FROM f"}) +
   f"SELECT * EXCLUDE (DepDelay, ArrDelay, DayofWeek_raw, Marketing_Airline_Network, {HOUR_DIS}) FROM g {KEEP}")
def preprocess_staged(spark, sf):
    """The staged variant (nulls filled, redundancy pass last), written
    and read back like P1."""
    return write_handover(_staged(raw_flights(spark, sf))[0], scratch_path(spark, "cleaned-staged"))


@q("impact_analysis", with_("trips", extra=ADVICE_SQL) +
   f"SELECT * FROM trips WHERE Year IS NULL OR Year NOT IN {P.EXCLUDE_YEARS} OR NOT (SELECT evidence = 'strong' FROM adv)")
def impact_analysis(spark, sf):
    """The recommended table after the exclusion advice (gap years
    are dropped only on strong evidence)."""
    return _impact(trips(spark, sf))["recommended"]


@q("delay_analysis")
def delay_analysis(spark, sf):
    """P4 (rows-only): the insights table of the analysis over the cleaned table."""
    cleaned = write_handover(_complete(raw_flights(spark, sf))[0], scratch_path(spark, "analysis-input"))
    return _delay(spark, cleaned)["insights"]


def _mean_by(key: str, name: str, more: str = "") -> str:
    return (f"LEFT JOIN (SELECT {key}, avg(DepDelayMinutes) AS {name}{more} FROM cleaned WHERE {key} IS NOT NULL GROUP BY {key}) "
            f"g_{key} USING ({key})")


# every feature of P5 over the cleaned table, in the order of the vector
ML_FEATURES = {
    "HourOfDay": "CRSDepTimeHour", **{c: c for c in ["DayOfWeek", "Month", "Quarter"]},
    "SeasonEncoded": "CASE Season WHEN 'Spring' THEN 0 WHEN 'Summer' THEN 1 WHEN 'Fall' THEN 2 WHEN 'Winter' THEN 3 END",
    **{c: c for c in ["RouteFrequency", "RouteAvgDelay", "OriginAvgDelay", "DestAvgDelay", "Distance", "TaxiOut", "TaxiIn"]},
    **{f"{c}_Binary": f"CASE WHEN {c} > 0 THEN 1 ELSE 0 END"
       for c in ["WeatherDelay", "CarrierDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay"]},
    **{f"{c}_Encoded": code_sql(c) for c in ["Route", *MD.ENCODED, "CarrierName"]}}
ML_SQL = with_("cleaned", extra={
    "f": "SELECT " + ", ".join(KEYS) + ", Year, DepDelayMinutes, " + ", ".join(
        f"COALESCE(CAST({c} AS DOUBLE), 0) AS {n}" for n, c in ML_FEATURES.items()) + " FROM cleaned "
        + _mean_by("Route", "RouteAvgDelay", ", count(*) AS RouteFrequency") + " " + _mean_by("OriginCity", "OriginAvgDelay")
        + " " + _mean_by("DestCity", "DestAvgDelay"),
    "s": "SELECT " + ", ".join(f"avg({n}) AS m_{n}, stddev_samp({n}) AS d_{n}" for n in ML_FEATURES)
         + f" FROM f WHERE Year IN {P.TRAIN_YEARS}"}) + (
    "SELECT " + ", ".join(KEYS) + f", CASE WHEN Year IN {P.TRAIN_YEARS} THEN 'train' ELSE 'test' END AS split, DepDelayMinutes, "
    + ", ".join(f"round(CASE WHEN d_{n} > 0 THEN ({n} - m_{n}) / d_{n} ELSE 0 END, 6) + 0.0e0 AS scaled_{n}" for n in ML_FEATURES)
    + f" FROM f, s WHERE Year IN {P.TRAIN_YEARS + P.TEST_YEARS}")


@q("ml_features", ML_SQL)
def ml_features(spark, sf):
    """P5: the scaled feature matrix, one column to each feature, to six places."""
    from pyspark.ml.functions import vector_to_array
    out = MD.ml_features(spark, sf)
    m = out["matrix"].withColumn("x", vector_to_array("scaled"))
    return m.select(*KEYS, "split", "DepDelayMinutes", *[
        (F.round(F.col("x")[k], 6) + F.lit(0.0)).alias(f"scaled_{n}") for k, n in enumerate(out["feature_names"])])


@q("consumer_model_run")
def consumer_model_run(spark, sf):
    """P6 (rows-only): run summary."""
    return MD.consumer_run(spark, sf)["run_summary"]


@q("realistic_model_run")
def realistic_model_run(spark, sf):
    """P7 (rows-only): run summary."""
    return MD.realistic_run(spark, sf)["run_summary"]


@q("operational_model_run")
def operational_model_run(spark, sf):
    """P8 (rows-only): run summary (the rolling folds run inside)."""
    out = MD.operational_run(spark, sf)
    return out["run_summary"]


@q("regressor_comparison")
def regressor_comparison(spark, sf):
    """P9 (rows-only): regressor metrics."""
    return MD.regressor_comparison(spark, sf)["metrics"]


@q("model_testing")
def model_testing(spark, sf):
    """P10 (rows-only): two-stage regression metrics on the test years."""
    return MD.model_testing(spark, sf)["regression"]


@q("run_mode")
def run_mode(spark, sf):
    """P11 (rows-only): dispatch by name ('consumer')."""
    return MD.run_mode(spark, sf, "consumer")["run_summary"]


# ---- tables of P8 and P10 that need no model, over the cleaned table --------

_CLEANED = with_("raw", extra={
    "b": f"SELECT * EXCLUDE (DepDelay, ArrDelay, {HOUR_DIS}, Year, Month, DayofMonth, FlightDate, OriginCityName, DestCityName), {SPLIT} FROM raw",
    "d": "SELECT DISTINCT * FROM b",
    "g": f"SELECT *, {DERIVED} FROM d",
    "trips": f"SELECT * FROM g {KEEP}"}).rstrip()
_TEST = f"Year IN {P.TEST_YEARS}"


def _over_cleaned(sql: str, base: str) -> str:
    """The report's SQL with the cleaned table in place of its own input."""
    body = sql.removeprefix(with_(base)) if sql.startswith(with_(base)) else sql.split(with_(base).rstrip(), 1)[1]
    return _CLEANED + ("\n" if not body.startswith(",") else "") + body.replace("FROM flights", "FROM trips")


def _hours(where: str = "", src: str = "trips") -> str:
    return group_sql("CRSDepTimeHour", src, where=where)


@q("operational_causes", _over_cleaned(ORACLES["cause_report"], "flights"))
def operational_causes(spark, sf):
    """The cause report over all cleaned rows."""
    return MD.operational_tables(MD.cleaned_table(spark, sf))["cause_report"]


@q("operational_taxi_distance", _over_cleaned(ORACLES["operational_means"], "flights"))
def operational_taxi_distance(spark, sf):
    """Taxi, distance and delay means over all cleaned rows."""
    return MD.operational_tables(MD.cleaned_table(spark, sf))["operational_means"]


@q("operational_worst_hours", _CLEANED + f", h AS ({_hours()})\n" + _top_sql("h", "Avg_Delay", 3, "CRSDepTimeHour"))
def operational_worst_hours(spark, sf):
    """The three worst hours over all cleaned rows."""
    return MD.operational_tables(MD.cleaned_table(spark, sf))["worst_hours"]


@q("operational_problem_routes", _CLEANED + f""", p AS (SELECT Route, CAST(count(DepDelayMinutes) AS BIGINT) AS Flight_Count, avg(DepDelayMinutes) AS Avg_Delay
FROM trips WHERE Route IS NOT NULL GROUP BY Route HAVING count(DepDelayMinutes) >= {P.MIN_ROUTE_FLIGHTS})
""" + _top_sql("p", "Avg_Delay", 5, "Route"))
def operational_problem_routes(spark, sf):
    """The five worst routes over all cleaned rows."""
    return MD.operational_tables(MD.cleaned_table(spark, sf))["problem_routes"]


@q("operational_top_routes", _over_cleaned(ORACLES["top_routes"], "trips"))
def operational_top_routes(spark, sf):
    """The top routes over all cleaned rows."""
    return MD.operational_tables(MD.cleaned_table(spark, sf))["top_routes"]


@q("testing_hourly", _CLEANED + "\n" + _hours(f"AND {_TEST}"))
def testing_hourly(spark, sf):
    """P10: hourly delays of the test years."""
    return R.hourly_delays(MD.cleaned_table(spark, sf).where(F.col("Year").isin(*P.TEST_YEARS)))


# ---- all tables of P4 and P10 that need no model, as one ---------------------

def _body(name: str, base: str = "trips") -> str:
    """A report's SQL without its shared inputs, to stand inside another WITH."""
    rest = ORACLES[name].split(with_(base).rstrip(), 1)[1].strip()
    return "WITH " + rest[1:] if rest.startswith(",") else rest


def _one_table_sql(tables: dict) -> str:
    """``tables``: name -> (key columns, numeric columns, text columns)."""
    rows = []
    for name, (keys, numbers, texts) in tables.items():
        key = " || '|' || ".join(f"COALESCE(CAST({k} AS VARCHAR), '-')" for k in keys)
        for m in [*numbers, *texts]:
            value = (f"CAST({m} AS DOUBLE)", "CAST(NULL AS VARCHAR)") if m in numbers else ("CAST(NULL AS DOUBLE)", f"CAST({m} AS VARCHAR)")
            rows.append(f"SELECT '{name}' AS name, {key} AS key, '{m}' AS metric, {value[0]} AS value, {value[1]} AS text FROM t_{name}")
    return "\nUNION ALL ".join(rows)


_G = ["Flight_Count", "Avg_Delay", "Median_Delay"]
_ROUTE = [*_G, "Delay_Std", "Max_Delay", "Days_Operated", "Delay_Frequency", "Major_Delay_Rate", "On_Time_Rate"]
_FILLED = "WITH " + ", ".join(f"{k} AS ({v})" for k, v in SERIES_SQL.items()) + f""",
g AS (SELECT count(y) FILTER (WHERE d BETWEEN DATE '{P.GAP_YEARS[0]}-01-01' AND DATE '{P.GAP_YEARS[-1]}-12-31') = 0 AS empty FROM s)
SELECT interp.d, interp.y, interp.i, (y IS NULL AND y_filled IS NOT NULL) AS is_filled, CASE WHEN empty THEN 'linear' ELSE 'ffill' END AS method,
  CASE WHEN empty THEN y_filled ELSE last_value(y IGNORE NULLS) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS y_filled
FROM interp, g"""
_P4 = {n: _body(n) for n in ["route_stats", "top_routes", "hourly_delays", "worst_hours", "weekday_delays", "season_delays", "airport_delays",
                             "monthly_delays", "quarterly_delays", "yearly_delays"]}
_P4["worst_airports"] = _top_sql("t_airport_delays", "Avg_Delay", 10, "OriginCity")
_P4["daily_series"] = "WITH " + ", ".join(f"{k} AS ({v})" for k, v in SERIES_SQL.items()) + " SELECT d, y FROM s"
_P4["filled_series"] = _FILLED
_P4_COLUMNS = {n: (keys, {"route_stats": _ROUTE, "top_routes": _ROUTE, "monthly_delays": [*_G, "Delay_Std"], "daily_series": ["y"],
                          "filled_series": ["y", "i", "y_filled"]}.get(n, _G),
                   {"weekday_delays": ["DayName"], "monthly_delays": ["MonthName"], "quarterly_delays": ["QuarterName"],
                    "filled_series": ["is_filled", "method"]}.get(n, [])) for n, keys in TABLE_KEYS.items()}


@q("delay_analysis_tables", _CLEANED + "".join(f",\nt_{n} AS ({sql})" for n, sql in _P4.items()) + "\n" + _one_table_sql(_P4_COLUMNS))
def delay_analysis_tables(spark, sf):
    """Its thirteen tables without a decomposition, over the cleaned table, as one."""
    out = _delay(spark, MD.cleaned_table(spark, sf))
    return one_table({n: (out[n], keys) for n, keys in TABLE_KEYS.items()})


_SPLIT_YEARS = f"Year IN {P.TRAIN_YEARS + P.TEST_YEARS}"
_P10 = {"hourly": _hours(f"AND {_TEST}"),
        "weekday": _body("weekday_delays").replace("WHERE DayOfWeek IS NOT NULL", f"WHERE DayOfWeek IS NOT NULL AND {_TEST}"),
        "causes": _body("cause_report", "flights").replace("FROM flights", f"FROM trips WHERE {_SPLIT_YEARS}"),
        "problem_routes": _body("problem_routes").replace("WHERE Route IS NOT NULL", f"WHERE Route IS NOT NULL AND {_SPLIT_YEARS}")}
_P10_COLUMNS = {"hourly": (["CRSDepTimeHour"], _G, []), "weekday": (["DayOfWeek"], _G, ["DayName"]),
                "causes": (["Cause"], ["Avg_Minutes", "Pct_Flights_Affected", "Total_Minutes", "Pct_Of_Delay_Minutes"], ["Action"]),
                "problem_routes": (["Route"], ["Flight_Count", "Avg_Delay"], [])}


@q("model_testing_tables", _CLEANED + "".join(f",\nt_{n} AS ({sql})" for n, sql in _P10.items()) + "\n" + _one_table_sql(_P10_COLUMNS))
def model_testing_tables(spark, sf):
    """P10: its four tables that need no model, over the rows of the time split, as one."""
    out = MD.testing_tables(ML.time_split(MD.model_frame(spark, sf), P.TRAIN_YEARS, P.TEST_YEARS))
    return one_table({n: (out[n], keys) for n, (keys, _, _) in _P10_COLUMNS.items()})
