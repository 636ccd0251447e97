"""SQL texts of the shared inputs for the DuckDB oracle (driver tables
are pre-registered views). Each oracle query is ``with_(...) + SELECT``."""

from __future__ import annotations

from delaylens.functions.columns import AIRLINE_NAMES, UNKNOWN_AIRLINE
from delaylens.plans import params as P
from delaylens.sources.flights import CARRIER_CODES

_codes = " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(CARRIER_CODES[:-1]))

FLIGHTS = f"""SELECT b.*,
       CASE WHEN DepDelay IS NULL THEN NULL WHEN DepDelay < 0 THEN CAST(0 AS DOUBLE) ELSE DepDelay END AS DepDelayMinutes,
       CASE WHEN ArrDelay IS NULL THEN NULL WHEN ArrDelay < 0 THEN CAST(0 AS DOUBLE) ELSE ArrDelay END AS ArrDelayMinutes,
       CASE WHEN DepDelay >= 15 THEN CASE WHEN cause_slot = 0 THEN DepDelay ELSE CAST(0 AS DOUBLE) END END AS WeatherDelay,
       CASE WHEN DepDelay >= 15 THEN CASE WHEN cause_slot = 1 THEN DepDelay ELSE CAST(0 AS DOUBLE) END END AS CarrierDelay,
       CASE WHEN DepDelay >= 15 THEN CASE WHEN cause_slot = 2 THEN DepDelay ELSE CAST(0 AS DOUBLE) END END AS NASDelay,
       CASE WHEN DepDelay >= 15 THEN CASE WHEN cause_slot = 3 THEN DepDelay ELSE CAST(0 AS DOUBLE) END END AS SecurityDelay,
       CASE WHEN DepDelay >= 15 THEN CASE WHEN cause_slot = 4 THEN DepDelay ELSE CAST(0 AS DOUBLE) END END AS LateAircraftDelay
FROM (
  SELECT CAST(l_shipdate AS DATE) AS FlightDate,
         CASE CAST(l_suppkey % 12 AS INT) {_codes} ELSE '{CARRIER_CODES[-1]}' END AS Marketing_Airline_Network,
         sn.n_name || ', ' || sr.r_name AS OriginCityName,
         cn.n_name || ', ' || cr.r_name AS DestCityName,
         CAST(l_partkey % 24 AS INT) AS CRSDepTimeHour,
         CAST(l_suppkey % 5 AS INT) AS cause_slot,
         CASE WHEN l_partkey % 50 = 0 THEN NULL
              ELSE CAST(FLOOR(l_quantity * l_quantity / 20) AS DOUBLE) - 20 END AS DepDelay,
         CASE WHEN l_partkey % 50 = 0 THEN NULL
              ELSE CAST(FLOOR(l_quantity * l_quantity / 20) AS DOUBLE) - 25 + l_linenumber END AS ArrDelay,
         CAST(FLOOR(l_extendedprice / 40) AS DOUBLE) AS Distance,
         l_quantity AS TaxiOut,
         CAST(l_linenumber AS DOUBLE) AS TaxiIn,
         l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation sn ON s_nationkey = sn.n_nationkey JOIN region sr ON sn.n_regionkey = sr.r_regionkey
  JOIN nation cn ON c_nationkey = cn.n_nationkey JOIN region cr ON cn.n_regionkey = cr.r_regionkey
) b"""

CARRIER_CASE = ("COALESCE(CASE Marketing_Airline_Network "
                + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in AIRLINE_NAMES.items())
                + f" END, '{UNKNOWN_AIRLINE}')")


def season_case(m: str) -> str:
    return (f"CASE WHEN {m} IN (12, 1, 2) THEN 'Winter' WHEN {m} IN (3, 4, 5) THEN 'Spring' "
            f"WHEN {m} IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END")


def severity_case(d: str) -> str:
    return (f"CASE WHEN {d} IS NULL OR {d} <= 0 THEN 'On Time' WHEN {d} <= 15 THEN 'Minor Delay' "
            f"WHEN {d} <= 60 THEN 'Moderate Delay' ELSE 'Major Delay' END")


TRIPS = f"""SELECT * EXCLUDE (FlightDate, OriginCityName, DestCityName),
  FlightDate AS DepDate,
  string_split(OriginCityName, ', ')[1] AS OriginCity,
  string_split(OriginCityName, ', ')[2] AS OriginState,
  string_split(DestCityName, ', ')[1] AS DestCity,
  string_split(DestCityName, ', ')[2] AS DestState,
  {CARRIER_CASE} AS CarrierName,
  CAST(year(FlightDate) AS INTEGER) AS Year, CAST(month(FlightDate) AS INTEGER) AS Month,
  CAST(day(FlightDate) AS INTEGER) AS Day, CAST(isodow(FlightDate) - 1 AS INTEGER) AS DayOfWeek,
  CAST(quarter(FlightDate) AS INTEGER) AS Quarter,
  {season_case('month(FlightDate)')} AS Season,
  string_split(OriginCityName, ', ')[1] || ' → ' || string_split(DestCityName, ', ')[1] AS Route,
  {severity_case('DepDelayMinutes')} AS DelaySeverity
FROM flights"""

RAW = """SELECT *,
  CAST(year(FlightDate) AS INTEGER) AS Year, CAST(month(FlightDate) AS INTEGER) AS Month,
  CAST(day(FlightDate) AS INTEGER) AS DayofMonth, CAST(isodow(FlightDate) AS INTEGER) AS DayofWeek_raw,
  printf('%02d:00', CRSDepTimeHour) AS CRSDepTimeHourDis,
  CAST((CRSDepTimeHour + 1) % 24 AS INTEGER) AS WheelsOffHour,
  printf('%02d:00', (CRSDepTimeHour + 1) % 24) AS WheelsOffHourDis,
  CAST((CRSDepTimeHour + 3) % 24 AS INTEGER) AS CRSArrTimeHour,
  printf('%02d:00', (CRSDepTimeHour + 3) % 24) AS CRSArrTimeHourDis,
  CAST((CRSDepTimeHour + 3) % 24 AS INTEGER) AS WheelsOnHour,
  printf('%02d:00', (CRSDepTimeHour + 3) % 24) AS WheelsOnHourDis
FROM flights"""

_HOUR_DIS = "CRSDepTimeHourDis, WheelsOffHourDis, CRSArrTimeHourDis, WheelsOnHourDis"
#: raw rows after the row-wise cleaning, raw calendar parts dropped
SHAPED = f"""SELECT * EXCLUDE (Year, Month, DayofMonth, FlightDate, OriginCityName, DestCityName),
  FlightDate AS DepDate,
  string_split(OriginCityName, ', ')[1] AS OriginCity, string_split(OriginCityName, ', ')[2] AS OriginState,
  string_split(DestCityName, ', ')[1] AS DestCity, string_split(DestCityName, ', ')[2] AS DestState,
  {CARRIER_CASE} AS CarrierName FROM raw"""
DERIVED = f"""CAST(year(DepDate) AS INTEGER) AS Year, CAST(month(DepDate) AS INTEGER) AS Month,
  CAST(day(DepDate) AS INTEGER) AS Day, CAST(isodow(DepDate) - 1 AS INTEGER) AS DayOfWeek,
  CAST(quarter(DepDate) AS INTEGER) AS Quarter, {season_case('month(DepDate)')} AS Season,
  OriginCity || ' → ' || DestCity AS Route, {severity_case('DepDelayMinutes')} AS DelaySeverity"""
#: the cleaned table that every model run starts from
CLEANED = f"""SELECT * FROM (SELECT *, {DERIVED} FROM (SELECT DISTINCT * EXCLUDE (DepDelay, ArrDelay, {_HOUR_DIS}) FROM shaped))
WHERE Year IS NULL OR Year NOT IN {P.EXCLUDE_YEARS}"""

CTES = {"shaped": SHAPED, "cleaned": CLEANED, "flights": FLIGHTS, "trips": TRIPS, "raw": RAW}
DEPENDS = {"shaped": ["raw"], "cleaned": ["shaped"], "flights": [], "trips": ["flights"], "raw": ["flights"]}


def with_(*names: str, extra: dict[str, str] | None = None) -> str:
    """WITH clause holding the named base inputs (and their
    dependencies) followed by ``extra`` CTEs in order."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in DEPENDS[n]:
            add(d)
        if n not in order:
            order.append(n)
    for n in names:
        add(n)
    parts = [f"{n} AS ({CTES[n]})" for n in order]
    parts += [f"{k} AS ({v})" for k, v in (extra or {}).items()]
    return "WITH " + ",\n".join(parts) + "\n"
