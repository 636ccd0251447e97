"""A-family queries: scans, samples, sinks and previews."""

from __future__ import annotations

from pyspark.sql import functions as F

from delaylens.operators import reports as R
from delaylens.operators.filters import filter_carrier
from delaylens.operators.topk import preview
from delaylens.plans import params as P
from delaylens.plans.inputs import KEYS, fl, trips
from delaylens.plans.oracle_base import DERIVED, with_
from delaylens.plans.registry import q
from delaylens.session import scratch_path
from delaylens.sources import files
from delaylens.sources.flights import raw_flights
from delaylens.streaming.incremental import incremental_load

FLIGHT_COLS = ["FlightDate", "Marketing_Airline_Network", "OriginCityName", "DestCityName",
               "CRSDepTimeHour", "cause_slot", "DepDelay", "ArrDelay", "Distance", "TaxiOut",
               "TaxiIn", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "DepDelayMinutes",
               "ArrDelayMinutes", "WeatherDelay", "CarrierDelay", "NASDelay", "SecurityDelay",
               "LateAircraftDelay"]


@q("scan_parquet", with_("flights") + "SELECT * FROM flights")
def scan_parquet(spark, sf):
    """A1: the parquet tables read and shaped into trip records."""
    return fl(spark, sf)


@q("scan_csv", with_("flights") + "SELECT * FROM flights")
def scan_csv(spark, sf):
    """A2: trip records handed over as CSV and read back with a fixed schema."""
    df = fl(spark, sf)
    path = files.sink_csv(df, scratch_path(spark, "flights-csv"))
    return files.scan_csv(spark, path, df.schema)


@q("scan_csv_chunked", with_("flights") + "SELECT * FROM flights")
def scan_csv_chunked(spark, sf):
    """A3: two CSV parts (before/after the gap start) read and unioned."""
    df = fl(spark, sf)
    y = F.year("FlightDate")
    a = files.sink_csv(df.where(y < P.GAP_YEARS[0]), scratch_path(spark, "chunk-a"))
    b = files.sink_csv(df.where((y >= P.GAP_YEARS[0]) | y.isNull()), scratch_path(spark, "chunk-b"))
    return files.scan_csv_chunked(spark, [a, b], df.schema)


@q("incremental_csv_load", with_("shaped") + f"SELECT *, {DERIVED} FROM shaped")
def incremental_csv_load(spark, sf):
    """A3 as a file stream: the CSV parts before the gap are loaded, then those that
    arrive later; the second load resumes from the first one's checkpoint and reads
    the new files only. Rows are cleaned on the way and land in a table by Year."""
    df = raw_flights(spark, sf)
    y, source, out = F.year("FlightDate"), scratch_path(spark, "arrivals"), scratch_path(spark, "loaded")
    progress = scratch_path(spark, "load-progress")
    early = y < P.GAP_YEARS[0]
    for name, part in (("early", early), ("late", F.coalesce(~early, F.lit(True)))):
        files.sink_csv(df.where(part), f"{source}/{name}")
        incremental_load(spark, source + "/*", df.schema, out, max_files_per_trigger=64, checkpoint=progress)
    return spark.read.parquet(out).withColumn("Year", F.col("Year").cast("int"))


@q("sample_rows", with_("flights") + f"""
SELECT * FROM flights WHERE CAST('0x' || substr(md5('{P.SEED}' || '|' || {" || '|' || ".join(f"coalesce(CAST({k} AS VARCHAR), 'null')" for k in KEYS)}), 1, 12) AS BIGINT)
  / 281474976710656.0e0 < 0.1e0""")
def sample_rows(spark, sf):
    """A4: deterministic ~10 % sample by a hash of the keys."""
    return files.sample_rows(fl(spark, sf), 100, seed=P.SEED, cols=KEYS)


@q("sink_csv", with_("trips") + "SELECT * FROM trips")
def sink_csv(spark, sf):
    """A5: the enriched table written as CSV partitioned by Year, read back."""
    df = trips(spark, sf)
    path = files.sink_csv(df, scratch_path(spark, "trips-csv"), partition_by=["Year"])
    back = files.scan_csv(spark, path, df.drop("Year").schema)
    return back.withColumn("Year", F.col("Year").cast("int"))


@q("sink_if_changed", with_("trips") + f"""
SELECT CAST(count(*) AS BIGINT) AS Input_Rows,
       CAST(count(*) FILTER (WHERE Year IS NULL OR Year NOT IN {P.EXCLUDE_YEARS}) AS BIGINT) AS Subset_Rows,
       count(*) <> count(*) FILTER (WHERE Year IS NULL OR Year NOT IN {P.EXCLUDE_YEARS}) AS Written
FROM trips""")
def sink_if_changed(spark, sf):
    """The gap-free subset is written only when it removes rows."""
    from delaylens.operators.filters import exclude_years
    df = trips(spark, sf)
    return files.sink_if_changed(spark, df, exclude_years(df, P.EXCLUDE_YEARS),
                                 scratch_path(spark, "recommended"))


def _order_all(cols):
    return ", ".join(f"{c} ASC NULLS FIRST" for c in cols)


@q("preview", with_("flights") + f"SELECT * FROM flights ORDER BY {_order_all(FLIGHT_COLS)} LIMIT 100")
def preview_q(spark, sf):
    """First 100 rows in a total order."""
    return preview(fl(spark, sf), 100, FLIGHT_COLS)


@q("parquet_to_csv_carrier", with_("flights") + f"""
SELECT CAST(count(*) AS BIGINT) AS Rows_Kept, min(FlightDate) AS Min_Date, max(FlightDate) AS Max_Date,
  CAST(count(DISTINCT OriginCityName) AS BIGINT) AS Distinct_Origins,
  CAST(count(DISTINCT DestCityName) AS BIGINT) AS Distinct_Destinations,
  avg(DepDelay) AS Avg_Dep_Delay, max(DepDelay) AS Max_Dep_Delay,
  CAST(count(*) FILTER (WHERE DepDelay > 0) AS BIGINT) AS Dep_Delayed_Count,
  avg(ArrDelay) AS Avg_Arr_Delay, max(ArrDelay) AS Max_Arr_Delay,
  CAST(count(*) FILTER (WHERE ArrDelay > 0) AS BIGINT) AS Arr_Delayed_Count,
  (SELECT CAST(count(*) AS BIGINT) FROM flights) AS Total_Rows,
  count(*) * 100.0 / (SELECT count(*) FROM flights) AS Pct_Of_Total
FROM flights WHERE Marketing_Airline_Network = '{P.CARRIER}'""")
def parquet_to_csv_carrier(spark, sf):
    """A8 (+C1, A5, D6): one carrier's rows to CSV; the summary is computed
    on the written files."""
    df = fl(spark, sf)
    kept = filter_carrier(df, P.CARRIER)
    path = files.sink_csv(kept, scratch_path(spark, "carrier-csv"))
    back = files.scan_csv(spark, path, df.schema)
    total = df.agg(F.count(F.lit(1)).alias("Total_Rows"))
    return R.carrier_summary(back, total)
