"""Trip records derived from the driver's star-schema tables.

``flights`` is the common input of every query: one row per lineitem,
with an origin place from the supplier's nation/region and a destination
place from the customer's. ``raw_flights`` adds the raw calendar and
display columns a trip-record export carries, so the cleaning operators
have their redundant twins to drop.

Join plan: the 25-row nation x region table is broadcast (fixed size by
construction). customer and supplier grow with the data, so they are
joined without a hint: AQE turns those joins into broadcasts only when
the runtime size is under ``spark.sql.autoBroadcastJoinThreshold``,
otherwise they stay shuffle joins, with skew splitting on. orders is
joined to customer first (both keyed by custkey) so the big lineitem
side is shuffled once on orderkey and once on suppkey, carrying only
integer nation keys; place names are attached after the shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylens.session import spread_shuffles
from delaylens.sources.tables import read_table, table_bytes

# Carrier codes assigned by ``l_suppkey % 12`` (index order).
# 'ZZ' is deliberately unmapped so the unknown-carrier branch is exercised.
CARRIER_CODES = ["AA", "DL", "UA", "B6", "NK", "F9", "AS", "HA", "VX", "G4", "ZZ", "WN"]
CAUSE_COLUMNS = ["WeatherDelay", "CarrierDelay", "NASDelay", "SecurityDelay",
                 "LateAircraftDelay"]


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (nation.join(region, nation.n_regionkey == region.r_regionkey)
            .select("n_nationkey", F.concat("n_name", F.lit(", "), "r_name").alias("place")))


def _nonneg(c: Column) -> Column:
    return F.when(c.isNull(), F.lit(None).cast("double")).when(c < 0, F.lit(0.0)).otherwise(c)


def shipped_in(years: Sequence[int] = (), without: Sequence[int] = ()) -> Column | None:
    """A condition on ``l_shipdate`` for a set of years as ranges of time, which
    reach the file statistics; ``without`` leaves years out and keeps nulls."""
    def spans(ys):
        ys, out = sorted(set(ys)), []
        for y in ys:
            if out and out[-1][1] == y:
                out[-1][1] = y + 1
            else:
                out.append([y, y + 1])
        return [(F.lit(datetime(a, 1, 1)), F.lit(datetime(b, 1, 1))) for a, b in out]

    at = F.col("l_shipdate")
    cond = None
    if years:
        cond = reduce(lambda p, q: p | q, [(at >= a) & (at < b) for a, b in spans(years)])
    for a, b in spans(without):
        outside = at.isNull() | (at < a) | (at >= b)
        cond = outside if cond is None else cond & outside
    return cond


def flights(spark: SparkSession, sf_dir: str, shipped: Column | None = None) -> DataFrame:
    spread_shuffles(spark, table_bytes(spark, sf_dir, "lineitem") + table_bytes(spark, sf_dir, "orders"))
    places = _places(spark, sf_dir)
    supp = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = (read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
              .join(cust, F.col("o_custkey") == F.col("c_custkey"))
              .select("o_orderkey", "c_nationkey"))
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_shipdate")
    if shipped is not None:
        li = li.where(shipped)
    # the big shuffles carry 4-byte nation keys; the place names are
    # attached last from the 25-row table
    j = (li.join(orders, li.l_orderkey == orders.o_orderkey)
         .join(supp, li.l_suppkey == supp.s_suppkey))
    origin = places.select(F.col("n_nationkey").alias("__on"), F.col("place").alias("OriginCityName"))
    dest = places.select(F.col("n_nationkey").alias("__dn"), F.col("place").alias("DestCityName"))
    j = (j.join(origin, F.col("s_nationkey") == F.col("__on"))
         .join(dest, F.col("c_nationkey") == F.col("__dn")))

    q = F.col("l_quantity")
    null_delay = (F.col("l_partkey") % 50) == 0
    base_delay = F.floor(q * q / 20).cast("double")
    dep = F.when(null_delay, F.lit(None).cast("double")).otherwise(base_delay - 20)
    arr = F.when(null_delay, F.lit(None).cast("double")).otherwise(
        base_delay - 25 + F.col("l_linenumber"))
    b = j.select(
        F.col("l_shipdate").cast("date").alias("FlightDate"),
        F.element_at(F.array(*[F.lit(c) for c in CARRIER_CODES]),
                     (F.col("l_suppkey") % 12).cast("int") + 1).alias("Marketing_Airline_Network"),
        "OriginCityName", "DestCityName",
        (F.col("l_partkey") % 24).cast("int").alias("CRSDepTimeHour"),
        (F.col("l_suppkey") % 5).cast("int").alias("cause_slot"),
        dep.alias("DepDelay"), arr.alias("ArrDelay"),
        F.floor(F.col("l_extendedprice") / 40).cast("double").alias("Distance"),
        q.alias("TaxiOut"),
        F.col("l_linenumber").cast("double").alias("TaxiIn"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    d = F.col("DepDelay")
    causes = [F.when(d >= 15, F.when(F.col("cause_slot") == i, d).otherwise(F.lit(0.0)))
              .alias(name) for i, name in enumerate(CAUSE_COLUMNS)]
    return b.select("*", _nonneg(d).alias("DepDelayMinutes"),
                    _nonneg(F.col("ArrDelay")).alias("ArrDelayMinutes"), *causes)


def raw_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``flights`` shaped like a raw trip-record export: raw calendar
    parts (``DayofWeek`` Monday=1..Sunday=7) and ``*HourDis`` display
    twins of the hour columns, which the cleaning pass drops again."""
    f = flights(spark, sf_dir)
    fd = F.col("FlightDate")
    hours = {
        "CRSDepTimeHour": F.col("CRSDepTimeHour"),
        "WheelsOffHour": ((F.col("CRSDepTimeHour") + 1) % 24).cast("int"),
        "CRSArrTimeHour": ((F.col("CRSDepTimeHour") + 3) % 24).cast("int"),
        "WheelsOnHour": ((F.col("CRSDepTimeHour") + 3) % 24).cast("int"),
    }
    extra = [F.year(fd).alias("Year"), F.month(fd).alias("Month"),
             F.dayofmonth(fd).alias("DayofMonth"),
             (F.weekday(fd) + 1).alias("DayofWeek")]
    for name, c in hours.items():
        if name != "CRSDepTimeHour":
            extra.append(c.alias(name))
        extra.append(F.format_string("%02d:00", c).alias(name + "Dis"))
    return f.select("*", *extra)
