"""Shared query inputs built from the driver's tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from delaylens.operators import clean
from delaylens.operators.features import enrich
from delaylens.sources.flights import flights, raw_flights, shipped_in

# Identifying columns carried by row-level queries ((orderkey, linenumber)
# alone is not unique in the test data, so all four travel together).
KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def fl(spark: SparkSession, sf: str) -> DataFrame:
    return flights(spark, sf)


def trips(spark: SparkSession, sf: str, years: Sequence[int] = (), without: Sequence[int] = ()) -> DataFrame:
    """Row-wise enriched flights: the analysis input. With ``years`` or
    ``without`` only the files' row groups that may hold such dates are read."""
    return enrich(flights(spark, sf, shipped_in(years, without)))


def raw(spark: SparkSession, sf: str) -> DataFrame:
    """Raw-export shaped flights after ingest (``DayofWeek`` renamed)."""
    return clean.ingest(raw_flights(spark, sf))
