"""Cleaning (B1, B2, B7, B8, D3) and ingest rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from delaylens.functions.guards import numeric_columns
from delaylens.operators import distinct

RAW_WEEKDAY = "DayofWeek"
RAW_WEEKDAY_RENAMED = "DayofWeek_raw"

# Fixed values: (drop, keep) pairs of the redundancy pass; a column is
# dropped only when it and its kept twin both exist.
REDUNDANT_PAIRS = [
    ("DepDelay", "DepDelayMinutes"),
    ("ArrDelay", "ArrDelayMinutes"),
    (RAW_WEEKDAY_RENAMED, "DayOfWeek"),
    ("Marketing_Airline_Network", "CarrierName"),
    ("CRSDepTimeHourDis", "CRSDepTimeHour"),
    ("WheelsOffHourDis", "WheelsOffHour"),
    ("CRSArrTimeHourDis", "CRSArrTimeHour"),
    ("WheelsOnHourDis", "WheelsOnHour"),
]
RAW_DATE_PARTS = ["Year", "Month", "DayofMonth"]


def ingest(df: DataFrame) -> DataFrame:
    """Rename the raw ``DayofWeek`` (Monday=1) so that the derived
    ``DayOfWeek`` (Monday=0) cannot overwrite it: Spark column names are
    case-insensitive (trap T4)."""
    names = df.columns
    if RAW_WEEKDAY in names:
        return df.withColumnRenamed(RAW_WEEKDAY, RAW_WEEKDAY_RENAMED)
    return df


def redundant_columns(df: DataFrame, pairs: Sequence[tuple[str, str]] = REDUNDANT_PAIRS) -> list[str]:
    cols = set(df.columns)
    return [a for a, b in pairs if a in cols and b in cols]


def drop_redundant(df: DataFrame, pairs: Sequence[tuple[str, str]] = REDUNDANT_PAIRS) -> DataFrame:
    """B1: drop A where both A and its kept twin B exist."""
    return df.drop(*redundant_columns(df, pairs))


def drop_raw_dateparts(df: DataFrame, cols: Sequence[str] = RAW_DATE_PARTS) -> DataFrame:
    """B2."""
    return df.drop(*[c for c in cols if c in df.columns])


def fill_delay_nulls(df: DataFrame, cols: Sequence[str] = ("DepDelayMinutes", "ArrDelayMinutes")) -> DataFrame:
    """Null delay minutes -> 0 (staged pipeline only)."""
    cols = [c for c in cols if c in df.columns]
    return df.fillna(0, subset=cols) if cols else df


def fill_features(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Null -> 0 in numeric feature columns."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    return df.fillna(0, subset=cols) if cols else df


def drop_duplicates(df: DataFrame) -> DataFrame:
    """D3: whole-row distinct (nulls compare equal). 128-bit digests are shuffled,
    whole rows only where a digest repeats."""
    return distinct.drop_duplicates(df)
