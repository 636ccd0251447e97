"""The cleaning stage as one lazy plan.

``complete`` (redundancy pass before derivation, delay nulls kept) and
``staged`` (nulls filled, redundancy pass after derivation) are the two
variants of the original; the reports are side DataFrames over the same
plan. Only the cleaned table is written (one job, partitioned by Year so
later year filters prune directories)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylens.operators import clean, features as B, filters as CF, reports as R
from delaylens.plans import params as P
from delaylens.sources.files import sink_parquet


class Reports(dict):
    """Reports by name; one given as a function is worked out when it is first asked for."""

    def __getitem__(self, name):
        value = super().__getitem__(name)
        if callable(value):
            value = value()
            self[name] = value
        return value

    def get(self, name, default=None):
        return self[name] if name in self else default

    def items(self):
        return [(k, self[k]) for k in self]

    def values(self):
        return [self[k] for k in self]


def preprocess(df: DataFrame, fill_delay_nulls: bool = False, redundancy_pass: str = "before",
               exclude_years: Sequence[int] = P.EXCLUDE_YEARS) -> tuple[DataFrame, dict]:
    if redundancy_pass not in ("before", "after"):
        raise ValueError("redundancy_pass must be 'before' or 'after'")
    df = clean.ingest(df)
    source = df
    reports = Reports(missing_before=R.missing_report(df), duplicates_before=lambda: R.duplicate_count(source))
    if redundancy_pass == "before":
        df = clean.drop_redundant(df)
    df = clean.drop_raw_dateparts(df)
    df = B.parse_date(df)
    df = B.split_city_state(df)
    # the carrier's name follows from its code: duplicates are found on the narrower row
    df, reports["dedupe"] = R.drop_duplicates_report(df)
    df = B.map_carrier(df)
    if fill_delay_nulls:
        df = clean.fill_delay_nulls(df)
    df = B.date_parts(df)
    df = B.add_season(df)
    df = B.add_route(df)
    df = B.add_delay_severity(df)
    if redundancy_pass == "after":
        reports["severity_counts"] = R.severity_counts(df)
        df = clean.drop_redundant(df)
    reports["year_counts"] = R.year_counts_before_after(df, exclude_years)
    df = CF.exclude_years(df, exclude_years)
    reports["kpis"] = R.delay_kpis(df)
    reports["missing_after"] = R.missing_report(df)
    reports["duplicates_after"] = lambda: R.duplicate_count(df)
    return df, reports


def write_handover(cleaned: DataFrame, path: str) -> DataFrame:
    """Write the cleaned table partitioned by Year and return the read-back
    (the stage hand-over; year filters downstream prune directories)."""
    sink_parquet(cleaned, path, partition_by=["Year"])
    back = cleaned.sparkSession.read.parquet(path)
    return back.withColumn("Year", F.col("Year").cast("int"))


def preprocess_complete(df: DataFrame, **kw) -> tuple[DataFrame, dict]:
    """P1."""
    return preprocess(df, fill_delay_nulls=False, redundancy_pass="before", **kw)


def preprocess_staged(df: DataFrame, **kw) -> tuple[DataFrame, dict]:
    """P2."""
    return preprocess(df, fill_delay_nulls=True, redundancy_pass="after", **kw)
