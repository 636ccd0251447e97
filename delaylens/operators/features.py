"""Row-wise derivations (B-family). All are narrow transformations: no
shuffle, one ``select`` each, fused by whole-stage codegen."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylens.functions import columns as C
from delaylens.functions.guards import has


def parse_date(df: DataFrame, src: str = "FlightDate", dst: str = "DepDate") -> DataFrame:
    """text/timestamp date -> DATE column ``dst``; the source is dropped."""
    if src not in df.columns:
        return df
    parsed = F.to_date(F.col(src)) if dict(df.dtypes)[src] in ("string",) else F.col(src).cast("date")
    return df.withColumn(dst, parsed).drop(src) if src != dst else df.withColumn(dst, parsed)


def split_city_state(df: DataFrame, pairs: Sequence[tuple[str, str, str]] = (
        ("OriginCityName", "OriginCity", "OriginState"),
        ("DestCityName", "DestCity", "DestState")), sep: str = ", ") -> DataFrame:
    """B4: 'City, ST' -> City, State columns; the source is dropped."""
    for src, city, state in pairs:
        if src in df.columns:
            df = (df.withColumns({city: C.city_part(src, 0, sep), state: C.city_part(src, 1, sep)})
                  .drop(src))
    return df


def map_carrier(df: DataFrame, code: str = "Marketing_Airline_Network",
                dst: str = "CarrierName", mapping: dict = C.AIRLINE_NAMES,
                unknown: str = C.UNKNOWN_AIRLINE) -> DataFrame:
    """Code -> carrier name, unknown -> 'Unknown Airline'."""
    if code not in df.columns:
        return df
    return df.withColumn(dst, C.carrier_name(code, mapping, unknown))


def date_parts(df: DataFrame, date: str = "DepDate") -> DataFrame:
    """Year, Month, Day, DayOfWeek (Monday=0), Quarter."""
    d = F.col(date)
    return df.withColumns({"Year": F.year(d), "Month": F.month(d), "Day": F.dayofmonth(d),
                           "DayOfWeek": F.weekday(d), "Quarter": F.quarter(d)})


def add_season(df: DataFrame, month: str = "Month", dst: str = "Season") -> DataFrame:
    """B10."""
    return df.withColumn(dst, C.season(month))


def add_route(df: DataFrame, origin: str = "OriginCity", dest: str = "DestCity",
              dst: str = "Route", only_if_missing: bool = False) -> DataFrame:
    """Origin + ' → ' + dest (null when either side is null)."""
    if only_if_missing and dst in df.columns:
        return df
    if not has(df, origin, dest):
        return df
    return df.withColumn(dst, C.route(origin, dest))


def add_delay_severity(df: DataFrame, delay: str = "DepDelayMinutes",
                       dst: str = "DelaySeverity") -> DataFrame:
    """B12."""
    return df.withColumn(dst, C.delay_severity(delay)) if delay in df.columns else df


def add_delay_bucket(df: DataFrame, delay: str = "DepDelayMinutes", dst: str = "DelayBucket",
                     null_bucket: int = 3) -> DataFrame:
    """B13."""
    return df.withColumn(dst, C.delay_bucket(delay, null_bucket))


def add_is_delayed(df: DataFrame, delay: str = "DepDelayMinutes", dst: str = "IsDelayed",
                   threshold: float = 0) -> DataFrame:
    """B14."""
    return df.withColumn(dst, C.is_delayed(delay, threshold))


def add_cause_flags(df: DataFrame, causes: Iterable[str] = (
        "WeatherDelay", "CarrierDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay"),
        minutes_copies: bool = False) -> DataFrame:
    """``<cause>_Binary`` = cause > 0 for each cause present; optional
    ``<cause>_Minutes`` copies."""
    new = {}
    for c in causes:
        if c in df.columns:
            new[f"{c}_Binary"] = C.flag(F.col(c) > 0)
            if minutes_copies:
                new[f"{c}_Minutes"] = F.col(c)
    return df.withColumns(new) if new else df


def add_time_flags(df: DataFrame, dow: str = "DayOfWeek", hour: str = "CRSDepTimeHour") -> DataFrame:
    """Weekend (dow>=5), evening (h>=18), morning (h<=10), peak (7-9, 17-19)."""
    h = F.col(hour)
    return df.withColumns({
        "IsWeekend": C.flag(F.col(dow) >= 5),
        "IsEvening": C.flag(h >= 18),
        "IsMorning": C.flag(h <= 10),
        "IsPeakHour": C.flag(h.between(7, 9) | h.between(17, 19)),
    })


def add_hour_of_day(df: DataFrame, hour: str = "CRSDepTimeHour", dst: str = "HourOfDay") -> DataFrame:
    """B17."""
    return df.withColumn(dst, F.col(hour))


def add_distance_group(df: DataFrame, distance: str = "Distance", dst: str = "DistanceGroup",
                       labels: list | None = None) -> DataFrame:
    """Right-closed bins; codes 1..5 or text labels."""
    return df.withColumn(dst, C.distance_group(distance, labels=labels))


def add_season_ordinal(df: DataFrame, season: str = "Season", dst: str = "SeasonEncoded") -> DataFrame:
    """B19."""
    return df.withColumn(dst, C.season_ordinal(season))


def add_calendar_labels(df: DataFrame, dow: str = "DayOfWeek", month: str = "Month",
                        quarter: str = "Quarter") -> DataFrame:
    """DayName, MonthName, QuarterName."""
    new = {}
    if dow in df.columns:
        new["DayName"] = C.name_of(dow, C.DAY_NAMES, 0)
    if month in df.columns:
        new["MonthName"] = C.name_of(month, C.MONTH_NAMES, 1)
    if quarter in df.columns:
        new["QuarterName"] = C.name_of(quarter, C.QUARTER_NAMES, 1)
    return df.withColumns(new)


def add_short_label(df: DataFrame, src: str = "Route", dst: str = "ShortLabel", n: int = 20) -> DataFrame:
    """B22."""
    return df.withColumn(dst, C.short_label(src, n))


def add_period(df: DataFrame, periods: dict[str, Iterable[int]], year: str = "Year",
               dst: str = "Period", short: bool = False) -> DataFrame:
    """One ``Period`` column instead of one scan per year set."""
    p = C.period_of(year, periods)
    return df.withColumn(dst, C.strip_year_suffix(p) if short else p)


def enrich(df: DataFrame) -> DataFrame:
    """The row-wise part of preprocessing (B3, B4, B5, B9-B12) in the
    reference's order, without the duplicate removal or year filter.
    This is the analysis input for every report."""
    df = parse_date(df)
    df = split_city_state(df)
    df = map_carrier(df)
    df = date_parts(df)
    df = add_season(df)
    df = add_route(df)
    return add_delay_severity(df)
