"""Column builders: every per-row rule is a built-in expression, so it
stays inside whole-stage codegen (no Python UDFs)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Carrier code -> name; anything else is 'Unknown Airline'.
AIRLINE_NAMES = {
    "WN": "Southwest Airlines",
    "AA": "American Airlines",
    "DL": "Delta Air Lines",
    "UA": "United Airlines",
    "B6": "JetBlue Airways",
    "NK": "Spirit Airlines",
    "F9": "Frontier Airlines",
    "AS": "Alaska Airlines",
    "HA": "Hawaiian Airlines",
    "VX": "Virgin America",
    "G4": "Allegiant Air",
}
UNKNOWN_AIRLINE = "Unknown Airline"

# Calendar names (weekday index Monday=0).
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
MONTH_NAMES = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
QUARTER_NAMES = ["Q1 (Winter)", "Q2 (Spring)", "Q3 (Summer)", "Q4 (Fall)"]
# Season ordinal codes.
SEASON_ORDINAL = {"Spring": 0, "Summer": 1, "Fall": 2, "Winter": 3}
# Distance bin edges (right-closed) and their text labels.
DISTANCE_EDGES = [0, 500, 1000, 1500, 2000]
DISTANCE_LABELS = ["Short", "Medium", "Long", "Very Long", "Ultra Long"]

ROUTE_ARROW = " → "


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit_map(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def carrier_name(code: str | Column, mapping: dict = AIRLINE_NAMES,
                 unknown: str = UNKNOWN_AIRLINE) -> Column:
    """Code -> name; unknown or null codes -> ``unknown``."""
    return F.coalesce(F.try_element_at(lit_map(mapping), col_(code)), F.lit(unknown))


def carrier_name_raw(code: str | Column, mapping: dict = AIRLINE_NAMES) -> Column:
    """B5 before the fill: null for unmapped codes (B6 counts them)."""
    return F.try_element_at(lit_map(mapping), col_(code))


def city_part(c: str | Column, i: int, sep: str = ", ") -> Column:
    """I-th part of 'City, ST' (null when absent; never raises)."""
    return F.get(F.split(col_(c), sep, -1), i)


def bad_city(c: str | Column, sep: str = ", ") -> Column:
    """Values that do not split into exactly two parts."""
    return F.coalesce(F.size(F.split(col_(c), sep, -1)) != 2, F.lit(False))


def season(month: str | Column) -> Column:
    """12,1,2 Winter; 3-5 Spring; 6-8 Summer; else Fall."""
    m = col_(month)
    return (F.when(m.isin(12, 1, 2), "Winter").when(m.isin(3, 4, 5), "Spring")
            .when(m.isin(6, 7, 8), "Summer").otherwise("Fall"))


def route(origin: str | Column, dest: str | Column, arrow: str = ROUTE_ARROW) -> Column:
    """Null-propagating concat, like adding pandas strings."""
    return F.concat(col_(origin), F.lit(arrow), col_(dest))


def delay_severity(x: str | Column) -> Column:
    """Null or <=0 On Time; <=15 Minor; <=60 Moderate; else Major."""
    d = col_(x)
    return (F.when(d.isNull() | (d <= 0), "On Time").when(d <= 15, "Minor Delay")
            .when(d <= 60, "Moderate Delay").otherwise("Major Delay"))


def delay_bucket(x: str | Column, null_bucket: int = 3) -> Column:
    """<=0 -> 0, <=15 -> 1, <=60 -> 2, else 3; null -> ``null_bucket``
    (a NaN fails every comparison in the original rule, landing in 3)."""
    d = col_(x)
    return (F.when(d.isNull(), F.lit(null_bucket)).when(d <= 0, 0).when(d <= 15, 1)
            .when(d <= 60, 2).otherwise(3)).cast("int")


def is_delayed(x: str | Column, threshold: float = 0) -> Column:
    """1 when x > threshold, null -> 0."""
    return F.when(col_(x) > threshold, 1).otherwise(0).cast("int")


def flag(cond: Column) -> Column:
    """Boolean -> 0/1 with null -> 0."""
    return F.when(cond, 1).otherwise(0).cast("int")


def rate(cond: Column) -> Column:
    """Share of rows where ``cond`` holds, nulls counted as False."""
    return F.avg(F.when(cond, 1.0).otherwise(0.0))


def pct(cond: Column) -> Column:
    return rate(cond) * 100.0


def distance_group(x: str | Column, edges: list = DISTANCE_EDGES,
                   labels: list | None = None) -> Column:
    """Right-closed bins (0,500], (500,1000], ...; <=0 or null -> null.
    Returns 1..k, or ``labels[i]`` when labels are given."""
    d = col_(x)
    out = F.when(d.isNull() | (d <= edges[0]), F.lit(None))
    for i, hi in enumerate(edges[1:], start=1):
        out = out.when(d <= hi, F.lit(labels[i - 1] if labels else i))
    last = len(edges)
    out = out.otherwise(F.lit(labels[last - 1] if labels else last))
    return out if labels else out.cast("int")


def season_ordinal(s: str | Column, mapping: dict = SEASON_ORDINAL) -> Column:
    """Spring 0, Summer 1, Fall 2, Winter 3."""
    return F.try_element_at(lit_map(mapping), col_(s)).cast("int")


def name_of(idx: str | Column, names: list, base: int = 0) -> Column:
    """``names[idx - base]``; out of range -> null."""
    return F.try_element_at(F.array(*[F.lit(n) for n in names]),
                            (col_(idx) - base + 1).cast("int"))


def short_label(c: str | Column, n: int = 20) -> Column:
    """First ``n`` characters plus '...' when longer."""
    s = col_(c)
    return F.when(F.length(s) > n, F.concat(F.substring(s, 1, n), F.lit("..."))).otherwise(s)


def period_of(year: str | Column, periods: dict[str, Iterable[int]]) -> Column:
    """Year -> period name (first matching set), else null."""
    y = col_(year)
    out = None
    for name, years in periods.items():
        cond = y.isin(*list(years))
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out.otherwise(F.lit(None).cast("string"))


def strip_year_suffix(c: str | Column) -> Column:
    """B23: 'Pre (1996-1997)' -> 'Pre'."""
    return F.trim(F.regexp_replace(col_(c), r"\s*\(\d{4}(-\d{4})?\)\s*$", ""))


def not_in_years(year: str | Column, years: Iterable[int]) -> Column:
    """Keep rows whose year is not listed; null years are kept."""
    return ~F.coalesce(col_(year).isin(*list(years)), F.lit(False))
