"""Schema guards resolved on the driver from ``df.schema`` (metadata only,
no data is read): column discovery, availability and requirement checks."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
           T.DoubleType, T.DecimalType)

# Cause families and the lowercase substrings that find them.
CAUSE_FAMILIES = {
    "delay_cause": ("delay", "cause"),
    "weather": ("weather",),
    "carrier": ("carrier",),
    "nas": ("nas",),
    "security": ("security",),
    "late_aircraft": ("late", "aircraft"),
}


def has(df: DataFrame, *cols: str) -> bool:
    names = set(df.columns)
    return all(c in names for c in cols)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def find_columns(spark: SparkSession, df: DataFrame,
                 families: dict[str, tuple[str, ...]] = CAUSE_FAMILIES) -> DataFrame:
    """(family, column) for every column whose lowercase name contains
    all substrings of a family; plus numeric '*delay*' columns."""
    rows = []
    for fam, subs in families.items():
        for c in df.columns:
            if all(s in c.lower() for s in subs):
                rows.append((fam, c))
    num = set(numeric_columns(df))
    rows += [("numeric_delay", c) for c in df.columns if "delay" in c.lower() and c in num]
    return spark.createDataFrame(rows, "family string, column string")


def select_available(df: DataFrame, wanted: Sequence[str], suffix: str | None = "_Encoded",
                     extra: Sequence[str] = ()) -> DataFrame:
    """Keep wanted columns that exist, plus any ending in ``suffix``
    and ``extra``; order-preserving, duplicates removed."""
    cols = [c for c in wanted if c in df.columns]
    if suffix:
        cols += [c for c in df.columns if c.endswith(suffix)]
    cols += [c for c in extra if c in df.columns]
    seen, out = set(), []
    for c in cols:
        if c not in seen:
            seen.add(c)
            out.append(c)
    return df.select(*out)


def required_columns(spark: SparkSession, df: DataFrame, required: dict[str, str],
                     raise_missing: bool = False) -> DataFrame:
    """(column, description, present) report; raises when asked."""
    rows = [(c, d, c in df.columns) for c, d in required.items()]
    missing = [c for c, _, p in rows if not p]
    if raise_missing and missing:
        raise ValueError(f"missing required columns: {missing}")
    return spark.createDataFrame(rows, "column string, description string, present boolean")


def dtype_counts(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Number of columns per data type, plus the numeric total."""
    counts: dict[str, int] = {}
    for _, t in df.dtypes:
        counts[t] = counts.get(t, 0) + 1
    rows = sorted(counts.items()) + [("numeric_total", len(numeric_columns(df)))]
    return spark.createDataFrame(rows, "dtype string, n_columns int")


def require(df: DataFrame, cols: Iterable[str]) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"required columns not found: {missing}")
