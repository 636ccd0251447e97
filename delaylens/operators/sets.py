"""Set operations (H-family)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylens.functions import columns as C


def _period_keys(df: DataFrame, key: str, years: Sequence[int], year: str) -> DataFrame:
    return df.where(F.col(year).isin(*years) & F.col(key).isNotNull()).select(key)


def keys_dropped(df: DataFrame, key: str, before: Sequence[int], after: Sequence[int],
                 year: str = "Year") -> DataFrame:
    """H1: keys seen in ``before`` years but not in ``after`` (EXCEPT
    DISTINCT, planned as a left-anti join over distinct keys)."""
    return _period_keys(df, key, before, year).subtract(_period_keys(df, key, after, year))


def keys_added(df: DataFrame, key: str, before: Sequence[int], after: Sequence[int],
               year: str = "Year") -> DataFrame:
    """H2: the reverse of H1."""
    return keys_dropped(df, key, after, before, year)


def key_change_counts(df: DataFrame, key: str, before: Sequence[int], after: Sequence[int],
                      year: str = "Year") -> DataFrame:
    """H3: total distinct keys, dropped and added counts in one
    ``groupBy(key)`` with presence flags (one shuffle instead of three)."""
    y = F.col(year)
    pres = (df.where(F.col(key).isNotNull()).groupBy(key)
            .agg(F.max(C.flag(y.isin(*before))).alias("b"), F.max(C.flag(y.isin(*after))).alias("a")))
    return pres.agg(F.count(F.lit(1)).alias("Total_Routes"),
                    F.count_if((F.col("b") == 1) & (F.col("a") == 0)).alias("Routes_Dropped"),
                    F.count_if((F.col("a") == 1) & (F.col("b") == 0)).alias("Routes_Added"))


def years_intersect(a: DataFrame, b: DataFrame, year: str = "Year") -> DataFrame:
    """H4: common years of two splits (INTERSECT DISTINCT)."""
    return a.select(year).where(F.col(year).isNotNull()).intersect(
        b.select(year).where(F.col(year).isNotNull()))


def union_chunks(parts: Sequence[DataFrame]) -> DataFrame:
    """H5/A3: concatenation by column name."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
