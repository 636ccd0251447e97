"""Small tables: all tables of a run as one, with a row for each value of each
table; and tables of few rows that are joined back to many."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

#: rows up to which a counted table is broadcast
FEW_ROWS = 100_000


def few_rows(df: DataFrame) -> DataFrame:
    """``df`` (cheap to count, as made from a written table) marked for broadcast if it
    holds at most ``FEW_ROWS`` rows. Left to the planner, a join on a key of few values
    shuffles all rows of the other side to as many tasks as there are values."""
    return F.broadcast(df) if df.limit(FEW_ROWS + 1).count() <= FEW_ROWS else df


def one_table(tables: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """``tables`` by name with their key columns, as rows ``name, key, metric, value,
    text``: a row for each row and column that is no key. The key holds the key columns
    joined by ``|`` (nulls as ``-``); numbers stand in ``value`` as doubles, all else in
    ``text``. Each table is stacked where it is computed, without a further shuffle."""
    parts = []
    for name, (df, keys) in tables.items():
        key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("-")) for k in keys])
        cells = []
        for f in df.schema.fields:
            if f.name in keys:
                continue
            number = isinstance(f.dataType, NumericType)
            cells.append(F.struct(F.lit(f.name).alias("metric"),
                                  (F.col(f.name) if number else F.lit(None)).cast("double").alias("value"),
                                  (F.lit(None) if number else F.col(f.name)).cast("string").alias("text")))
        parts.append(df.select(F.lit(name).alias("name"), key.alias("key"), F.explode(F.array(*cells)).alias("c"))
                     .select("name", "key", "c.*"))
    return reduce(DataFrame.unionByName, parts)
