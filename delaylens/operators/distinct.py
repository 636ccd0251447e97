"""Whole-row duplicates (D2, D3) found on narrow digests.

A row is named by 128 bits (two 64-bit hashes over all its columns and the set of
its nulls). Only these 16 bytes are shuffled, combined on the map side. Whole rows
move where a digest occurs more than once, and there rows are compared column by
column, so two different rows with one digest both stay. The rows are read twice;
the repeated digests are a written table, broadcast while a count shows them
small. Beyond that so much of the table repeats that one plain distinct is cheaper.

Nulls compare equal, as do the two zeros and all NaNs. The table must read the same
twice (row-wise derivations of files do).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylens.session import materialize

#: repeated digests up to which their table is broadcast
SMALL_DIGESTS = 500_000


def _named(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """``df`` with its digest in two columns whose names clash with none."""
    taken = {c.lower() for c in df.columns}
    names = []
    for n in ("__digest_a", "__digest_b"):
        while n in taken:
            n += "_"
        taken.add(n)
        names.append(n)
    cols = [F.col(f"`{c}`") for c in df.columns]
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in cols]) if cols else F.lit("")
    return df.withColumns({names[0]: F.xxhash64(nulls, *cols),
                           names[1]: F.xxhash64(F.lit("second"), *reversed(cols), nulls)}), names


def _counts(df: DataFrame) -> tuple[DataFrame, list[str], DataFrame]:
    """(rows with digest, digest columns, rows per digest)."""
    rows, names = _named(df)
    return rows, names, rows.groupBy(*names).agg(F.count(F.lit(1)).alias("__n"))


def drop_duplicates(df: DataFrame) -> DataFrame:
    """D3: the distinct rows."""
    rows, names, counts = _counts(df)
    repeated = materialize(counts.where("__n > 1").select(*names), "repeated-digests")
    found = repeated.limit(SMALL_DIGESTS + 1).count()
    if found == 0:
        return df
    if found > SMALL_DIGESTS:
        return df.dropDuplicates()
    few = F.broadcast(repeated)
    alone = rows.join(few, names, "left_anti").drop(*names)
    # the digest is no grouping key: equal rows have equal digests
    again = rows.join(few, names, "left_semi").drop(*names).dropDuplicates()
    return alone.unionByName(again)


def duplicate_counts(df: DataFrame) -> DataFrame:
    """One row: ``rows`` and ``distinct_rows`` (null for an empty table)."""
    rows, names, counts = _counts(df)
    counts = materialize(counts.groupBy(F.when(F.col("__n") > 1, F.struct(*names)).alias("d"))
                         .agg(F.sum("__n").alias("n")), "digest-counts")
    repeated = counts.where("d is not null").select("d.*")
    found = repeated.limit(SMALL_DIGESTS + 1).count()
    if found == 0:
        return counts.agg(F.sum("n").alias("rows"), F.sum("n").alias("distinct_rows"))
    few = rows.join(F.broadcast(repeated), names, "left_semi") if found <= SMALL_DIGESTS else rows.join(repeated, names, "left_semi")
    again = few.drop(*names).groupBy(*[f"`{c}`" for c in df.columns]).agg(F.count(F.lit(1)).alias("m"))
    kinds = again.agg(F.count(F.lit(1))).scalar()
    return counts.agg(F.sum("n").alias("rows"),
                      (F.coalesce(F.sum(F.when(F.col("d").isNull(), F.col("n"))), F.lit(0)) + kinds).alias("distinct_rows"))
