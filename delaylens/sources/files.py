"""File sources and sinks (A-family).

Stage hand-overs go to the shared folder named by ``spark.checkpoint.dir``
(see ``delaylens.session.scratch_path``); every write is a distributed
``DataFrameWriter`` job with one file per task, never a driver-side
collect. Re-running a failed task rewrites only its own file (the commit
protocol discards partial attempts), so lost executors are survived."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str,
             header: bool = True) -> DataFrame:
    """A2: CSV with an explicit schema (no inference pass)."""
    paths = [path] if isinstance(path, str) else list(path)
    return (spark.read.schema(schema).option("header", header).option("mode", "FAILFAST")
            .option("dateFormat", "yyyy-MM-dd").csv(paths))


def scan_csv_chunked(spark: SparkSession, paths: Sequence[str], schema: T.StructType | str,
                     header: bool = True) -> DataFrame:
    """A3: several CSV parts read one by one and concatenated by name.
    (One ``spark.read.csv`` over all paths plans the same scan; parts are
    kept separate here when they may carry different column orders.)"""
    parts = [scan_csv(spark, p, schema, header) for p in paths]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def sample_rows(df: DataFrame, per_mille: int, seed: int = 42, cols: Sequence[str] | None = None) -> DataFrame:
    """A4: deterministic sample of about ``per_mille``/1000 of the rows, by a
    hash of ``cols`` (default: every column), repeatable under any
    partitioning, unlike ``limit`` or ``sample`` on many files."""
    from delaylens.operators.ml import hash_unit
    return df.where(hash_unit(df, seed, cols) < per_mille / 1000.0)


def sample_n(df: DataFrame, n: int, seed: int = 42, cols: Sequence[str] | None = None) -> DataFrame:
    """A4 by size: about ``n`` rows by the same row hash; the fraction is
    n / count(*) from a scalar subquery (all rows when n >= count)."""
    from delaylens.operators.ml import hash_unit
    total = df.agg(F.count(F.lit(1))).scalar()
    return df.where(hash_unit(df, seed, cols) < F.lit(float(n)) / total)


def sink_csv(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> str:
    """A5: CSV with header, no index; optionally partitioned."""
    w = df.write.mode(mode).option("header", True).option("dateFormat", "yyyy-MM-dd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)
    return path


def sink_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> str:
    """Parquet hand-over between stages (partition by ``Year`` so that
    year filters prune directories)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def sink_if_changed(spark: SparkSession, full: DataFrame, subset: DataFrame, path: str) -> DataFrame:
    """Write ``subset`` only when its row count differs from ``full``;
    returns a one-row report. The two counts are one small job each."""
    n_full, n_sub = full.count(), subset.count()
    written = n_full != n_sub
    if written:
        sink_csv(subset, path)
    return spark.createDataFrame([(n_full, n_sub, written)],
                                 "Input_Rows bigint, Subset_Rows bigint, Written boolean")
