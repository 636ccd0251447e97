"""Readers for the driver's parquet tables.

Every reader returns a lazy DataFrame; projections written after it are
pruned into the parquet scan by Catalyst, so callers select only what
they need and filters reach ``PushedFilters``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylens.session import app_key

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


_READERS: dict = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a lazy DataFrame. The reader (file listing and parquet
    footer schema) is created once per Spark application and path; every
    query still plans its own pruned, filtered scan from it."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    key = (app_key(spark), table_path(sf_dir, name))
    if key not in _READERS:
        _READERS[key] = spark.read.parquet(key[1])
    return _READERS[key]


_SIZES: dict = {}


def table_bytes(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Size of the table's files, looked up once per Spark application and path."""
    key = (app_key(spark), table_path(sf_dir, name))
    if key not in _SIZES:
        found = spark.read.format("binaryFile").load(key[1]).agg(F.sum("length")).first()[0]
        _SIZES[key] = int(found or 0)
    return _SIZES[key]


def scan_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """A1: read one or more parquet files as one DataFrame."""
    return spark.read.parquet(*paths)
