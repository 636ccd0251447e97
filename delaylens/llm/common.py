"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: a word is a run of anything but space, tab, line feed, vertical tab, form feed, carriage return
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

#: rows up to which a side that was counted is broadcast; beyond it the planner's shuffle join is kept
SMALL_ROWS = 20_000


def spare(df: DataFrame, *names: str) -> list[str]:
    """Column names that start with the given ones and clash with none of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def text_of(column: str) -> Column:
    """The text, with null read as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def small_side(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` (a written table) marked for broadcast if a count shows at most
    ``rows`` rows (default ``SMALL_ROWS``), else unchanged."""
    rows = SMALL_ROWS if rows is None else rows
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows for the jobs that run inside: a
    batch is held twice, by the JVM and by Python, and texts make it large."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def give_back() -> None:
    """Return memory that this process has freed but still holds to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc only
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``run`` for ``mapInArrow``, with freed memory given back at its end: Python workers
    live on between stages, beside whatever the executor does then."""
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()
    return whole


def byte_slices(batch: pa.RecordBatch, column: int, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a record batch into runs of rows whose texts hold about ``limit``
    bytes at most (one row at least), so that work arrays stay bounded."""
    if not batch.num_rows:
        return
    sizes = np.asarray(pc.binary_length(batch.column(column)).fill_null(0), dtype=np.int64)
    group = np.cumsum(sizes) // limit
    cuts = np.flatnonzero(np.diff(group)) + 1
    for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
        yield batch.slice(int(a), int(b - a))


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Groups of rows with equal values in the first ``keys`` columns, from sorted batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = list(zip(*(batch.column(k).to_pylist() for k in range(keys))))
        cuts = [i for i in range(1, len(values)) if values[i] != values[i - 1]]
        for a, b in zip([0, *cuts], [*cuts, len(values)]):
            if held and values[a] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = values[a]
    if held:
        yield pa.Table.from_batches(held)


class Memo:
    """What was worked out before, ``limit`` entries at most: when the younger
    half is full it replaces the older one, and what is asked for again stays."""

    def __init__(self, limit: int):
        self.half, self.young, self.old = max(1, limit // 2), {}, {}

    def get(self, key):
        found = self.young.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.young) >= self.half:
            self.old, self.young = self.young, {}
        self.young[key] = value
