"""Exact top-k search by inner product: norm order, SVD rotation, residual bounds.

Vectors become integers, floor(scale * x) per component; scores are integer inner
products. Candidates are processed by descending length:

* They are range-partitioned by length and cut into numbered blocks of ``BLOCK``
  vectors, block 0 holding the longest.
* A rotation from the SVD of a bounded sample (``SAMPLE`` vectors, the least by a
  hash) turns the axes so that the first few carry most of a vector's length. It
  serves bounds only; no score depends on it.
* Block 0 gives every query a first threshold, its k-th best score there.
* A block of queries meets the candidate blocks from 0 on down to the last whose
  longest vector can still reach one of its thresholds: by Cauchy-Schwarz a score is
  at most the product of the lengths. They meet by an equi-join on the block's number.
* Within a pair of blocks a score is at most the inner product of the first
  rotated components plus the product of the residual lengths. That bound is
  taken for growing numbers of components; what it leaves is scored in integers, and
  the thresholds rise as blocks go by.

Nothing is approximate: bounds are widened by more than the rounding error of double
precision. A pair of blocks is one row; a task holds one pair and a list of k
candidates per query it has met.

Nulls and edges: vectors that are null or hold null or non-finite components take
no part. Vectors of different lengths are padded with zeros. A null id is no query; as
a candidate it comes after all others of its score. Rows that repeat an id are rows of
their own: each is a query, and a candidate to the others. Ties go to the smaller id.
Integers so large that a score may pass 64 bits raise. An empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaylens.llm.common import small_batches
from delaylens.session import materialize

BLOCK = 4096
QUERY_BLOCK = 1024
SAMPLE = 4096
STEPS = (0.125, 0.25, 0.5)      # shares of the rotated components after which candidates are pruned
LISTED = 1024                   # block lengths that queries are compared with
CHUNK = 512
SEED = 11

PACKED = "block long, rows int, longest double, uids binary, ids binary, named binary, ints binary"


def quantised(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(uid, vec_id, ints, size2) of the vectors that take part."""
    v = F.col(vec_col).cast("array<double>")
    rows = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(F.col("v").isNotNull())
            .where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
            .withColumn("scaled", F.transform("v", lambda x: F.floor(x * scale).cast("double"))))
    size2 = F.aggregate("scaled", F.lit(0.0), lambda s, x: s + x * x)
    return rows.select(F.monotonically_increasing_id().alias("uid"), "vec_id",
                       F.when(size2 < float(1 << 62), F.transform("scaled", lambda x: x.cast("long")))
                       .otherwise(F.raise_error(F.lit("scores of these vectors may pass 64 bits"))).alias("ints"), size2.alias("size2"))


def rotation(rows: DataFrame, dim: int) -> np.ndarray:
    """Right singular vectors of a bounded sample, one column each."""
    some = rows.orderBy(F.xxhash64("uid", F.lit(SEED)), "uid").limit(SAMPLE).select("ints").collect()      # SAMPLE rows
    a = np.zeros((max(1, len(some)), dim))
    for k, r in enumerate(some):
        a[k, :len(r["ints"])] = r["ints"]
    return np.linalg.svd(a.T @ a)[0]


def packed(rows: DataFrame, dim: int, block: int, by: list[Column], parts: int) -> DataFrame:
    """Vectors in order of ``by``, in blocks of ``block`` as little-endian integers: 8 bytes a component."""
    part = F.spark_partition_id().alias("part")
    schema = "part int, place long, " + PACKED

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        done = 0

        def flush(final: bool):
            nonlocal held, done
            t = pa.Table.from_batches(held)
            at = 0
            while t.num_rows - at >= block or final and t.num_rows > at:
                own = t.slice(at, block)
                n = own.num_rows
                ints = np.zeros((n, dim), np.int64)
                lists = own["ints"].combine_chunks()
                size = np.diff(lists.offsets.to_numpy())
                ints[np.repeat(np.arange(n), size), _ramps(size)] = lists.flatten().to_numpy()
                ids = own["vec_id"]
                row = (own["part"][0].as_py(), done, 0, n, float(np.sqrt(max(own["size2"].to_numpy()))), own["uid"].to_numpy().tobytes(),
                       ids.fill_null(0).to_numpy().tobytes(), np.asarray(ids.is_valid()).astype(np.uint8).tobytes(), ints.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([x], y) for x, y in zip(row, types)], names)
                at, done = at + n, done + 1
            held = t.slice(at).to_batches()

        types = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.float64(), *[pa.binary()] * 4]
        names = [c.split()[0] for c in schema.split(", ")]
        count = 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                count += batch.num_rows
                if count >= block:
                    yield from flush(False)
                    count = sum(b.num_rows for b in held)
        if count:
            yield from flush(True)

    sorted_rows = rows.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    made = materialize(sorted_rows.select(part, "uid", "vec_id", "ints", "size2").mapInArrow(pack, schema), "topk-packed")
    # a block's number is its place in its range after all blocks of the ranges before
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = (made.groupBy("part").agg(F.count(F.lit(1)).alias("blocks"))            # one row per range
             .select("part", F.coalesce(F.sum("blocks").over(before), F.lit(0)).alias("first")))
    return materialize(made.join(first, "part").withColumn("block", F.col("first") + F.col("place")).drop("part", "place", "first"),
                       "topk-blocks")


def _ramps(size: np.ndarray) -> np.ndarray:
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size, size)


class Block:
    """A packed block in a task, with rotated components and residual lengths."""

    def __init__(self, row: dict, dim: int, turn: np.ndarray, steps: list[int]):
        n = row["rows"]
        self.uid = np.frombuffer(row["uids"], np.int64)
        self.id = np.frombuffer(row["ids"], np.int64)
        self.named = np.frombuffer(row["named"], np.uint8).astype(bool)
        self.ints = np.frombuffer(row["ints"], np.int64).reshape(n, dim)
        self.float = self.ints.astype(np.float64)
        self.turned = self.float @ turn
        self.length = np.sqrt((self.float ** 2).sum(1))
        tail = np.cumsum((self.turned ** 2)[:, ::-1], axis=1)[:, ::-1]
        self.rest = [np.sqrt(np.maximum(tail[:, h], 0.0)) if h < dim else np.zeros(n) for h in steps]

    def dot(self, mine: np.ndarray, other: Block, theirs: np.ndarray) -> np.ndarray:
        """Exact integer scores of the given pairs of rows."""
        out = np.empty(len(mine), np.int64)
        for a in range(0, len(mine), 1 << 14):
            out[a:a + (1 << 14)] = np.einsum("ij,ij->i", self.ints[mine[a:a + (1 << 14)]], other.ints[theirs[a:a + (1 << 14)]])
        return out


class Best:
    """Each query's k best candidates so far: score down, id up (null last), row up."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.lists: list[list[tuple]] = [[] for _ in range(n)]
        self.need = np.full(n, -np.inf)

    def add(self, q: np.ndarray, score: np.ndarray, other: Block, c: np.ndarray) -> None:
        order = np.argsort(q, kind="stable")
        q, score, c = q[order], score[order], c[order]
        cuts = np.flatnonzero(np.diff(q)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(q)]):
            if a == b:
                continue
            at = int(q[a])
            own = score[a:b]
            if b - a > 4 * self.k:      # those below the k-th best score of the lot cannot stay
                keep = own >= np.partition(own, -self.k)[-self.k]
            else:
                keep = np.ones(b - a, bool)
            idx = c[a:b][keep]
            new = zip((-own[keep]).tolist(), (~other.named[idx]).tolist(), other.id[idx].tolist(), other.uid[idx].tolist())
            self.lists[at] = sorted([*self.lists[at], *new])[:self.k]
            if len(self.lists[at]) == self.k:
                self.need[at] = -self.lists[at][-1][0]


def scan(queries: Block, cands: Block, best: Best, floor: np.ndarray, steps: list[int]) -> None:
    """Add the candidates that can be among the k best of a query, longest first.
    ``floor``: scores that each query has reached k times elsewhere."""
    for a in range(0, len(cands.uid), CHUNK):
        b = min(a + CHUNK, len(cands.uid))
        need = np.maximum(best.need, floor)
        top = cands.length[a:b].max()
        # rounding: far less than a millionth of the product of the lengths
        live = np.flatnonzero(queries.length * top * (1 + 1e-6) + 1e-3 >= need)
        if not len(live):
            return
        slack = queries.length[live][:, None] * (cands.length[a:b] * 1e-6)[None, :] + 1e-3
        q, c = None, None
        for i, h in enumerate(steps):
            last = steps[i - 1] if i else 0
            if q is None:
                dots = queries.turned[live, :h] @ cands.turned[a:b, :h].T
                bound = dots + queries.rest[i][live][:, None] * cands.rest[i][a:b][None, :] + slack
                x, y = np.nonzero(bound >= need[live][:, None])
                q, c, dots = live[x], a + y, dots[x, y]
            else:
                if len(q) > (b - a) * len(live) // 4:       # dense: one product is cheaper than pairs
                    continue
                dots = np.einsum("ij,ij->i", queries.turned[q, :h], cands.turned[c, :h]) if last else dots
                bound = dots + queries.rest[i][q] * cands.rest[i][c] + queries.length[q] * cands.length[c] * 1e-6 + 1e-3
                keep = bound >= need[q]
                q, c = q[keep], c[keep]
        other = queries.uid[q] != cands.uid[c]
        q, c = q[other], c[other]
        score = queries.dot(q, cands, c)
        keep = score >= need[q]
        best.add(q[keep], score[keep], cands, c[keep])


def top_k(vectors: DataFrame, k: int = 5, query_modulo: int = 50, scale: int = 256, id_col: str = "vec_id",
          vec_col: str = "embedding", block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """Per query (ids divisible by ``query_modulo``) its ``k`` best other rows:
    ``query_id, rank, vec_id, score``, ties to the smaller ``vec_id``."""
    spark = vectors.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    out_schema = "query_uid long, query_id long, score long, vec_id long, uid long"
    with small_batches(spark):
        rows = materialize(quantised(vectors, id_col, vec_col, scale), "topk-ints")
        dim = max(1, rows.agg(F.max(F.size("ints"))).first()[0] or 0)
        turn = rotation(rows, dim)
    steps = sorted({max(1, int(dim * s)) for s in STEPS})
    names = [c.split()[0] for c in PACKED.split(", ")]
    with small_batches(spark):
        cands = packed(rows, dim, block, [F.desc("size2"), F.col("uid")], parts)
        queries = packed(rows.where(F.col("vec_id") % query_modulo == 0), dim, query_block, [F.desc("size2"), F.col("uid")],
                         max(1, min(parts, 32)))
    lengths, n_blocks = _block_lengths(cands)
    first = cands.where("block = 0").select(*names).collect()       # one block of bounded size
    if not first:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    longest = first[0].asDict()

    def seed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = None
        for batch in batches:
            for row in batch.to_pylist():
                top = top or Block(longest, dim, turn, steps)
                own = Block(row, dim, turn, steps)
                best = Best(row["rows"], k)
                scan(own, top, best, np.full(row["rows"], -np.inf), steps)
                # the last candidate block that can reach a threshold: need <= length * longest of the block
                with np.errstate(divide="ignore", invalid="ignore"):
                    reach = np.where(own.length > 0, best.need / own.length, np.where(best.need > 0, np.inf, -np.inf))
                least = float(reach.min()) - abs(float(reach.min())) * 1e-6 if np.isfinite(reach.min()) else float(reach.min())
                last = next((n for n, length in lengths if length < least), n_blocks)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row[c]], t) for c, t in zip(names, PACK_TYPES)]
                    + [pa.array([best.need.tobytes()], pa.binary()), pa.array([last], pa.int64())], [*names, "need", "last"])

    with small_batches(spark, 4):
        seeded = materialize(queries.select(*names).mapInArrow(seed, PACKED + ", need binary, last long"), "topk-queries")
    q = seeded.select(*[F.col(c).alias(f"q_{c}") for c in [*names, "need"]],
                      F.explode(F.sequence(F.lit(0).cast("long"), F.greatest("last", F.lit(1)) - 1)).alias("block"))
    pairs = q.join(cands.select(*names).hint("merge"), "block")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, Best] = {}
        keys: dict[int, tuple] = {}
        now, cand = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if now != row["block"]:
                    now, cand = row["block"], Block(row, dim, turn, steps)
                own = Block({c: row[f"q_{c}"] for c in names}, dim, turn, steps)
                key = row["q_block"]
                if key not in known:
                    known[key], keys[key] = Best(row["q_rows"], k), (own.uid, own.id)
                scan(own, cand, known[key], np.frombuffer(row["q_need"]), steps)
        for key, best in known.items():
            uid, ids = keys[key]
            found = [(int(uid[i]), int(ids[i]), -s, None if nameless else v, u) for i, own in enumerate(best.lists)
                     for s, nameless, v, u in own]
            for a in range(0, len(found), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found[a:a + 10_000])],
                                                 ["query_uid", "query_id", "score", "vec_id", "uid"])

    with small_batches(spark, 2):
        found = materialize(pairs.mapInArrow(search, out_schema), "topk-found")
    order = Window.partitionBy("query_uid").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "uid")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


PACK_TYPES = [pa.int64(), pa.int32(), pa.float64(), *[pa.binary()] * 4]


def _block_lengths(cands: DataFrame) -> tuple[list[tuple[int, float]], int]:
    """(number, longest length) of at most ``LISTED`` blocks spread evenly, and how many blocks there are."""
    n = cands.count()
    every = max(1, -(-n // LISTED))
    rows = cands.where(F.col("block") % every == 0).select("block", "longest").orderBy("block").collect()     # LISTED rows
    return [(r["block"], r["longest"]) for r in rows], n


ORACLE = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
WHERE rank <= 5
"""
