"""Near-duplicate vectors by a forest of random-projection trees.

Vectors with equal labels (and lengths) whose cosine is at least ``MIN_COS`` are
linked. Equal vectors of a label are one *class* first, so a vector repeated by
a third of all rows is one row here.

Every tree draws a random direction per level (shared by the nodes of the
level) and splits a node there at a threshold near its median: the widest gap
between the node's quantiles in the middle half, so that a dense cluster falls
on one side whole. Vectors within the margin of the threshold go to both sides
(spill). A node becomes a leaf when it holds ``LEAF`` vectors at most, or when the
middle half of its projections is narrower than ``DENSE``: such a node is a
cluster of near copies that no direction parts. Directions have length
sqrt(dimension): a linked pair then lies sqrt(2 - 2 * ``MIN_COS``) = 0.2 deviations of
all vectors apart at most times a standard normal, whatever the dimension, and
margin and density mean the same at 64 and at 4,096. Thresholds come from one
``percentile_approx`` per level over all nodes of all trees; the number of
levels grows with the number of vectors and nothing is fitted on a sample.

Within a leaf the vectors are compared by exact cosines in double precision. A
leaf of more than ``BLOCK`` vectors is cut into blocks and each pair of blocks
is a task's work, so no task holds a whole large leaf. No pairs are written:
a task returns per vector the number of links found and its smallest partner.
A pair that meets in several leaves is counted in the first of them only (each
vector carries the leaves it lies in). Components are put together from the
smallest partners.

A linked pair is found if any of the ``TREES`` trees keeps it together; every pair
reported was verified. ``brute_force`` gives the exact answer for tests.

Nulls: vectors that are null, empty, zero, or hold null or non-finite
components, and rows with a null label, link with nothing. A null id is no
component's name while another id is there. Rows that repeat id and vector are
separate vectors that are linked. An empty table gives no rows. Other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylens.llm.common import small_side, sorted_groups
from delaylens.llm.components import connected_components, local_roots
from delaylens.session import materialize

MIN_COS = 0.98
TREES = 10
LEAF = 256
BLOCK = 1024
MARGIN = 0.16     # of a direction of length sqrt(dimension), on which a random unit vector has deviation 1
DENSE = 0.24
SEED = 20240501
MAX_LEVELS = 40


def _classes(rows: DataFrame) -> DataFrame:
    """One row per distinct usable (label, vector): class number, weight, smallest id."""
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = (rows.where(F.col("label").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0))
              .where(~F.coalesce(bad, F.lit(True))).where(F.exists("v", lambda x: x != 0)))
    return materialize(usable.groupBy("label", "v").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("weight"))
                       .withColumn("cls", F.monotonically_increasing_id()), "vector-classes")


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def _matrix(column: pa.Array) -> np.ndarray:
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1) if n else np.zeros((0, 0))


def _project(classes: DataFrame, trees: int, levels: int) -> DataFrame:
    """(cls, root, tree, p): the projections of each class on the directions of each tree."""
    rows = classes.select("cls", F.concat_ws(":", F.size("v"), F.col("label").cast("string")).alias("root"),
                          F.col("v").cast("array<double>").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions: dict[int, np.ndarray] = {}
        for batch in batches:
            size = pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False)
            for d in np.unique(size):
                part = batch.filter(pa.array(size == d))
                if d not in directions:
                    r = np.random.default_rng([SEED, int(d)]).standard_normal((trees, levels, int(d)))
                    directions[d] = r * np.sqrt(d / (r * r).sum(2, keepdims=True))
                p = np.einsum("nd,tld->ntl", _unit(_matrix(part.column(2))), directions[d]).astype(np.float32)
                n = part.num_rows
                at = pa.array(np.repeat(np.arange(n), trees))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), part.column(1).take(at), pa.array(np.tile(np.arange(trees), n), pa.int32()),
                     pa.array(list(p.reshape(n * trees, levels)), pa.list_(pa.float32()))], ["cls", "root", "tree", "p"])

    return rows.mapInArrow(run, "cls long, root string, tree int, p array<float>")


def _leaves(classes: DataFrame, trees: int, leaf: int, margin: float, dense: float) -> DataFrame:
    """(cls, root, tree, leaf): the leaves each class lies in. Hashes of two leaves may
    be equal within a root (they are compared as one then), roots are kept apart."""
    largest = classes.groupBy("label", F.size("v")).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    levels = 1
    while leaf << (levels - 1) < largest and levels < MAX_LEVELS:
        levels += 1
    levels = min(MAX_LEVELS, levels + levels // 2 + 1)      # unequal splits and spill need a few more
    open_rows = materialize(_project(classes, trees, levels)
                            .withColumn("node", F.concat_ws("/", "root", F.col("tree").cast("string"))), "vector-rows")
    done = []
    cuts = [0.25 + 0.05 * k for k in range(11)]
    for level in range(levels):
        rows = open_rows.withColumn("x", F.element_at("p", level + 1))
        nodes = rows.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("x", cuts, 1000).alias("q"))
        gap = F.transform(F.sequence(F.lit(1), F.lit(10)), lambda k: F.struct(
            (F.element_at("q", k + 1) - F.element_at("q", k)).alias("width"),
            ((F.element_at("q", k + 1) + F.element_at("q", k)) / 2).alias("cut")))
        widest = F.array_max(gap)
        split = nodes.select("tree", F.col("node").alias("of"), F.when(
            (F.col("n") > leaf) & (F.element_at("q", 11) - F.element_at("q", 1) > dense), widest["cut"]).alias("cut"))
        split = small_side(materialize(split, "vector-splits"))
        put = rows.join(split.withColumnRenamed("of", "node"), ["tree", "node"])
        done.append(put.where("cut is null").select("cls", "root", "tree", "node"))
        left, right = F.when(F.col("x") < F.col("cut") + margin, F.lit("0")), F.when(F.col("x") >= F.col("cut") - margin, F.lit("1"))
        sides = F.explode(F.filter(F.array(left, right), lambda s: s.isNotNull()))
        below = put.where("cut is not null").select("cls", "root", "tree", "p", F.col("node").alias("over"), sides.alias("side"))
        open_rows = materialize(below.select("cls", "root", "tree", "p", F.concat("over", "side").alias("node")), "vector-rows")
        if open_rows.isEmpty():
            break
    done.append(open_rows.select("cls", "root", "tree", "node"))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return materialize(out.withColumn("leaf", F.xxhash64("node")).select("cls", "root", "tree", "leaf"), "vector-leaves")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (root, leaf, cell, x, y, cls, tree, block, weight, leaves, v) of one pair of
    blocks: links per class, counted in the first leaf two classes share, and the
    smallest partner."""
    for group in sorted_groups(batches, 3):
        cls, first = np.unique(group["cls"].to_numpy(), return_index=True)
        pick = pa.array(first)
        x, y, block = group["x"][0].as_py(), group["y"][0].as_py(), group["block"].to_numpy()[first]
        tree, leaf = group["tree"][0].as_py(), group["leaf"][0].as_py()
        v = _unit(_matrix(group["v"].combine_chunks().take(pick)))
        weight = group["weight"].to_numpy()[first]
        own = group["leaves"].combine_chunks().take(pick)
        seen = {}      # per tree the leaves before this one of each class, as (row, leaf) pairs
        flat, size = own.flatten(), _lengths(own)
        row = np.repeat(np.arange(len(cls)), size)
        of_tree, of_leaf = flat.field(0).to_numpy(), flat.field(1).to_numpy()
        for t in range(tree + 1):
            now = (of_tree == t) & ((of_leaf < leaf) | (t < tree))
            seen[t] = (row[now], of_leaf[now])
        links = np.zeros(len(cls), np.int64)
        rows_a, rows_b = np.flatnonzero(block == x), np.flatnonzero(block == y)
        near = v[rows_a] @ v[rows_b].T >= MIN_COS - 1e-9
        if x == y:
            near = np.triu(near, 1)
        a, b = np.nonzero(near)
        a, b = rows_a[a], rows_b[b]
        exact = np.einsum("nd,nd->n", v[a], v[b]) >= MIN_COS
        a, b = a[exact], b[exact]
        met = np.zeros(len(a), bool)
        for t in seen:
            met |= _share(a, b, *seen[t], len(cls))
        np.add.at(links, a[~met], weight[b[~met]])
        np.add.at(links, b[~met], weight[a[~met]])
        root = local_roots(len(cls), a, b)
        some = np.flatnonzero((links > 0) | (root != np.arange(len(cls))))
        yield pa.RecordBatch.from_arrays([pa.array(cls[some]), pa.array(links[some]), pa.array(cls[root[some]])], ["cls", "links", "partner"])


def _lengths(lists: pa.Array) -> np.ndarray:
    return np.diff(lists.offsets.to_numpy())


def _share(a: np.ndarray, b: np.ndarray, row: np.ndarray, leaf: np.ndarray, n: int) -> np.ndarray:
    """Whether rows a and b have a leaf of this tree in common."""
    if not len(a) or not len(row):
        return np.zeros(len(a), bool)
    _, code = np.unique(leaf, return_inverse=True)
    order = np.lexsort((code, row))
    row, code = row[order], code[order]
    held = np.unique(row * (code.max() + 1) + code)
    count = np.bincount(row, minlength=n)
    start = np.concatenate([[0], np.cumsum(count)[:-1]])
    out = np.zeros(len(a), bool)
    for k in range(int(count.max())):
        has = count[a] > k
        key = b[has] * (code.max() + 1) + code[start[a[has]] + k]
        out[has] |= held[np.minimum(np.searchsorted(held, key), len(held) - 1)] == key
    return out


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    trees: int = TREES, leaf: int = LEAF, margin: float = MARGIN, dense: float = DENSE,
                    block: int = BLOCK) -> DataFrame:
    """Per row: ``vec_id, n_links, component_id, kept``."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v"))
    classes = _classes(rows)
    in_leaves = _leaves(classes, trees, leaf, margin, dense)
    sizes = in_leaves.groupBy("root", "tree", "leaf").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / F.lit(block)).cast("int")
    own = in_leaves.groupBy("cls").agg(F.collect_list(F.struct("tree", "leaf")).alias("leaves"))
    carried = classes.select("cls", "weight", F.col("v").cast("array<double>").alias("v")).join(own, "cls")
    placed = (in_leaves.join(sizes.withColumn("blocks", blocks), ["root", "tree", "leaf"])
              .withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    cells = (placed.withColumn("other", other).withColumns({"x": F.least("block", "other"), "y": F.greatest("block", "other")})
             .withColumn("cell", F.xxhash64("root", "tree", "leaf", "x", "y"))
             .join(carried, "cls").select("root", "leaf", "cell", "x", "y", "cls", "tree", "block", "weight", "leaves", "v"))
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = materialize(cells.repartition(parts, "root", "leaf", "cell").sortWithinPartitions("root", "leaf", "cell")
                        .mapInArrow(_compare, "cls long, links long, partner long"), "vector-links")
    roots = connected_components(found.select(F.col("cls").alias("a"), F.col("partner").alias("b")), "vector-components")
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    named = classes.join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    result = (named.join(least, "root").join(links, "cls", "left")
              .select("label", "v", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id"))
    return (rows.join(result, ["label", "v"], "left")
            .select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))


def brute_force(ids: list, labels: list, vectors: list, min_cos: float = MIN_COS) -> dict:
    """All links of a small table: id -> (n_links, component_id); ids unique."""
    n = len(ids)
    ok = [x is not None and y is not None and len(y) > 0 and all(z is not None and np.isfinite(z) for z in y) and any(y)
          for x, y in zip(labels, vectors)]
    a, b = [], []
    for i in range(n):
        for j in range(i + 1, n):
            if ok[i] and ok[j] and labels[i] == labels[j] and len(vectors[i]) == len(vectors[j]):
                p, q = (np.array(vectors[k], np.float64) for k in (i, j))
                if p @ q / (np.sqrt(p @ p) * np.sqrt(q @ q)) >= min_cos:
                    a.append(i)
                    b.append(j)
    order = sorted(range(n), key=lambda k: ids[k])
    rank = {k: r for r, k in enumerate(order)}
    root = local_roots(n, np.array([rank[x] for x in a], np.int64), np.array([rank[x] for x in b], np.int64))
    links = np.bincount([*a, *b], minlength=n)
    return {ids[k]: (int(links[k]), ids[order[root[rank[k]]]]) for k in range(n)}


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (
  SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM ok a JOIN ok b
    ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_inner_product(a.e, b.e) / (sqrt(list_inner_product(a.e, a.e)) * sqrt(list_inner_product(b.e, b.e))) >= 0.98),
reach AS (
  SELECT x AS vec_id, x AS other FROM (SELECT DISTINCT x FROM links)
  UNION
  SELECT reach.vec_id, links.y FROM reach JOIN links ON links.x = reach.other),
c AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
n AS (SELECT x AS vec_id, count(*) AS n_links FROM links GROUP BY x)
SELECT v.vec_id, CAST(coalesce(n.n_links, 0) AS BIGINT) AS n_links, coalesce(c.component_id, v.vec_id) AS component_id,
       coalesce(c.component_id, v.vec_id) = v.vec_id AS kept
FROM v LEFT JOIN c USING (vec_id) LEFT JOIN n USING (vec_id)
"""
