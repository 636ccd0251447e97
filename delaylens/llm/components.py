"""Connected components of a graph given by its edges.

Alternating large-star and small-star steps (Kiveris et al., 2014): every node
hands its larger neighbours, then all its neighbours, to the smallest node it
sees, until the edges form stars around the smallest node of each component.
No step makes more edges than it was given. A hub's edges are combined on the
map side where the smallest neighbour is sought; the join that hands it back
is a plain equi-join, whose hot keys adaptive execution splits. Every round
is a written table in the shared folder, so lineage stays short.

Edges with a null end or between a node and itself say nothing and are passed
over; repeated edges count once; no edges give no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylens.session import materialize

MAX_ROUNDS = 60


def _hand_over(pairs: DataFrame) -> DataFrame:
    """(node, other, least): every pair with the smallest node that ``node`` sees, itself included."""
    least = pairs.groupBy("node").agg(F.min("other").alias("least"))
    return pairs.join(least, "node").withColumn("least", F.least("node", "least"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
    return (_hand_over(both).where(F.col("other") > F.col("node"))
            .select(F.col("other").alias("a"), F.col("least").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other"))
    handed = _hand_over(down)
    return (handed.select(F.col("other").alias("a"), F.col("least").alias("b"))
            .unionByName(handed.select(F.col("node").alias("a"), F.col("least").alias("b"))))


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``edges`` (a, b: long) to (node, root), root the smallest node reachable;
    a written table with one row per node that has an edge."""
    clean = lambda e: e.where("a <> b").distinct()
    now = materialize(clean(edges.select("a", "b")), name)
    state = None
    for _ in range(MAX_ROUNDS):
        sums = now.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if (sums["n"], sums["x"]) == state or not sums["n"]:
            break
        state = sums["n"], sums["x"]
        now = materialize(clean(_small_star(clean(_large_star(now)))), name)
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Within a task: for nodes 0 to n - 1 and edges a-b the smallest node reachable."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    return root
