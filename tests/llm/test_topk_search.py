"""Exact top-k search against brute force in Python integers."""

import math
import random

import numpy as np
import pytest

from delaylens.llm import topk_search as S

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, k=5, modulo=50, scale=256):
    whole = []
    for at, (i, v, _) in enumerate(rows):
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole.append((at, i, [math.floor(scale * x) for x in v]))
    out = []
    for at, i, q in whole:
        if i is None or i % modulo:
            continue
        scores = [(-sum(a * b for a, b in zip(q, c)), j is None, j or 0) for other, j, c in whole if other != at]
        out += [(i, rank, None if nameless else j, -s) for rank, (s, nameless, j) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def vectors(seed, n, dim, kind):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dim)) * (rng.exponential(1.0, size=(n, 1)) if kind == "lengths" else 1.0)
    if kind == "directions":
        base = base @ np.diag(np.geomspace(1, 0.01, dim)) @ np.linalg.qr(rng.normal(size=(dim, dim)))[0]
    if kind == "ties":
        base = rng.integers(-1, 2, size=(n, dim)) / 4
    rows = [(i * 5, v.tolist(), 1) for i, v in enumerate(base)]
    random.Random(seed).shuffle(rows)
    return rows


def run(spark, rows, **kw):
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "7 AS block", "8 AS uid", "9 AS rank")
    return sorted((tuple(r) for r in S.top_k(frame, **kw).collect()), key=str)


@pytest.mark.parametrize("kind", ["lengths", "directions", "ties"])
def test_against_brute_force(spark, kind):
    rows = vectors(1, 400, 16, kind)
    assert run(spark, rows, block=32, query_block=8) == plain(rows)


def test_nulls_repeats_and_ragged_vectors(spark):
    rows = vectors(2, 120, 6, "ties")
    rows += [(None, [0.5] * 6, 1), (None, [9.0] * 6, 1), (0, [1.0] * 6, 1), (0, [1.0] * 6, 1), (50, None, 1), (100, [0.1, None], 1),
             (150, [float("nan")] * 6, 1), (200, [float("inf")] * 6, 1), (250, [], 1), (300, [2.0, -3.0], 1), (350, [0.0] * 6, 1),
             (400, [-1.0] * 6, 1)]
    assert run(spark, rows, block=16, query_block=4) == plain(rows)


def test_fewer_than_k_and_empty(spark):
    rows = [(0, [1.0, 2.0], 1), (50, [0.5, 0.25], 1), (7, [-1.0, 0.0], 1)]
    assert run(spark, rows) == plain(rows)
    assert run(spark, []) == [] and run(spark, [(0, [1.0], 1)]) == [] and run(spark, [(1, [1.0], 1), (2, [1.0], 1)]) == []


def test_one_vector_that_a_third_of_the_rows_repeat(spark):
    rows = vectors(3, 300, 8, "directions") + [(1_000_000 + i, [0.75] * 8, 1) for i in range(150)]
    assert run(spark, rows, block=64, query_block=16) == plain(rows)


def test_scores_past_64_bits_raise(spark):
    with pytest.raises(Exception, match="64 bits"):
        run(spark, [(0, [1e12, 1e12], 1), (1, [1e12, 1.0], 1)])


def test_bounds_prune_without_loss():
    """Few exact scores are taken where lengths and directions differ."""
    rng = np.random.default_rng(5)
    ints = np.sort(np.round(rng.normal(size=(4096, 32)) * rng.exponential(60, size=(4096, 1)))[:, :], axis=0).astype(np.int64)
    ints = ints[np.argsort(-(ints ** 2).sum(1))]
    row = {"rows": 4096, "uids": np.arange(4096).tobytes(), "ids": np.arange(4096).tobytes(), "named": np.ones(4096, np.uint8).tobytes(),
           "ints": ints.tobytes()}
    turn = np.linalg.svd(ints.T.astype(float) @ ints)[0]
    block = S.Block(row, 32, turn, [4, 8, 16])
    small = {"rows": 64, "uids": np.arange(64).tobytes(), "ids": np.arange(64).tobytes(), "named": np.ones(64, np.uint8).tobytes(),
             "ints": ints[::64].tobytes()}
    queries = S.Block(small, 32, turn, [4, 8, 16])
    queries.uid = np.full(64, -1)
    taken = []
    queries.dot = lambda q, other, c: taken.append(len(q)) or np.einsum("ij,ij->i", queries.ints[q], other.ints[c])
    best = S.Best(64, 5)
    S.scan(queries, block, best, np.full(64, -np.inf), [4, 8, 16])
    full = queries.ints @ ints.T
    for k in range(64):
        want = sorted((-int(s), False, i, i) for i, s in enumerate(full[k]))[:5]
        assert best.lists[k] == want
    assert sum(taken) < 64 * 4096 / 2
