"""Exact dedup and source mixing against plain Python."""

import hashlib
import re
from collections import defaultdict
from fractions import Fraction

import duckdb
import pytest
from pyspark.sql import functions as F

from delaylens.llm import exact_dedup, mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], SCHEMA)


ROWS = [(5, "a  b\tc", "s1"), (3, "a b c", None), (9, " a b c", "s2"), (7, None, "s1"), (8, "", "s1"), (2, "\x0b", "s1"),
        (None, "a b c", "s1"), (None, "only nameless", "s1"), (4, "x" * 200_000, "s2"), (6, "x" * 200_000, "s1"),
        (10, "ü\u00a0ü", "s1"), (11, "ü ü", "s1"), (12, "twice", "s1"), (12, "twice", "s1")]


def test_exact_groups(spark):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = defaultdict(list)
    for i, t, _ in ROWS:
        groups[norm(t)].append(i)
    want = []
    for i, t, _ in ROWS:
        ids = [x for x in groups[norm(t)] if x is not None]
        keep = min(ids) if ids else None
        want.append((i, keep, len(groups[norm(t)]), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    got = [tuple(r) for r in exact_dedup.exact_groups(docs(spark, ROWS)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_drop_exact_copies_keeps_columns_and_one_row(spark):
    frame = docs(spark, ROWS).withColumnRenamed("lang", "content_hash")      # a name the operator would use
    out = exact_dedup.drop_exact_copies(frame)
    assert out.columns == frame.columns
    rows = out.collect()
    assert len(rows) == len({re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t, _ in ROWS})
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(["3", "9", "7", "2", "4", "10", "11", "12", "None"])


def test_exact_empty_table(spark):
    assert exact_dedup.exact_groups(docs(spark, [])).count() == 0
    assert exact_dedup.drop_exact_copies(docs(spark, [])).count() == 0


def test_equal_hashes_of_different_bytes_stay_apart(spark, monkeypatch):
    """With a hash that always collides the byte comparison still parts the texts."""
    monkeypatch.setattr(exact_dedup.F, "md5", lambda c: F.substring(F.lit("00"), 1, 2))
    got = {r["doc_id"]: r["keep_id"] for r in exact_dedup.exact_groups(docs(spark, [(1, "a", "s"), (2, "b", "s"), (3, "a", "s")])).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def water(sizes, weights, epochs):
    """Clamp and reshare until nothing is above its cap."""
    total, clamped = Fraction(sum(sizes.values())), set()
    while True:
        free = [s for s in sizes if s not in clamped]
        left = total - sum(epochs * sizes[s] for s in clamped)
        target = {s: Fraction(epochs * sizes[s]) if s in clamped else left * weights[s] / sum(weights[x] for x in free) for s in sizes}
        over = {s for s in free if target[s] > epochs * sizes[s]}
        if not over:
            return target
        clamped |= over


@pytest.mark.parametrize("sizes", [{"a": 1, "b": 100, "c": 40, "d": 7, None: 2}, {"a": 10, "b": 10}, {"a": 0, "b": 5, "c": 0},
                                   {"a": 1, "b": 1, "c": 1, "d": 5000}])
def test_targets_match_stepwise_clamping(spark, sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    rows = [(k * 1000 + j, "w", s) for k, s in enumerate(names) for j in range(sizes[s])] + [(10 ** 6 + k, None, s) for k, s in enumerate(names)]
    got = mixing.mix(docs(spark, rows).withColumnRenamed("lang", "size")).collect()
    want = water(sizes, weights, 3)
    by_source = {r[0]: s for r in [(i, s) for i, _, s in rows] for s in [r[1]]}
    taken = defaultdict(int)
    for r in got:
        s = by_source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and abs(r["target"] - float(want[s])) < 1e-6 * max(1, float(want[s]))
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - float(want[s])) <= 0.5 + 1e-6      # half a document of one word


def test_mix_reruns_agree_and_rows_repeat(spark):
    rows = [(i, "w " * (i % 50), f"s{i % 7}" if i % 3 else "hot") for i in range(3000)]
    frame = docs(spark, rows)
    once = {(r["doc_id"], r["taken"]) for r in mixing.mix(frame.repartition(5)).collect()}
    again = {(r["doc_id"], r["taken"]) for r in mixing.mix(frame.repartition(2)).collect()}
    assert once == again
    size = {i: len(t.split()) for i, t, _ in rows}
    out = mixing.mixed_documents(frame)
    assert out.columns == frame.columns
    count = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert all(count.get(i, 0) * size[i] == t for i, t in once)


def test_mix_of_nothing(spark):
    assert mixing.mix(docs(spark, [])).count() == 0
    assert [r["taken"] for r in mixing.mix(docs(spark, [(1, None, "a"), (None, "", None)])).collect()] == [0, 0]


def test_mix_matches_sql_with_nulls(spark):
    rows = [(i if i % 11 else None, ("w " * (i % 40)) or None, None if i % 5 == 0 else f"s{i % 4}") for i in range(400)]
    frame = docs(spark, rows)
    documents = frame.toArrow()  # noqa: F841  read by the SQL
    con = duckdb.connect()
    con.register("documents", documents)
    want = con.sql(mixing.ORACLE).fetchall()
    got = [tuple(r) for r in mixing.mix(frame).collect()]
    assert sorted(map(str, got)) == sorted(str((a, b, c, d, e)) for a, b, c, d, e in want)


def test_mix_takes_some_of_repeated_rows(spark):
    """A source of one row repeated, and one of null ids: the target is met to half a document."""
    rows = ([(7, "x y z w v", "a")] * 1000 + [(None, "p q r", "b")] * 700 + [(k, "one two", "c") for k in range(900)]
            + [(9, f"text of repeat {k}", "c") for k in range(300)])
    frame = docs(spark, rows).repartition(6)
    got = mixing.mix(frame).collect()
    assert len(got) == len(rows)
    by_size = {5000: 5, 2100: 3, 3000: 4}
    for size, longest in by_size.items():
        own = [r for r in got if r["source_size"] == size]
        assert own and abs(sum(r["taken"] for r in own) - own[0]["target"]) <= longest / 2 + 1e-6
    out = mixing.mixed_documents(frame)
    assert out.columns == frame.columns
    words = {r["source"]: r["w"] for r in out.groupBy("source").agg(F.sum(mixing.n_words("text")).alias("w")).collect()}
    for source, size in (("a", 5000), ("b", 2100), ("c", 3000)):
        assert words[source] == sum(r["taken"] for r in got if r["source_size"] == size)


def test_mix_of_repeats_matches_sql(spark):
    rows = [(i % 3, "a b c d", "s1") for i in range(500)] + [(None, "w " * (i % 2), None) for i in range(300)] + [(1, "k l", "s2")] * 90
    frame = docs(spark, rows)
    documents = frame.toArrow()  # noqa: F841  read by the SQL
    con = duckdb.connect()
    con.register("documents", documents)
    want = con.sql(mixing.ORACLE).fetchall()
    assert sorted(str(tuple(r)) for r in mixing.mix(frame).collect()) == sorted(map(str, want))
