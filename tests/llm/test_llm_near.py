"""N-gram join, vector forest, components and quality against brute force."""

import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from delaylens.llm import ngram_join, quality, rp_forest, signature_tree
from delaylens.llm.components import connected_components
from delaylens.llm.shingles import shingle_sets

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset() if not w else frozenset([tuple(w)]) if len(w) < 5 else frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def brute(rows):
    """Component per row: smallest id reachable."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b]:
                shared = len(sets[a] & sets[b])
                if 100 * shared >= 75 * (len(sets[a]) + len(sets[b]) - shared):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    groups = {}
    for k in range(len(rows)):
        groups.setdefault(find(k), []).append(rows[k][0])
    return [(i, len(s), min((x for x in groups[find(k)] if x is not None), default=None)) for k, ((i, _), s) in enumerate(zip(rows, sets))]


def corpus(seed=3, n=60, copies=6):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefg") for _ in range(4))
    passage = [word() for _ in range(40)]
    texts = [None, "", "  ", "one", "ONE", "one two", "a b c d e", "A b c D e", "x " * 300, "x " * 30]
    for _ in range(n):
        w = [word() for _ in range(rnd.randint(5, 200))]
        if rnd.random() < 0.5:
            at = rnd.randint(0, len(w))
            w[at:at] = passage
        texts.append(" ".join(w))
        for _ in range(rnd.randint(0, copies)):
            v = list(w)
            for _ in range(rnd.randint(0, 6)):
                v[rnd.randrange(len(v))] = word()
            texts.append(" ".join(v))
    texts += [" ".join(passage[:30 + k % 8]) for k in range(30)]
    rnd.shuffle(texts)
    return [(i * 3, t) for i, t in enumerate(texts)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, node int, root int")


def check(spark, rows):
    got = [tuple(r) for r in ngram_join.ngram_components(frame(spark, rows).repartition(3)).collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)


def test_ngram_components(spark):
    rows = corpus()
    check(spark, rows + [(None, rows[5][1]), (None, "nameless words that nobody else has"), rows[20]])


def test_small_blocks_and_buckets(spark, monkeypatch):
    """The ways for large buckets, hot slices and large groups give the same components."""
    for name, value in (("BUCKET", 4), ("BLOCK", 8), ("PIVOTS", 2), ("FREQUENT", 30)):
        monkeypatch.setattr(ngram_join, name, value)
    check(spark, corpus(seed=9, n=25, copies=12))


def test_one_group_holds_most_rows(spark):
    rnd = random.Random(1)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(400):
        w = list(base)
        for _ in range(rnd.randint(0, 3)):
            w[rnd.randrange(120)] = f"v{i}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, f"alone {i} " * 3 + " ".join(str(i * 77 + k) for k in range(20))) for i in range(50)]
    check(spark, rows)


def test_star_of_copies_over_slices(spark, monkeypatch):
    """Copies in two slices that only their base links, which lies in one of them where each of its tokens is hot."""
    monkeypatch.setattr(ngram_join, "FREQUENT", 0)
    base = [f"w{k}" for k in range(400)]
    cuts = lambda at: [" ".join(base[:at + k] + base[at + k + 90:]) for k in range(60)]
    near = list(enumerate([*cuts(0), " ".join(base), *cuts(130)]))
    far = [(1000 + i, t) for i, t in enumerate(cuts(250))]
    want = brute(near + far)
    assert {c for *_, c in want} == {0} and {c for *_, c in brute(near[:60] + near[61:] + far)} == {0, 61, 1000}
    monkeypatch.setattr(ngram_join, "SLICE_BYTES", sum(len(t) for _, t in near) + 1)
    docs = frame(spark, near + far).coalesce(1)
    assert sorted(map(tuple, ngram_join.ngram_components(docs).collect())) == sorted(want)


def test_ngram_empty_and_wordless(spark):
    assert ngram_join.ngram_components(frame(spark, [])).count() == 0
    check(spark, [(1, None), (2, ""), (3, " ")])


def test_keep_one_per_group(spark):
    rows = corpus(seed=4, n=15)
    docs = frame(spark, rows).withColumnRenamed("node", "dropped_id")
    out = ngram_join.keep_one_per_group(docs)
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(i for i, _, c in brute(rows) if i == c)


def test_matches_sql(spark):
    rows = corpus(seed=6, n=20)
    con = duckdb.connect()
    con.register("documents", frame(spark, rows).toArrow())
    assert sorted(con.sql(ngram_join.ORACLE).fetchall()) == sorted(brute(rows))


def test_signature_tree_loses_no_pair():
    rnd = np.random.default_rng(2)
    sets = []
    for _ in range(150):
        base = rnd.integers(0, 2 ** 63, rnd.integers(1, 400)).astype(np.uint64)
        sets += [np.unique(base), np.unique(base[: int(len(base) * rnd.uniform(0.6, 1)) + 1])]
    i, j = signature_tree.possible_pairs([signature_tree.bitmap(s) for s in sets], np.array([len(s) for s in sets]))
    possible = {tuple(sorted(p)) for p in zip(i.tolist(), j.tolist())}
    links = {(a, b) for b in range(len(sets)) for a in range(b)
             if 4 * (o := len(np.intersect1d(sets[a], sets[b]))) >= 3 * (len(sets[a]) + len(sets[b]) - o)}
    assert links <= possible and len(possible) < 3 * len(links) + 50


def test_shingle_sets_of_long_texts(monkeypatch):
    import delaylens.llm.shingles as S
    texts = ["A b\tc " * 3000, None, "z" * 30_000 + " y", " ".join(map(str, range(5000)))]
    whole = shingle_sets(texts)
    monkeypatch.setattr(S, "PART", 5000)
    assert all((a == b).all() for a, b in zip(whole, shingle_sets(texts)))
    assert [len(s) for s in whole] == [len(shingles(t)) for t in texts]


def test_components(spark):
    rnd = random.Random(0)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1200)]
    edges += [(5000, k) for k in range(2000, 2500)] + [(7, 7)]
    root = {}

    def find(a):
        while root.setdefault(a, a) != a:
            a = root[a]
        return a
    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame([*edges, (None, 3)], "a long, b long")).collect()}
    assert got == {k: find(k) for a, b in edges if a != b for k in (a, b)}


def vectors(spark, rows):
    return spark.createDataFrame([(i, lab, None if v is None else [None if x is None else float(x) for x in v], 1) for i, lab, v in rows],
                                 "vec_id long, label int, embedding array<float>, cls int")


def planted(n, seed=0, dim=32, hot=0):
    rnd = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        v = rnd.standard_normal(dim)
        rows.append((len(rows), i % 3, v))
        for _ in range(rnd.integers(0, 3)):
            rows.append((len(rows), i % 3, (v + rnd.standard_normal(dim) * rnd.choice([0.01, 0.1, 0.17, 0.2])) * rnd.uniform(0.1, 9)))
    centre = rnd.standard_normal(dim)
    rows += [(len(rows) + k, 1, centre + rnd.standard_normal(dim) * 0.03) for k in range(hot)]
    return [(i, lab, np.float32(v)) for i, lab, v in rows]


def test_vectors_exact_in_one_leaf(spark):
    rows = planted(60) + [(1000, 1, None), (1001, None, [1] * 32), (1002, 1, [0] * 32), (1003, 1, [float("nan")] + [1] * 31),
                          (1004, 1, [None] + [1] * 31), (1005, 1, []), (1006, 1, [float("inf")] + [1] * 31), (1007, 1, [1, 2]), (1008, 1, [2, 4])]
    want = rp_forest.brute_force(*map(list, zip(*rows)))
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in rp_forest.near_duplicates(vectors(spark, rows)).collect()}
    assert got == want


@pytest.mark.parametrize("dim", [32, 768])
def test_vector_forest_recall(spark, dim):
    """Small leaves and blocks, a dense cluster: links found are true, nine tenths are found."""
    rows = planted(300, seed=5, hot=120, dim=dim)
    want = rp_forest.brute_force(*map(list, zip(*rows)))
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in
           rp_forest.near_duplicates(vectors(spark, rows), leaf=24, block=40).collect()}
    assert all(got[k][0] <= want[k][0] for k in want)
    assert sum(g[0] for g in got.values()) >= 0.97 * sum(w[0] for w in want.values())
    assert sum(got[k][1] == want[k][1] for k in want) >= 0.97 * len(want)


def test_repeated_vectors_and_empty(spark):
    v = [0.5, 1.0, -2.0]
    rows = [(5, 1, v), (3, 1, v), (None, 1, v), (4, 2, v), (9, 1, [1.0, 0.0, 0.0])]
    got = sorted((str(r["vec_id"]), r["n_links"], r["component_id"], r["kept"]) for r in rp_forest.near_duplicates(vectors(spark, rows)).collect())
    assert got == [("3", 2, 3, True), ("4", 0, 4, True), ("5", 2, 3, False), ("9", 0, 9, True), ("None", 2, 3, False)]
    assert rp_forest.near_duplicates(vectors(spark, [])).count() == 0


SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return quality.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))


def test_held_out_accuracy(spark, model):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = quality.quality(spark.read.parquet(f"{SF}/documents.parquet"), model).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50 and all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.85 * len(rows)


def test_quality_edges(spark, model):
    rows = [(1, None, "x"), (2, "", "x"), (None, "word " * 50_000, "x"), (4, "same", "x"), (5, "same", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality_score string")
    got = {r["doc_id"]: r["score"] for r in quality.quality(docs, model).collect()}
    assert got[1] == got[2] and got[4] == got[5] and len(got) == 5
    kept = quality.drop_rejected(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == sum(s >= 0.7 for s in got.values())
    assert quality.quality(docs.limit(0), model).count() == 0


def test_held_out_is_by_crc(spark):
    import zlib
    rows = spark.range(50).select("id", quality.is_held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in rows)


def test_words_of_equal_polynomials_stay_apart(spark):
    """The Thue-Morse word and its complement agree in every polynomial hash modulo 2 ** 64."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    other = word.translate(str.maketrans("ab", "ba"))
    one, two = shingle_sets([word, other])
    assert one.tolist() != two.tolist()
    frame = spark.createDataFrame([(1, word), (2, other)], "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in ngram_join.ngram_components(frame).collect()} == {1: 1, 2: 2}


def test_quality_without_labels_or_documents(spark):
    docs = spark.createDataFrame([(1, "some text"), (2, None), (3, "")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    some = spark.createDataFrame([(1, 1), (3, 1)], "doc_id long, quality int")
    for labels, want in ((none, 0.5), (some, 1.0)):
        got = quality.quality(docs, quality.fit(docs, labels)).collect()
        assert [round(r["score"], 6) for r in got] == [want] * 3
    assert quality.quality(docs.limit(0), quality.fit(docs.limit(0), some)).count() == 0


@pytest.mark.parametrize("dim", [16, 64, 2048])
def test_forest_splits_alike_at_any_dimension(spark, dim):
    """Random vectors part into small leaves with bounded spill, and a root of its own for each label."""
    rnd = np.random.default_rng(1)
    rows = [(k, k % 2, np.float32(rnd.standard_normal(dim))) for k in range(2000)]
    classes = rp_forest._classes(vectors(spark, rows).selectExpr("vec_id id", "label", "embedding v"))
    leaves = rp_forest._leaves(classes, 2, 128, rp_forest.MARGIN, rp_forest.DENSE)
    sizes = [r["count"] for r in leaves.groupBy("root", "tree", "leaf").count().collect()]
    assert max(sizes) <= 400 and sum(sizes) <= 4 * 2 * 2000
    assert {r["root"] for r in leaves.select("root").distinct().collect()} == {f"{dim}:0", f"{dim}:1"}
