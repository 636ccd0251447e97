"""Collocations against plain Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from delaylens.llm import collocations as C
from delaylens.llm import phrase_counts as P

SCHEMA = "doc_id long, text string, lang string"
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
        yield re.findall(r"[^\x20\x09]+", piece)


def plain(rows, support=10, longest=3, pct=50, top=2000):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        for w in pieces(text):
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        cands = {p: a for p, a in counts.items() if len(p) > 1 and a >= support}
        kept = []
        for p, a in cands.items():
            longer = [b for q, b in cands.items() if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if any(100 * b >= pct * a for b in longer):
                continue
            score, cut, left, right = min((10**6 * a * a // (counts[p[:c]] * counts[p[c:]]), c, counts[p[:c]], counts[p[c:]])
                                          for c in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i, ph.decode(), -a, left, right, n[lang], -s) for i, (s, a, ph, left, right) in enumerate(sorted(kept)[:top], 1)]
    return sorted(out)


def texts(seed, n):
    rng = random.Random(seed)
    words = ["New", "york", "city", "ÉTÉ", "été", "of", "the", "a", "b c", "x-y", "Zoo"]
    rows = []
    for i in range(n):
        t = "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", "\v"]) for _ in range(rng.randint(0, 40)))
        rows.append((i % (n - 5) if i else None, rng.choice([t, t, t, None, ""]), rng.choice(["en", "en", "fr", None])))
    return rows


@pytest.mark.parametrize("shards, parts, top", [(1, 1, 2000), (4, 9, 2000), (9, 9, 3)])
def test_against_plain_python(spark, shards, parts, top):
    rows = texts(3, 300)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(parts).selectExpr("*", "1 AS phrase", "2 AS shard", "3 AS k")
    got = sorted(tuple(r) for r in C.collocations(frame, shards=shards, top=top).collect())
    assert got == plain(rows, top=top)


def test_small_bitmap_lets_through_and_loses_nothing(spark):
    rows = texts(4, 200)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(6)
    few = {(r["lang"], r["phrase"]): r["f"] for r in C.frequent_phrases(frame, bits=16).collect()}
    many = {(r["lang"], r["phrase"]): r["f"] for r in C.frequent_phrases(frame, bits=26).collect()}
    assert few == many


def test_every_frequent_phrase_is_frequent_in_a_shard(spark):
    rows = texts(5, 400)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(8)
    found = C.locally_frequent(frame, shards=4).select("phrase_hash").distinct().count()
    everything = C.locally_frequent(frame, support=1, shards=4).select("phrase_hash").distinct().count()
    kept = C.frequent_phrases(frame).where("k in (1, 2)").count()
    assert kept <= found < everything


def test_union_holds_only_what_all_shards_bear_out(spark):
    """A phrase frequent in one shard alone, and below the support in all, is neither counted nor shuffled as text."""
    rows = [(i, "often seen" if i % 2 else "here there", "en") for i in range(80)] + [(900 + i, f"lone{i // 3}", "en") for i in range(90)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    counts = Counter(" ".join(w[i:i + k]) for _, t, _ in rows for w in pieces(t) for k in (1, 2) for i in range(len(w) - k + 1))
    found = sorted(r["n"] for r in C.locally_frequent(frame, support=10, shards=4).collect())
    assert found == sorted(n for n in counts.values() if n >= 10)


def test_long_texts_are_counted_in_parts(monkeypatch):
    rng = random.Random(6)
    text = "".join(rng.choice(["ab", "cd", "é", "f"]) + rng.choice([" ", "  ", ". ", "\n"]) for _ in range(4000)) + "ab cd"
    want = [Counter(tuple(w[i:i + k]) for w in pieces(text) for i in range(len(w) - k + 1)) for k in (1, 2, 3)]
    monkeypatch.setattr(P, "PART", 500)
    got = [Counter(), Counter(), Counter()]
    total = 0
    for part, own in P.parts(text.encode()):
        found = P.Counted(part, own)
        total += found.n_words
        for k in (1, 2, 3):
            level = found.level(k)
            for phrase, n in zip(found.texts(level, np.arange(len(level.distinct))).to_pylist(), level.counts.tolist()):
                got[k - 1][tuple(phrase.split(" "))] += n
    assert [+g for g in got] == want and total == sum(want[0].values())


def test_scores_beyond_64_bits_are_exact(spark):
    a, left, right = 3_000_000_019, 3_000_000_023, 9_000_000_001
    got = spark.createDataFrame([(a, left, right)], "a long, l long, r long").selectExpr(
        "cast(1000000 as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0)) div (cast(l as decimal(15,0)) * cast(r as decimal(15,0))) AS s").first()["s"]
    assert got == 10**6 * a * a // (left * right)


def test_empty_table(spark):
    assert C.collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    assert C.collocations(spark.createDataFrame([(1, None, None), (2, " . ", "en")], SCHEMA)).count() == 0
