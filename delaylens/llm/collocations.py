"""Phrase collocation mining by SON partitioning.

Phrases are one to ``longest`` words of a piece of text; everything is counted per
language. The table is cut into ``shards`` shards (its partitions in turn).

1. Mine: every shard is mined completely, in narrow rows (shard, ``HASH_BITS``-bit hash
   of language and phrase, count) that tasks combine before the shuffle. A phrase is
   locally frequent if its count reaches the support times the shard's share of all
   text. Shares add up to one, so a phrase with the support in the whole table is
   locally frequent in one shard at least. Words and pairs are mined first; a longer
   phrase is mined where both its parts of one word less are in the union below, as no
   phrase is more frequent than its parts.
2. Unite: the union of the locally frequent phrases, less those whose counts over all
   shards, added up, stay below the support, goes into a bitmap of ``2 ** BITS``
   bits, a fixed size whatever the data hold. Equal hashes and bits let more through, never less.
3. Count: the texts are read again; phrases in the bitmap are counted as strings,
   globally and exactly, and those below the support go.

Shards must be fewer than the support, else every phrase is locally frequent; they
are spread over all tasks, so their size bounds no task.

A candidate is a frequent phrase of two words or more. Its cuts are scored in
decimals of 38 digits (counts below 10^15), so scores are exact.

Nulls and edges: a null text counts as empty, a null language as ``und``; empty
texts have no words; repeated rows count as often as they stand; very long texts are
counted in parts. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from delaylens.llm.common import small_batches, text_of
from delaylens.llm.phrase_counts import LONGEST, Counted, Slices
from delaylens.session import materialize

SHARDS = 4
BITS = 26
#: highest bits of a phrase's hash that are shuffled; the others are nought and compress away
HASH_BITS = 48
BATCH = 50_000


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), text_of(text_col).alias("text"))


def _counted(batches: Iterator[pa.RecordBatch]):
    slices = Slices()
    for batch in batches:
        yield from slices.add(batch.column(0).to_pylist(), batch.column(1))
    yield from slices.rest()


def _levels(found: Counted, lang: str, longest: int, known: dict[int, np.ndarray], bits: int):
    """(level, hashes, which are in the union) for each length; lengths without a union have None."""
    alive = None
    for k in range(1, longest + 1):
        level = found.level(k, alive)
        h = found.hashes(lang, level)
        member = None
        if k in known:
            byte, bit = spots(h, bits)
            member = ((known[k][byte] >> bit) & 1).astype(bool)
            alive = found.alive(level, member)
        yield level, h, member


def local_supports(rows: DataFrame, support: int, shards: int) -> list[int]:
    """Per shard the support lowered to its share of all bytes, at least 1 (``rows``: shard, text)."""
    sizes = dict(rows.groupBy("shard").agg(F.sum(F.octet_length("text")).alias("n")).collect())     # one row per shard
    total = sum(sizes.values()) or 1
    return [max(1, math.ceil(support * sizes.get(s, 0) / total)) for s in range(shards)]


def locally_frequent(docs: DataFrame, support: int = 10, shards: int = SHARDS, lengths: Sequence[int] = (1, 2),
                     known: dict[int, bytes] | None = None, text_col: str = "text", lang_col: str = "lang", bits: int = BITS) -> DataFrame:
    """(phrase_hash, n): phrases of the given lengths that a shard holds at its lowered
    support or more, and all shards together (``n``) at the support; ``known`` are the
    unions of shorter ones. Shards are counted side by side, so that their sum needs no
    second shuffle."""
    rows = _texts(docs, text_col, lang_col).withColumn("shard", F.spark_partition_id() % shards)
    needs = local_supports(rows, support, shards)
    unions = known or {}

    def mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = 0
        below = {k: np.frombuffer(b, np.uint8) for k, b in unions.items()}

        def watched():
            nonlocal shard
            for batch in batches:
                if batch.num_rows:
                    shard = batch.column(2)[0].as_py()
                yield batch
        for lang, found in _counted(watched()):
            for level, h, _ in _levels(found, lang, max(lengths), below, bits):
                if level.k not in lengths:
                    continue
                h, n = h[level.counts > 0] & -(1 << 64 - HASH_BITS), level.counts[level.counts > 0]
                for a in range(0, len(h), BATCH):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(h[a:a + BATCH]), shard), pa.int32()), pa.array(h[a:a + BATCH]),
                         pa.array(n[a:a + BATCH], pa.int64())], ["shard", "phrase_hash", "n"])

    own = [f"n{s}" for s in range(shards)]
    counts = (rows.mapInArrow(mine, "shard int, phrase_hash long, n long").groupBy("phrase_hash")
              .agg(*[F.sum(F.when(F.col("shard") == s, F.col("n")).otherwise(0)).alias(c) for s, c in enumerate(own)]))
    local = reduce(or_, (F.col(c) >= need for c, need in zip(own, needs)))
    return counts.where(local).select("phrase_hash", sum((F.col(c) for c in own), F.lit(0)).alias("n")).where(F.col("n") >= support)


def bitmap(hashes: DataFrame, bits: int = BITS) -> bytes:
    """The union of ``phrase_hash`` as a bitmap by the hash's highest bits: ``2 ** bits / 8`` bytes on the driver."""
    spot = F.shiftrightunsigned("phrase_hash", 64 - bits)
    maps = (hashes.select(spot.alias("spot")).groupBy(F.bitmap_bucket_number("spot").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("bits")))
    # buckets count from 1 and hold positions 1 to 32,768; 0 is alone in bucket 0
    out = bytearray((1 << bits) // 8 + 2 * 4096)
    for r in maps.toLocalIterator():
        out[r["bucket"] * 4096:(r["bucket"] + 1) * 4096] = r["bits"]
    return bytes(out)


def spots(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Byte and bit of each hash in ``bitmap``."""
    spot = (h.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)
    bucket, place = np.where(spot > 0, 1 + (spot - 1) // 32768, 0), np.where(spot > 0, (spot - 1) % 32768, 0)
    return bucket * 4096 + place // 8, place % 8


def frequent_phrases(docs: DataFrame, support: int = 10, shards: int = SHARDS, longest: int = LONGEST,
                     text_col: str = "text", lang_col: str = "lang", bits: int = BITS) -> DataFrame:
    """(lang, k, phrase, f) of all phrases with f >= support; k = 0 holds each language's number of words. A written table."""
    with small_batches(docs.sparkSession):
        given = dict(support=support, shards=shards, text_col=text_col, lang_col=lang_col, bits=bits)
        pairs = bitmap(locally_frequent(docs, lengths=(1, 2), **given), bits)
        unions = {1: pairs, 2: pairs}
        for k in range(3, longest + 1):
            unions[k] = bitmap(locally_frequent(docs, lengths=(k,), known=dict(unions), **given), bits)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = {k: np.frombuffer(b, np.uint8) for k, b in unions.items()}
            for lang, found in _counted(batches):
                rows = [(0, pa.array([""], pa.large_utf8()), np.array([found.n_words]))]
                for level, _, member in _levels(found, lang, longest, known, bits):
                    which = np.flatnonzero(member & (level.counts > 0))
                    rows += [(level.k, found.texts(level, w), level.counts[w]) for w in (which[a:a + BATCH] for a in range(0, len(which), BATCH))]
                for k, phrases, n in rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(n), pa.string()), pa.array(np.full(len(n), k), pa.int32()), phrases.cast(pa.string()),
                         pa.array(n, pa.int64())], ["lang", "k", "phrase", "n"])

        counts = (_texts(docs, text_col, lang_col).mapInArrow(count, "lang string, k int, phrase string, n long")
                  .groupBy("lang", "k", "phrase").agg(F.sum("n").alias("f")))
        return materialize(counts.where((F.col("k") == 0) | (F.col("f") >= support)), "phrases")


def collocations(docs: DataFrame, support: int = 10, longest: int = LONGEST, inside_pct: int = 50, top: int = 2000,
                 shards: int = SHARDS, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per language the ``top`` best: ``lang, rank, phrase, a, l, r, n, score``.

    A candidate's score is that of its lowest cut; a candidate goes if it stands
    inside a longer one that has ``inside_pct`` percent of its occurrences or more."""
    if not 2 <= longest <= LONGEST:
        raise ValueError(f"phrases have 2 to {LONGEST} words at most")
    known = frequent_phrases(docs, support, shards, longest, text_col, lang_col)
    words = F.split("phrase", " ", -1)
    join = lambda first, size: F.array_join(F.slice("words", first, size), " ")
    cands = known.where("k > 1").select("lang", "phrase", "k", F.col("f").alias("a"), words.alias("words"))
    cuts = (cands.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
            .select("lang", "phrase", "k", "a", "cut", join(F.lit(1), F.col("cut")).alias("left"),
                    join(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("right")))
    part = known.where("k > 0")
    lefts = part.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    rights = part.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    wide = lambda c: F.col(c).cast("decimal(15,0)")
    scored = (cuts.join(lefts, ["lang", "left"]).join(rights, ["lang", "right"])
              .withColumns({"up": F.lit(1_000_000).cast("decimal(7,0)") * wide("a") * wide("a"), "down": wide("l") * wide("r")})
              .withColumn("score", F.expr("up div down")))
    best = (scored.groupBy("lang", "phrase", "k", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
            .select("lang", "phrase", "k", "a", "best.score", "best.l", "best.r"))
    inner = (cands.where("k > 2").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("k") - 1)))
             .withColumn("first", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)))
             .select("lang", join(F.col("first"), F.col("size")).alias("phrase"), F.col("a").alias("longer"))
             .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    kept = best.join(inner, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < inside_pct * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    totals = known.where("k = 0").select("lang", F.col("f").alias("n"))
    return (ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


ORACLE = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \\t]+'), lambda x: x <> '') AS w FROM pieces),
placed AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
grams AS (
  SELECT lang, 1 AS k, w[i] AS phrase FROM placed
  UNION ALL SELECT lang, 2, w[i] || ' ' || w[i + 1] FROM placed WHERE i + 1 <= len(w)
  UNION ALL SELECT lang, 3, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FROM placed WHERE i + 2 <= len(w)),
counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 10),
totals AS (SELECT lang, count(*) AS n FROM placed GROUP BY lang),
cands AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1),
cuts AS (
  SELECT lang, k, phrase, a, 1 AS cut, w[1] AS lft, CASE WHEN k = 2 THEN w[2] ELSE w[2] || ' ' || w[3] END AS rgt FROM cands
  UNION ALL SELECT lang, k, phrase, a, 2, w[1] || ' ' || w[2], w[3] FROM cands WHERE k = 3),
scored AS (
  SELECT c.*, x.f AS l, y.f AS r,
         CAST((CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.lft JOIN counts y ON y.lang = c.lang AND y.phrase = c.rgt),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS o FROM scored) WHERE o = 1),
inside AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, w[1] || ' ' || w[2] AS phrase, a FROM cands WHERE k = 3
    UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM cands WHERE k = 3) GROUP BY lang, phrase),
kept AS (
  SELECT b.* FROM best b LEFT JOIN inside s ON s.lang = b.lang AND s.phrase = b.phrase
  WHERE s.longer IS NULL OR 100 * s.longer < 50 * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score FROM ranked r JOIN totals t ON t.lang = r.lang WHERE r.rank <= 2000
"""
