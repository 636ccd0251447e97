"""Mixing sources to target weights by capped water-filling.

Every source has a size (words of its documents) and a weight. The mix is to
hold ``share`` of all words, dealt to the sources by weight. A source is
clamped at ``max_epochs`` times its size and what it cannot take is reshared
among the others by weight, until none is above its cap. With the sources
ordered by cap / weight the clamped ones are a prefix of that order, so the
water level follows from running sums over the table of sources (one row per
source; that table alone is ordered in one task).

A source's target is then cut into whole repetitions of all its documents and
a rest. The rest takes the documents in the order of a seeded hash until their
words reach it, the last one included if more than half of it fits: taken and
target differ by half a document at most. The cut is found by radix
selection on the hash, three digits and then the exact values, so no task ever
sorts a source's documents and a source with a third of all rows costs one
partial aggregation.

Nulls and ties: a null text has size 0; the null source is a source of its
own, last in order; a null id is a value like others in the hash. Sources without
words have target 0. Rows that repeat id and size share a place. Where the cut
falls among them, as many of them as fit are taken, the first by row number:
radix selection again, this time counting rows. Reruns agree in (id, taken); if
such rows differ in text, which of them ``mixed_documents`` takes follows the
order in which the table is read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaylens.llm.common import WORD, small_side, spare, text_of
from delaylens.session import materialize

HASH_BITS = 60
DIGITS = (50, 40, 30)     # bits below each radix digit: at most 1,024 rows per source and digit
ROW_DIGITS = (52, 41, 30, 19, 8, 0)     # the same for row numbers of 63 bits: at most 2,048


def n_words(column: str) -> Column:
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("long")


def place(id_col: Column, size: Column, seed: int) -> Column:
    """60 bits of a seeded hash: a document's place in its source."""
    key = F.concat_ws(":", F.lit(str(seed)), F.coalesce(id_col.cast("string"), F.lit("null")), size.cast("string"))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long")


def cycled_weights(sources: DataFrame, cycle: Sequence[int]) -> DataFrame:
    """Add ``weight``: the values of ``cycle`` in turn, sources by code point, null last."""
    at = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    return sources.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in cycle]),
                                                     ((at - 1) % len(cycle) + 1).cast("int")))


def water_fill(sources: DataFrame, max_epochs: int = 3, share: float = 1.0) -> DataFrame:
    """``sources`` (source, source_size, weight) with ``target``, ``whole``
    (repetitions of every document) and ``rest`` (words beyond them)."""
    everything = Window.partitionBy()
    by_level = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    cap = F.col("source_size") * F.lit(max_epochs)
    out = (sources.withColumn("cap", cap)
           .withColumn("full_at", F.col("cap") / F.col("weight"))
           .withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share)))
           .withColumn("poured", F.coalesce(F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)),
                                            F.lit(0)))
           .withColumn("thirsty", F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing)))
           .withColumn("level", (F.col("budget") - F.col("poured")) / F.col("thirsty"))
           .withColumn("clamped", F.col("level") >= F.col("full_at"))
           .withColumn("water", F.max(F.when(~F.col("clamped"), F.col("level"))).over(everything))
           .withColumn("target", F.when(F.col("clamped"), F.col("cap").cast("double"))
                       .otherwise(F.col("water") * F.col("weight"))))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    return (out.withColumn("whole", whole.cast("long"))
            .withColumn("rest", F.greatest(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0)))
            .select("source", "source_size", "target", "whole", "rest"))


def _running(words: DataFrame, *order: str) -> DataFrame:
    """Words before each row of a source in the given order."""
    before = Window.partitionBy("source").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return words.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))


def mixing_plan(sized: DataFrame, cycle: Sequence[int] = (5, 2, 1), max_epochs: int = 3,
                share: float = 1.0) -> DataFrame:
    """One row per source: size, target, whole repetitions, and where the rest ends:
    documents before ``(last, last_size)`` in (place, size) are taken once more, and
    of the ``last_rows`` documents there ``last_taken`` are.
    ``sized`` is a written table (source, size, place)."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = materialize(water_fill(cycled_weights(sources, cycle), max_epochs, share), "mix-plan")
    cut = plan.select("source", "rest")
    digit = None
    for below in DIGITS:
        own = F.shiftright("place", below)
        part = _inside(sized, cut, digit)
        words = part.groupBy("source", own.alias("digit"), "rest").agg(F.sum("size").alias("words"))
        cut = materialize(_running(words, "digit")
                          .where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words")))
                          .select("source", "digit", (F.col("rest") - F.col("before")).alias("rest")), "mix-cut")
        digit = own
    words = (_inside(sized, cut, digit).groupBy("source", "place", "size", "digit", "rest")
             .agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows")))
    # a document is taken if its middle lies within the rest
    room = F.floor((F.col("rest") - F.col("before")) / F.col("size") - 0.5) + 1
    taken = F.when(F.col("size") > 0, F.least(F.greatest(room, F.lit(0)), F.col("rows"))).otherwise(
        F.when(F.col("before") <= F.col("rest"), F.col("rows")).otherwise(0)).cast("long")
    end = F.max(F.when(taken > 0, F.struct("place", "size", F.col("rows").alias("rows"), taken.alias("taken"))))
    last = _running(words, "place", "size").groupBy("source").agg(end.alias("end"), F.min("digit").alias("digit"))
    before_digit = F.shiftleft("digit", DIGITS[-1]) - 1
    last = last.select("source", F.coalesce("end.place", before_digit).alias("last"),
                       F.coalesce("end.size", F.lit((1 << 63) - 1)).alias("last_size"),
                       F.col("end.rows").alias("last_rows"), F.col("end.taken").alias("last_taken"))
    a, b = plan.alias("a"), last.alias("b")
    return materialize(a.join(b, F.col("a.source").eqNullSafe(F.col("b.source")), "left")
                       .select("a.*", F.coalesce("b.last", F.lit(-1)).alias("last"), F.coalesce("b.last_size", F.lit(0)).alias("last_size"),
                               F.coalesce("b.last_rows", F.lit(0)).alias("last_rows"),
                               F.coalesce("b.last_taken", F.lit(0)).alias("last_taken")), "mix-last")


def _inside(sized: DataFrame, cut: DataFrame, digit: Column | None) -> DataFrame:
    """Documents of the digit in which their source's rest ends."""
    s, c = sized.alias("s"), small_side(cut).alias("c")
    on = F.col("s.source").eqNullSafe(F.col("c.source"))
    if digit is None:
        return s.join(c, on).select("s.*", "c.rest")
    return s.withColumn("own", digit).join(c, on & (F.col("own") == F.col("c.digit"))).select("s.*", "c.digit", "c.rest")


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), n_words(text_col).alias("size"))
    return materialize(rows.withColumns({"place": place(F.col("doc_id"), F.col("size"), seed),
                                         "row": F.monotonically_increasing_id()}), "mix-sizes")


def _divided(plan: DataFrame) -> DataFrame | None:
    """The sources whose cut falls among rows of one place and size, if there are any."""
    divided = plan.where(F.col("last_taken").between(1, F.col("last_rows") - 1))
    return None if divided.isEmpty() else divided


def _at_the_cut(size: Column, at: Column) -> Column:
    return (at == F.col("p.last")) & (size == F.col("p.last_size"))


def _last_rows(ties: DataFrame, plan: DataFrame) -> DataFrame:
    """(source, last_row): of the written rows ``ties`` (source, row) of each source the
    ``last_taken`` first by row number go up to this one. Row numbers are unique."""
    cut = materialize(plan.select("source", F.col("last_taken").cast("double").alias("rest")), "mix-rows-cut")
    digit = None
    for below in ROW_DIGITS:
        own = F.shiftright("row", below)
        counts = _inside(ties, cut, digit).groupBy("source", own.alias("digit"), "rest").agg(F.count(F.lit(1)).alias("words"))
        cut = materialize(_running(counts, "digit")
                          .where((F.col("before") < F.col("rest")) & (F.col("rest") <= F.col("before") + F.col("words")))
                          .select("source", "digit", (F.col("rest") - F.col("before")).alias("rest")), "mix-rows-cut")
        digit = own
    return cut.select("source", F.col("digit").alias("last_row"))


def _once_more(size: Column, at: Column) -> Column:
    """1 for the rows that the rest takes, rows at a divided cut left out."""
    whole_cut = _at_the_cut(size, at) & (F.col("p.last_taken") == F.col("p.last_rows"))
    before = (at < F.col("p.last")) | ((at == F.col("p.last")) & (size < F.col("p.last_size")))
    return F.when(before | whole_cut, 1).otherwise(0)


def mix(docs: DataFrame, cycle: Sequence[int] = (5, 2, 1), max_epochs: int = 3, share: float = 1.0, seed: int = 7,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per row: ``doc_id, size, source_size, target, taken``."""
    sized = _sized(docs, id_col, text_col, source_col, seed)
    plan = mixing_plan(sized, cycle, max_epochs, share)
    p, same = small_side(plan).alias("p"), F.col("s.source").eqNullSafe(F.col("p.source"))
    size, at = F.col("s.size"), F.col("s.place")
    rows, more = sized.alias("s").join(p, same), _once_more(size, at)
    divided = _divided(plan)
    if divided is not None:
        ties = materialize(sized.alias("s").join(small_side(divided).alias("p"), same & _at_the_cut(size, at)).select("s.source", "s.row"),
                           "mix-ties")
        last = small_side(_last_rows(ties, divided)).alias("l")
        rows = rows.join(last, F.col("s.source").eqNullSafe(F.col("l.source")), "left")
        more = F.when(_at_the_cut(size, at) & F.col("l.last_row").isNotNull(),
                      F.when(F.col("s.row") <= F.col("l.last_row"), 1).otherwise(0)).otherwise(more)
    return rows.select("s.doc_id", "s.size", "p.source_size", "p.target", (size * (F.col("p.whole") + more)).alias("taken"))


def mixed_documents(docs: DataFrame, cycle: Sequence[int] = (5, 2, 1), max_epochs: int = 3, share: float = 1.0,
                    seed: int = 7, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source") -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken (0 to
    ``max_epochs`` times), columns as they are. The texts are not shuffled; rows
    that share the place where a source's cut falls are written once, to number them."""
    plan = mixing_plan(_sized(docs, id_col, text_col, source_col, seed), cycle, max_epochs, share)
    size, at, number, again = spare(docs, "mix_size", "mix_place", "mix_row", "mix_again")
    sized = docs.withColumn(size, n_words(text_col))
    sized = sized.withColumn(at, place(F.col(id_col), F.col(size), seed)).alias("d")
    own = [F.col(f"d.{c}") for c in docs.columns]
    same = F.col(f"d.{source_col}").eqNullSafe(F.col("p.source"))
    p, size_of, at_of = small_side(plan).alias("p"), F.col(f"d.{size}"), F.col(f"d.{at}")

    def repeated(rows: DataFrame, times: Column) -> DataFrame:
        return rows.select(*own, F.explode(F.array_repeat(F.lit(0), times.cast("int"))).alias(again)).drop(again)

    # a divided cut's rows go their whole repetitions here and once more below
    out = repeated(sized.join(p, same), F.col("p.whole") + _once_more(size_of, at_of))
    divided = _divided(plan)
    if divided is None:
        return out
    ties = materialize(sized.join(small_side(divided).alias("p"), same & _at_the_cut(size_of, at_of))
                       .select(*own).withColumn(number, F.monotonically_increasing_id()), "mix-ties")
    last = small_side(_last_rows(ties.select(F.col(source_col).alias("source"), F.col(number).alias("row")), divided)).alias("l")
    first = ties.alias("d").join(last, F.col(f"d.{source_col}").eqNullSafe(F.col("l.source"))
                                 & (F.col(f"d.{number}") <= F.col("l.last_row")))
    return out.unionByName(first.select(*own))


ORACLE = """
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
  FROM documents),
placed AS (
  SELECT *, CAST('0x' || substr(md5('7:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || CAST(size AS VARCHAR)), 1, 15)
                 AS BIGINT) AS place
  FROM sized),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, 3 * source_size AS cap, CAST(3 * source_size AS DOUBLE) / weight AS full_at FROM sources),
poured AS (
  SELECT *, CAST((SELECT sum(source_size) FROM sources) AS DOUBLE) AS budget,
         coalesce(CAST(sum(cap) OVER (ORDER BY full_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                       AS DOUBLE), 0) AS poured,
         CAST(sum(weight) OVER (ORDER BY full_at, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
              AS DOUBLE) AS thirsty
  FROM levels),
clamped AS (SELECT *, (budget - poured) / thirsty AS level, (budget - poured) / thirsty >= full_at AS is_full FROM poured),
targets AS (
  SELECT source, source_size, CASE WHEN is_full THEN CAST(cap AS DOUBLE)
         ELSE (SELECT max(level) FROM clamped WHERE NOT is_full) * weight END AS target
  FROM clamped),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM targets),
sums AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY place, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
         AS before
  FROM placed)
SELECT d.doc_id, d.size, p.source_size, p.target,
       CAST(d.size * (p.whole + CASE WHEN CAST(d.before AS DOUBLE) + CAST(d.size AS DOUBLE) / 2
                                          <= greatest(p.target - p.whole * p.source_size, 0) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM sums d
JOIN plan p ON d.source IS NOT DISTINCT FROM p.source
"""
