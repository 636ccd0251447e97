"""Exact deduplication: group by a 128-bit content hash, compare the bytes
inside the groups, keep the smallest id.

Two texts are equal when they are identical after every run of blanks is
replaced by one space; a null text counts as empty.

One narrow pass writes every row's id, hash and SHA-256; texts stay behind. Rows
are counted by hash, and only texts whose hash occurs twice travel: they are grouped
by (hash, normalised text), whole keys compared byte by byte, so two texts whose
hashes collide stay apart. Copies are combined before the shuffle (one row per
text and map task), so a text that a third of all rows share is no hot group. The
groups of two and more come back to the rows by two narrow digests, broadcast
where a count shows them to be few (``SMALL_GROUPS``), else by a shuffle join.

Nulls and ties: a null id is larger than any other; a group without any id
has a null ``keep_id``. Rows that repeat both id and text are one document
for ``exact_groups`` (they share its verdict); ``drop_exact_copies`` leaves
one of them. An empty table gives an empty result. Other columns are ignored
by ``exact_groups`` and carried along by ``drop_exact_copies``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaylens.llm.common import GAP, small_side, spare, text_of
from delaylens.session import materialize

#: repeated hashes (16 bytes) and groups (64 bytes) up to which they are broadcast
SMALL_GROUPS = 100_000


def normalised(column: str) -> Column:
    return F.regexp_replace(text_of(column), GAP, " ")


def _narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A written table: id, hash and sha of every row."""
    rows = docs.select(F.col(id_col).alias("id"), normalised(text_col).alias("norm"))
    return materialize(rows.select("id", F.unhex(F.md5("norm")).alias("hash"), F.unhex(F.sha2("norm", 256)).alias("sha")),
                       "exact-digests")


def _groups(docs: DataFrame, narrow: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """One row per text that two rows or more hold: hash, sha, keep_id, group_size. A written table."""
    again = materialize(narrow.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash"), "exact-repeated")
    rows = (docs.select(F.col(id_col).alias("id"), normalised(text_col).alias("norm"))
            .withColumn("hash", F.unhex(F.md5("norm"))))
    same = (rows.join(small_side(again, SMALL_GROUPS), "hash", "left_semi").groupBy("hash", "norm")
            .agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")).where("group_size > 1"))
    return materialize(same.select("hash", F.unhex(F.sha2("norm", 256)).alias("sha"), "keep_id", "group_size"), "exact-groups")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    narrow = _narrow(docs, id_col, text_col)
    groups = small_side(_groups(docs, narrow, text_col, id_col), SMALL_GROUPS)
    keep = F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    return (narrow.join(groups, ["hash", "sha"], "left")
            .select(F.col("id").alias("doc_id"), keep.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                    F.col("id").eqNullSafe(keep).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256")))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row per distinct text, that of the smallest id; all
    columns stay as they are. Of rows that repeat the kept id and its text one
    stays; only such rows are shuffled."""
    narrow = _narrow(docs, id_col, text_col)
    groups = _groups(docs, narrow, text_col, id_col)
    at, keep, twice, h, s = spare(docs, "group_hash", "group_keep", "group_twice", "content_hash", "content_sha")
    kept_rows = (narrow.alias("r").join(small_side(groups, SMALL_GROUPS).alias("g"),
                                        (F.col("r.hash") == F.col("g.hash")) & (F.col("r.sha") == F.col("g.sha"))
                                        & F.col("r.id").eqNullSafe(F.col("g.keep_id")))
                 .groupBy("g.hash", "g.sha").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    marks = materialize(groups.join(kept_rows, ["hash", "sha"], "left")
                        .select(F.col("hash").alias(at), F.col("sha").alias("mark_sha"), F.col("keep_id").alias(keep),
                                F.col("n").isNotNull().alias(twice)), "exact-marks")
    norm = normalised(text_col)
    rows = docs.withColumns({h: F.unhex(F.md5(norm)), s: F.unhex(F.sha2(norm, 256))}).alias("r")
    m = small_side(marks, SMALL_GROUPS).alias("m")
    left = (rows.join(m, (F.col(f"r.{h}") == F.col(f"m.{at}")) & (F.col(f"r.{s}") == F.col("m.mark_sha")), "left")
            .where(F.col(f"m.{at}").isNull() | F.col(f"r.{id_col}").eqNullSafe(F.col(f"m.{keep}"))))
    names = [F.col(f"r.{c}") for c in docs.columns]
    if marks.where(F.col(twice)).isEmpty():
        return left.select(*names)
    once = left.where(~F.coalesce(F.col(f"m.{twice}"), F.lit(False))).select(*names)
    more = left.where(F.col(f"m.{twice}")).select(*names, F.col(f"r.{h}").alias(h), F.col(f"r.{s}").alias(s)).dropDuplicates([h, s, id_col])
    return once.unionByName(more.drop(h, s))
