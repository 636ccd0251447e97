"""URL filter: rules by host and path, gradient-boosted trees for the rest.

A rule ``host/path`` fits its host and every subdomain if the url's path
starts with the rule's path; the longest fitting rule decides. Urls that no
rule fits are judged by boosted trees over lexical features: length, depth,
digit ratio, character entropy, number of parameters and hyphens, and suffix
statistics (the smoothed block rate of the host's last label among the labelled
rows, and how many of them it rests on).

The trees are fitted on distinct labelled urls, ``SAMPLE`` of each label at most
(the first by a hash): a bounded, documented sample. A url that trains gets its
suffix statistics from the other ``FOLDS - 1`` folds of urls only, so that its own
label is never part of its features. ``judge`` takes any labelled
table; without one the urls that rules decide serve as labels. Features, rules
and scoring are built-in expressions and Spark ML; the statistics of all suffixes
are a written table that is joined on (broadcast if a count shows it small),
unknown suffixes get the overall rate.

Nulls and ties: a null url, or one without ``://``, has empty host and path, no
rule, and is judged by its features like any other (the null url as the empty
text). Equal urls get equal verdicts. Of two fitting rules of equal length the
blocking one wins. With labels of one kind only, or none, no trees are fitted:
that kind, or ``allow``, is the verdict. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaylens.llm.common import small_side
from delaylens.session import materialize

SAMPLE = 4000
SMOOTHING = 20.0
FOLDS = 5
TREES, DEPTH = 12, 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = ["length", "host_length", "depth", "labels", "digit_ratio", "entropy", "parameters", "hyphens", "suffix_rate", "suffix_known"]


def host_and_path(url: str) -> tuple[Column, Column]:
    text = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(text, "://")
    after = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise("")
    return (F.translate(F.regexp_extract(after, "^([^/?#]*)", 1), UPPER, LOWER),
            F.regexp_extract(after, "^[^/?#]*([^?#]*)", 1))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule; null if none fits.
    Rules are (verdict, ``host/path``), a parameter; they become one CASE."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: (len(r[1]), r[0] == "block", r[1])):
        of_host, _, of_path = text.partition("/")
        fits = ((host == of_host) | host.endswith("." + of_host)) & path.startswith("/" + of_path)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def lexical(urls: DataFrame, url: str = "url") -> DataFrame:
    """``urls`` (with ``host``, ``path``) and its features; suffix statistics excepted."""
    text = F.coalesce(F.col(url), F.lit(""))
    n = F.greatest(F.length(text), F.lit(1))
    chars = F.array_distinct(F.split(text, ""))
    share = lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / n
    entropy = F.aggregate(F.filter(F.transform(chars, share), lambda p: p > 0), F.lit(0.0),
                          lambda s, p: s - p * F.log2(p))
    return urls.withColumns({
        "length": F.length(text).cast("double"), "host_length": F.length("host").cast("double"),
        "depth": F.regexp_count("path", F.lit("[^/]+")).cast("double"),
        "labels": F.regexp_count("host", F.lit("[^.]+")).cast("double"),
        "digit_ratio": F.regexp_count(text, F.lit("[0-9]")) / n, "entropy": entropy,
        "parameters": F.regexp_count(text, F.lit("[?&][^=&#]+=")).cast("double"),
        "hyphens": F.regexp_count("host", F.lit("-")).cast("double"),
        "suffix": F.substring_index("host", ".", -1)})


def _fold() -> Column:
    return F.pmod(F.xxhash64(F.lit("fold"), F.col("url")), F.lit(FOLDS)).cast("int")


def suffix_counts(rows: DataFrame) -> DataFrame:
    """Per suffix of labelled ``rows`` (url, host, label) the rows and blocked rows of each fold."""
    fold = _fold()
    return (rows.groupBy(F.substring_index("host", ".", -1).alias("known_suffix"))
            .agg(*[F.count_if(fold == k).cast("double").alias(f"n{k}") for k in range(FOLDS)],
                 *[F.sum(F.when(fold == k, F.col("label")).otherwise(0.0)).alias(f"b{k}") for k in range(FOLDS)]))


def _with_suffix(rows: DataFrame, known: DataFrame, rate: float, out_of_fold: bool = False) -> DataFrame:
    """``rows`` with ``suffix_rate`` and ``suffix_known``. ``out_of_fold`` leaves the row's own
    fold out of both and scales the count to all folds."""
    n, b = ([F.coalesce(f"{x}{k}", F.lit(0.0)) for k in range(FOLDS)] for x in "nb")
    if out_of_fold:
        n, b = ([F.when(_fold() == k, 0.0).otherwise(c) for k, c in enumerate(x)] for x in (n, b))
    count = reduce(add, n)
    return (rows.join(small_side(known), F.col("suffix") == F.col("known_suffix"), "left")
            .withColumns({"suffix_rate": (reduce(add, b) + SMOOTHING * rate) / (count + SMOOTHING),
                          "suffix_known": count * (FOLDS / (FOLDS - 1)) if out_of_fold else count})
            .drop("known_suffix", *[f"{x}{k}" for x in "nb" for k in range(FOLDS)]))


class UrlModel:
    """Suffix statistics and boosted trees; ``verdict`` is set where one label is all there was."""

    def __init__(self, suffixes, rate, trees, verdict):
        self.suffixes, self.rate, self.trees, self.verdict = suffixes, rate, trees, verdict

    def judge(self, rows: DataFrame, name: str) -> DataFrame:
        """``rows`` with lexical features, and the column ``name``: allow or block."""
        if self.trees is None:
            return rows.withColumn(name, F.lit(self.verdict))
        rows = _with_suffix(rows, self.suffixes, self.rate)
        vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)
        return self.trees.transform(vectors).withColumn(name, F.when(F.col("prediction") > 0, "block").otherwise("allow"))


def fit(labelled: DataFrame, seed: int = 7) -> UrlModel:
    """``labelled``: url, label (1: block, 0: allow; others are passed over)."""
    rows = labelled.select("url", F.col("label").cast("double").alias("label")).where(F.col("label").isin(0.0, 1.0))
    host, path = host_and_path("url")
    rows = rows.withColumns({"host": host, "path": path})
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return UrlModel(None, 0.0, None, "block" if 1.0 in counts else "allow")
    rate = counts[1.0] / (counts[0.0] + counts[1.0])
    known = materialize(suffix_counts(rows), "url-suffixes")
    place = F.xxhash64("url")
    distinct = rows.groupBy("label", "url", "host", "path").agg(F.lit(1).alias("one")).drop("one")
    picked = [distinct.where(F.col("label") == k).orderBy(place, "url").limit(SAMPLE) for k in (0.0, 1.0)]
    few = _with_suffix(lexical(picked[0].unionByName(picked[1])), known, rate, out_of_fold=True)
    frame = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(few).select("features", "label").coalesce(1).cache()
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=seed, maxBins=32, cacheNodeIds=False).fit(frame)
    frame.unpersist()
    return UrlModel(known, rate, trees, None)


def judge(urls: DataFrame, rules: Sequence[tuple[str, str]], labelled: DataFrame | None = None, id_col: str = "page_id",
          url_col: str = "url") -> DataFrame:
    """Per row: ``page_id, host, path, rule, verdict``."""
    host, path = host_and_path("url")
    rows = urls.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).withColumns({"host": host, "path": path})
    rule, decided = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "decided": decided})
    if labelled is None:
        labelled = rows.where("rule is not null").select("url", (F.col("decided") == "block").cast("int").alias("label"))
    model = fit(labelled)
    return (model.judge(lexical(rows), "judged")
            .select("page_id", "host", "path", "rule", F.coalesce("decided", "judged").alias("verdict")))
