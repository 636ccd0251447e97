"""Registered queries of the corpus operators, with their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from delaylens.llm import byte_bpe, collocations, conversation_repair, exact_dedup, mixing, ngram_join, quality, rp_forest, token_count, token_ids, topk_search, url_filter, warc
from delaylens.sources.tables import table_path

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


@query("op1_source_mix", mixing.ORACLE)
def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to source weights 5, 2, 1 (repeating), at most 3 epochs of a source."""
    return mixing.mix(table(spark, sf_dir, "documents"), cycle=(5, 2, 1), max_epochs=3, share=1.0)


@query("op2_embedding_neardup", rp_forest.ORACLE)
def op2_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors linked within their label at cosine 0.98 by a random-projection forest."""
    return rp_forest.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op3_warc", warc.ORACLE)
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back from the archives."""
    return warc.read_warc(warc.write_warc(table(spark, sf_dir, "pages"), min_bytes=0))


#: (verdict, rule) of the query
URL_RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"),
             ("block", "net/fr/"))


@query("op4_url_filter")
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by the rules, else by boosted trees trained on the urls that the rules label."""
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


@query("op5_token_ids")
def op5_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token files with Elias-Fano boundaries, read back from the files."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_ids.read_token_ids(token_ids.write_token_ids(table(spark, sf_dir, "documents"), path, end_id=0))


@query("op6_exact_dedup", """
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256
FROM d JOIN g USING (norm)
""")
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents grouped by equal normalised text."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


@query("op7_byte_bpe")
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document encoded by the ranks and decoded again."""
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                               public_tokenizers.PATTERN)


@query("op8_ngram_join", ngram_join.ORACLE)
def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents linked by five-word shingles at Jaccard 0.75."""
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"))


@query("op9_token_count")
def op9_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole document in the word vocabulary."""
    return token_count.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), limit=2048)


@query("op10_quality")
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compression score of every whole document, learnt from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return quality.quality(docs, quality.fit(docs, table(spark, sf_dir, "labels")), threshold=0.7)


@query("op11_conversation_repair")
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged by the query's rule, repaired by the cheapest edits."""
    rows = table(spark, sf_dir, "conversations")
    return conversation_repair.repair_report(rows, conversation_repair.damage(rows))


@query("op12_topk_search", topk_search.ORACLE)
def op12_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 largest integer inner products of every vector whose id is divisible by 50, over all vectors."""
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), k=5, query_modulo=50, scale=256)


@query("op13_collocations", collocations.ORACLE)
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2,000 best phrases of two or three words in all documents."""
    return collocations.collocations(table(spark, sf_dir, "documents"), support=10, longest=3, inside_pct=50, top=2000)
