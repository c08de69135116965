"""The registered queries of this folder and, where SQL can express one, its SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.collocations import collocations
from palimpsest.llm.embedding_dedup import embedding_dedup
from palimpsest.llm.katz import katz_scores
from palimpsest.llm.minhash import near_duplicates
from palimpsest.llm.mixing import mix
from palimpsest.llm.oracle import ORACLE
from palimpsest.llm.packing import pack, with_checksum
from palimpsest.llm.quality_classifier import quality_scores
from palimpsest.llm.quality_rules import quality_rules
from palimpsest.llm.resampling import resample
from palimpsest.llm.substring_dedup import substring_dedup, with_digest
from palimpsest.llm.suffix_dedup import suffix_dedup
from palimpsest.llm.token_counts import token_counts
from palimpsest.llm.url_filters import Rule, hosts_with_terms, url_filter
from palimpsest.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
__all__ = ["ORACLE", "QUERIES"]


def query(function: Query) -> Query:
    @wraps(function)
    def shipped(spark: SparkSession, directory: str) -> DataFrame:
        ship_package(spark)
        return function(spark, directory)

    QUERIES[function.__name__] = shipped
    return shipped


def _table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


@query
def op1_token_counts(spark: SparkSession, directory: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts(_table(spark, directory, "documents"), path, limit=4096)


@query
def op10_packing(spark: SparkSession, directory: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return with_checksum(pack(_table(spark, directory, "documents"), path, window=1024, end_id=0))


@query
def op6_substring_dedup(spark: SparkSession, directory: str) -> DataFrame:
    return with_digest(substring_dedup(_table(spark, directory, "documents"), size=13))


@query
def op8_suffix_dedup(spark: SparkSession, directory: str) -> DataFrame:
    return with_digest(suffix_dedup(_table(spark, directory, "documents"), size=50))


@query
def op7_embedding_dedup(spark: SparkSession, directory: str) -> DataFrame:
    return embedding_dedup(_table(spark, directory, "embeddings"), threshold=0.98)


@query
def op5_minhash_dedup(spark: SparkSession, directory: str) -> DataFrame:
    return near_duplicates(_table(spark, directory, "documents"), similarity=0.8, shingle=5)


@query
def op2_quality_rules(spark: SparkSession, directory: str) -> DataFrame:
    return quality_rules(_table(spark, directory, "documents"), _table(spark, directory, "labels"))


#: Domains of documents as the labels tell them, and the weights that a mixture should have.
DOMAIN = "CASE WHEN toxic = 1 THEN 'toxic' WHEN quality = 0 THEN 'poor' WHEN quality = 1 THEN 'good' END"
TARGETS = {"good": 0.94, "poor": 0.03, "toxic": 0.03}


@query
def op4_mixing(spark: SparkSession, directory: str) -> DataFrame:
    docs = _table(spark, directory, "documents").select("doc_id", "text")
    labelled = _table(spark, directory, "labels").select("doc_id", F.expr(DOMAIN).alias("domain"))
    rows = mix(docs, labelled, TARGETS, anchor="good")
    return rows.select(
        "doc_id",
        F.col("mix_tokens").alias("n_tokens"),
        *(F.col("mix_posterior")[i].alias(f"p_{name}") for i, name in enumerate(TARGETS)),
        F.col("mix_rate").alias("rate"),
        F.col("mix_copies").alias("copies"),
    )


# The rules, and the terms of which a listed host holds one.
RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)
TERMS = ("ads", "adult", "bets", "casino", "gambling", "malware", "pills", "poker", "porn", "spam", "warez")


@query
def op3_url_filters(spark: SparkSession, directory: str) -> DataFrame:
    pages = _table(spark, directory, "pages").select("page_id", "url")
    return url_filter(pages, hosts_with_terms(pages, TERMS), RULES)


@query
def op9_quality_classifier(spark: SparkSession, directory: str) -> DataFrame:
    return quality_scores(_table(spark, directory, "documents"), _table(spark, directory, "labels"))


@query
def op13_importance_resampling(spark: SparkSession, directory: str) -> DataFrame:
    docs, target = _table(spark, directory, "documents"), _table(spark, directory, "benchmark")
    return resample(docs, target, size=1, buckets=10_000, seed=2024, least_words=20, percent=10)


@query
def op11_katz_scoring(spark: SparkSession, directory: str) -> DataFrame:
    learn = F.crc32(F.col("doc_id").cast("string")) % 5 != 1
    return katz_scores(_table(spark, directory, "documents"), learn, order=2)


@query
def op12_collocations(spark: SparkSession, directory: str) -> DataFrame:
    return collocations(_table(spark, directory, "documents"), longest=3, least=10, percent=50, first=2000)
