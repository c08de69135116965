"""The training-data pipeline over ``documents``, stage by stage.

Each stage takes the documents that its predecessor kept, written as Parquet and read again:
documents that fail the quality rules go; of every group of near duplicates one stays; passages
that an earlier document holds are cut out; documents are repeated or left out so that toxic
ones come to their target weight while the rest keeps its tokens; and the rest is packed.

Nulls, empty texts, repeated rows and empty tables have the results that the operators state.
All stages but the last return the columns they were given, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.minhash import one_of_each
from palimpsest.llm.mixing import mixed_documents
from palimpsest.llm.packing import pack, with_checksum
from palimpsest.llm.quality_rules import keep_good
from palimpsest.llm.suffix_dedup import cut_passages
from palimpsest.session import ship_package, staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

DOMAIN = "CASE WHEN toxic = 1 THEN 'toxic' WHEN toxic = 0 THEN 'clean' END"
TARGETS = {"clean": 0.98, "toxic": 0.02}


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, _labels(spark, sf_dir))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return one_of_each(docs, similarity=0.8, shingle=5)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return cut_passages(docs, size=50)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labelled = _labels(spark, sf_dir).select("doc_id", F.expr(DOMAIN).alias("domain"))
    return mixed_documents(docs, labelled, TARGETS, anchor="clean")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    path = public_tokenizers.path("byte_bpe_50k.json")
    return with_checksum(pack(docs, path, window=1024, end_id=0))


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("passage_dedup", passage_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: Signatures, iterative fits and tokenizers are not SQL; the tests have plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
