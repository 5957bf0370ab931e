"""The corpus pipeline: each stage calls one operator; its result is written and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docframe.llm import decontamination, language, mixing, neardup, sharding
from docframe.llm.common import read
from docframe.llm.queries import text_bytes
from docframe.sources.lineage import shared_folder

SURE = 0.5


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is told with a probability of at least ``SURE``: texts that are
    NULL or without letters go, and so do those that no language fits best. A table without any
    language label teaches nothing; then every text with a letter stays."""
    model = language.fit(docs.where(~language.held_out()))
    told = language.identify(docs, model)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return told.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= SURE)).select(
        *docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each group of near copies."""
    return neardup.near_duplicates(docs).where("kept").select(*docs.columns)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontamination.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or thins out documents so that sources weigh as the square root of their size."""
    return mixing.mix(docs, mixing.rates(docs, size=text_bytes() + 1)).select(*docs.columns)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A uniform shuffle into 24 shards; adds ``shard`` and ``slot``."""
    return sharding.shard(docs, shards=24)


STAGES = [
    ("language", known_language),
    ("near_duplicates", near_copies),
    ("decontamination", benchmark_leaks),
    ("mixing", target_weights),
    ("sharding", shards),
]
ORACLE_SQL = None
"""None: the hashed classifier, LSH and hypergeometric draws have no SQL; tests compare the stages
with brute force."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
