"""From raw documents to token ids: five stages, each one operator of ``gigframe.llm``.

Every stage takes the documents that the one before kept, written as Parquet and read
again. All but the last return the columns of ``documents``. Null or empty texts pass the
filters as texts without evidence and are encoded as no ids; rows without a doc_id stay.
"""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gigframe.llm import byte_bpe, edit_decontam, jaccard_join, mil_quality, toxicity
from gigframe.llm.arrowtext import find_on_workers
from gigframe.session import scratch_path

#: Toxicity from which a document goes; quality that a document needs to stay.
TOXIC, GOOD = 0.3, 0.3


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    find_on_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator scores below TOXIC."""
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model, TOXIC)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores at GOOD or above."""
    model = mil_quality.fit(docs, _table(spark, sf_dir, "labels"))
    return mil_quality.keep_good(docs, model, GOOD)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near duplicates (five-word
    shingles, similarity of 0.8 or more)."""
    find_on_workers(spark)
    return jaccard_join.keep_one(spark, docs, n=5, num=4, den=5).select(docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage, up to 5 percent of edits."""
    return edit_decontam.without_leaks(docs, _table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and n_tokens of every document."""
    find_on_workers(spark)
    return byte_bpe.encode_column(
        docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN).drop("text")


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("encode", encode),
]

#: The classifiers and the components of links are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = scratch_path(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        path = os.path.join(base, f"{k}_{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
