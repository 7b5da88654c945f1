"""One query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (byte_bpe, chat_rotation, edit_decontam, html_consensus, jaccard_join, mil_quality,
               phrase_graph, pivot_spelling, simhash_rings, toxicity, url_templates, wavelet_ids,
               weak_quality)
from ..session import scratch_path
from .arrowtext import find_on_workers

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    find_on_workers(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def op8_edit_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item within 5 percent of edits."""
    return edit_decontam.matches(_table(spark, sf_dir, "documents"),
                                 _table(spark, sf_dir, "benchmark"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded bytes of every document."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return byte_bpe.encode_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                   public_tokenizers.PATTERN).drop("text")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; fold 2 of 4 is held out of the fit."""
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def op2_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation from every participant's side; the mask as 'start-end' pairs."""
    turns = _table(spark, sf_dir, "conversations")
    spans = F.transform("mask", lambda m: F.concat_ws("-", m["start"], m["end"]))
    return chat_rotation.rotate(turns).withColumn("mask", F.array_join(spans, " "))


#: The rules that urls are judged by.
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
             ("block", "net/es/"), ("block", "net/fr/")]


def op3_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's url."""
    return url_templates.verdicts(_table(spark, sf_dir, "pages"), URL_RULES)


def op4_html_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_consensus.extract(_table(spark, sf_dir, "pages"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components and numbers of links of documents whose 3-word shingle sets are 0.9 similar."""
    return jaccard_join.jaccard_links(spark, _table(spark, sf_dir, "documents"),
                                      n=3, num=90, den=100)


def op6_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts, posterior quality and verdict of every document."""
    return weak_quality.judge(_table(spark, sf_dir, "documents"))


def op7_wavelet_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every document's ids as wavelet shards, read them back, checksum per document."""
    path = scratch_path(spark, "wavelet_ids")
    wavelet_ids.write_shards(_table(spark, sf_dir, "documents"), path,
                             public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return wavelet_ids.document_checksums(spark, path)


def op10_mil_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; fold 0 of 5 is held out of the fit."""
    docs = _table(spark, sf_dir, "documents")
    return mil_quality.score(docs, mil_quality.fit(docs, _table(spark, sf_dir, "labels")))


def op11_pivot_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants of the words that occur three times or more."""
    return pivot_spelling.spelling_groups(spark, _table(spark, sf_dir, "documents"))


def op12_simhash_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of three-word shingles and the components of those two bits apart."""
    return simhash_rings.near_duplicates(spark, _table(spark, sf_dir, "documents"), n=3, most=2)


def op13_phrase_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of two or three words of each language."""
    return phrase_graph.phrases(_table(spark, sf_dir, "documents"), least=10, top=2000)


QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_chat_rotation": op2_chat_rotation,
    "op3_url_templates": op3_url_templates,
    "op4_html_consensus": op4_html_consensus,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_weak_quality": op6_weak_quality,
    "op7_wavelet_ids": op7_wavelet_ids,
    "op8_edit_decontam": op8_edit_decontam,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_mil_quality": op10_mil_quality,
    "op11_pivot_spelling": op11_pivot_spelling,
    "op12_simhash_rings": op12_simhash_rings,
    "op13_phrase_graph": op13_phrase_graph,
}

#: DuckDB SQL of the queries that SQL can express.
ORACLES: dict[str, str] = {"op2_chat_rotation": chat_rotation.ORACLE,
                           "op13_phrase_graph": phrase_graph.ORACLE}
