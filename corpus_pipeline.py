"""The corpus pipeline: documents through five operators, each stage written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hushwire.llm import packing, passages, quality, secrets, simhash
from hushwire.llm.common import keep, ship, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.  Null and empty texts go as the score of an
    empty text says; without a trusted label, all stay; repeated rows share their fate; an empty table
    gives an empty one; extra columns pass through, here and in the stages up to the last."""
    ship(spark)
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return quality.accepted(docs, quality.learn(docs, labels))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every component of near copies: the first by doc_id, of several texts under one
    doc_id the first by hash; of repeated rows one.  Null and empty texts are copies of each other; rows
    without doc_id come last.  An empty table gives an empty one."""
    ship(spark)
    return simhash.thinned(docs)


def passages_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that earlier documents have; those of which nothing is left go.  Null,
    empty and short texts and rows without doc_id stay as they are; of texts that share a doc_id each is
    cut for itself.  An empty table gives an empty one."""
    ship(spark)
    return passages.without_passages(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with secrets masked.  Null texts and texts without secrets stay as they are, repeated rows
    are masked alike, an empty table gives an empty one."""
    return secrets.masked(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in training sequences.  Null and empty texts are
    documents of one id, repeated rows are documents of their own, an empty table gives no pieces."""
    import public_tokenizers

    ship(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality", quality_stage), ("simhash", simhash_stage), ("passages", passages_stage), ("secrets", secrets_stage), ("packing", packing_stage)]
#: Learned scores, fuzzy components and compiled merges have no SQL form; tests hold them to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
