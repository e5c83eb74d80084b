"""Corpus pipeline: the documents table through five operators of ``stationlens.llm``.

Toxic documents go; lines that many documents repeat stay only in the newest; of each group of
near copies one document stays; secrets are masked; the rest is packed into sequences. Every
stage takes (spark, docs, sf_dir); its result is written as Parquet and read again as the next
one's documents. All but the last return the documents' columns.

Cases, in every stage: a null text is the empty one (it is scored, counts as a copy of the other
empty texts, and packs as one end id) and stays null while it is kept; blank and very long texts are
read whole; a row with a null id stays through the stages that compare documents and its lines count
nowhere; rows that repeat an id go or stay together, and equal rows of it are kept once by the n-gram
join; of equally similar documents the least doc_id stays, of repeated lines those of the largest; extra
columns are carried along whatever their names; empty tables give empty results.
"""

from __future__ import annotations

import itertools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlens.llm import line_dedup, ngram_join, packing, secret_scan, toxicity
from stationlens.llm.common import table
from stationlens.session import checkpoint_dir


def _measured(docs: DataFrame) -> DataFrame:
    """The documents with ``n_chars`` of their present texts."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), F.col("n_chars").cast("long")))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"), cut=0.3)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _measured(line_dedup.dedup(docs, min_chars=40, min_docs=5))


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs, threshold=0.8, n=5)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _measured(secret_scan.redact_documents(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1, size=2048)


STAGES = [("toxicity", drop_toxic), ("line_dedup", dedup_lines), ("ngram_join", dedup_documents),
          ("secret_scan", mask_secrets), ("packing", pack)]
#: Learned scores, connected classes and tokenisation are beyond SQL.
ORACLE_SQL = None
_runs = itertools.count()


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what is between two stages lies in the shared checkpoint
    folder."""
    folder = f"{checkpoint_dir(spark)}/corpus-{spark.sparkContext.applicationId}-{next(_runs)}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs.write.mode("overwrite").parquet(f"{folder}/{k}-{name}")
            docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
