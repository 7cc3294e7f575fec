"""A training-data pipeline of five of the operators in corpusloom.llm: each stage reads what the one before it kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm.common import shared_dir, table
from corpusloom.llm.decontaminate import drop_contaminated
from corpusloom.llm.near_dedup import keep_one
from corpusloom.llm.piece_fst import piece_report
from corpusloom.llm.secret_scan import redact_secrets
from corpusloom.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model doesn't reject."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark; n_chars follows the new text."""
    from pyspark.sql import functions as F

    return redact_secrets(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id with its pieces, their counts and digest, and whether they decode to the text."""
    return piece_report(docs, with_pieces=True)


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("decontamination", decontamination), ("secrets", secrets), ("sentencepiece", sentencepiece)]

#: No stage can be written in SQL (Viterbi decoding, dart signatures and shortest paths aren't relational).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over documents; each result is written as Parquet in the shared folder and read again."""
    docs, folder = table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
