"""From raw documents to training tokens, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written
as Parquet in the shared folder and read again as the next stage's ``docs``, so a
lost executor never costs more than one stage.  All but the last keep the columns
of ``documents``.

Defined results: a null, empty or blank text has too few words and goes in the first stage.  Rows are told
apart by id and text, so rows of one id, or of none, stay unless their texts are alike; of rows that agree in both, and of
a group of near copies, one stays (the least id, then the least hash of its text; a null id after others).  Shares equal to a
threshold are as their stage defines them.  Very long texts are read whole in every stage.  An empty table gives no rows in each
stage.  Columns other than ``doc_id`` and ``text`` are carried as they are up to the last stage, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontamination, near_dedup, quality_rules, secret_scan, sentencepiece_scan
from tidemark.session import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a quality rule go."""
    return quality_rules.apply_policy(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the least id."""
    return near_dedup.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold too much of the benchmark go."""
    return decontamination.remove_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mask; the documents stay."""
    return secret_scan.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every text becomes its SentencePiece ids, decoded again to verify them."""
    return sentencepiece_scan.encode(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("secrets", secrets),
    ("sentencepiece", tokens),
]

#: The trained forest of the secrets stage and the ids of the last have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
