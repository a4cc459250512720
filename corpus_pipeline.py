"""Corpus pipeline: five stages over ``documents``, each an operator of ``salescope.llm``.

Each stage's result is written as Parquet to the session's shared folder and
read again as the next one's documents, so a lost executor never reaches back
over a stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from salescope.llm.common import stored
from salescope.llm.jaccard_join import keep_one
from salescope.llm.language_id import keep_identified
from salescope.llm.packing import pack_documents
from salescope.llm.pii import redact
from salescope.llm.toxicity import keep_clean

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on ``labels``, doesn't reject."""
    return keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified."""
    return keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each component of links."""
    return keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 ids."""
    return pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("language_id", language),
    ("near_duplicates", near_duplicates),
    ("pii", personal_data),
    ("packing", packing),
]
#: The trained and sampled stages can't be written in SQL; tests/llm/test_pipeline.py checks them.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
