"""A corpus from raw documents to packed sequences, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that the one before kept. All
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barloom.llm import langid, packing, secret_scan, simhash, toxicity
from barloom.llm.common import store, table
from barloom.llm.queries import LANGUAGE_FOLDS, PATTERN, TOXIC_FOLDS, VOCABULARY
from barloom.schema import configure


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic; learned from their labels."""
    configure(spark)
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"), *TOXIC_FOLDS)
    return toxicity.drop_toxic(docs, model)


def drop_unidentified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a margin."""
    configure(spark)
    return langid.drop_unidentified(docs, langid.fit_languages(docs, *LANGUAGE_FOLDS))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    configure(spark)
    return simhash.drop_near_duplicates(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced."""
    configure(spark)
    return secret_scan.redact_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences."""
    configure(spark)
    return packing.pack_documents(docs, VOCABULARY, PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("language", drop_unidentified),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("packing", pack),
]

#: Fitted models and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again."""
    docs = table(configure(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name, "snappy")
    return STAGES[-1][1](spark, docs, sf_dir)
