"""From raw documents to packed training sequences, stage by stage.

Each stage is a function (spark, docs, sf_dir) -> DataFrame over all rows that its predecessor
kept. :func:`run` writes every stage's result as Parquet to the shared scratch folder and
reads it again, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from basalt.llm import langid, toxicity
from basalt.llm.exact_dedup import drop_exact_copies
from basalt.llm.near_dedup import drop_near_copies
from basalt.llm.packing import pack
from basalt.llm.queries import bpe_path, language_model, toxicity_model
from basalt.session import scratch_path
from basalt.sources.tables import read_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar scores below 0.5."""
    return toxicity.drop_toxic(docs, toxicity_model(docs, read_table(spark, sf_dir, "labels")))


def drop_unidentified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is as certain as that of nearly all learned ones (see ``langid``)."""
    return langid.drop_unidentified(docs, language_model(docs))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, white space aside."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at a similarity of 0.8 or more on five-word shingles."""
    return drop_near_copies(docs, words=5, percent=80)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boundary records of the kept documents in sequences of 1024 ids."""
    return pack(docs, bpe_path(), window=1024, end_id=0)


STAGES = [
    ("toxicity", drop_toxic),
    ("language id", drop_unidentified),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("packing", packing),
]

# Fitted models, MinHash and tokenisation are not expressible in SQL; tests/llm holds the
# stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the rows of the last stage."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
