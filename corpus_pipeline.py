"""The corpus pipeline: five stages over ``documents``, each on all that the one before it kept."""

from __future__ import annotations

from public_tokenizers import path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltery.catalog.registry import Query
from smeltery.llm.common import prepared
from smeltery.llm.jaccard_join import without_near_duplicates
from smeltery.llm.line_dedup import without_repeated_lines
from smeltery.llm.packing import packed
from smeltery.llm.pii import without_personal_data
from smeltery.llm.toxicity import without_toxic
from smeltery.sources.tables import written


def _measured(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of documents, with the length of the text as it is now."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long")).select(*columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from ``labels`` of documents still here."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of windows that occurred before are cut from the text; every document stays."""
    return _measured(without_repeated_lines(docs), docs.columns)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return without_near_duplicates(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked in the text; every document stays."""
    return _measured(without_personal_data(docs), docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packed(docs, path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("jaccard_join", jaccard_join),
    ("pii", pii),
    ("packing", packing),
]

# Tokens, a fitted classifier and similarity classes are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = prepared(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES: dict[str, Query] = {"pipeline": Query("pipeline", run, ORACLE_SQL)}
