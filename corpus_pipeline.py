"""A training corpus from ``documents``: language, exact and near duplicates, mix, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that the one before has kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from haltwerk.llm.bpe import bpe_digests
from haltwerk.llm.exact import drop_exact_duplicates
from haltwerk.llm.gru import accepted_languages
from haltwerk.llm.jaccard import drop_near_duplicates
from haltwerk.llm.mixing import mixed_documents
from haltwerk.session import work_dir


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts of no language go."""
    return accepted_languages(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays."""
    return drop_exact_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the row with the least doc_id stays."""
    return drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a row for each time the mix reads it."""
    return mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return bpe_digests(docs)


STAGES = [("language", language), ("exact_duplicates", exact_duplicates), ("near_duplicates", near_duplicates), ("mix", mix), ("tokens", tokens)]

#: A trained network and a join of hashed sets are not SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over all of ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = work_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
