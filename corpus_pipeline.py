"""Stages that turn ``documents`` into encoded training text, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from obsflow.llm import contamination, language, near_duplicates, pieces, secrets
from obsflow.llm.queries import HELD_OUT_LANGUAGE, table
from obsflow.sources.session import scratch_path


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known with probability one half or more."""
    return language.keep_known(docs, language.fit(docs.where(f"NOT ({HELD_OUT_LANGUAGE})")))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one of the least id."""
    return near_duplicates.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items."""
    return contamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their secrets masked, and ``n_chars`` brought up to date."""
    return secrets.mask_secrets(docs).selectExpr(*["CAST(length(text) AS BIGINT) AS n_chars" if c == "n_chars" else f"`{c}`" for c in docs.columns])


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id`` with the pieces of each document."""
    return pieces.encode_checked(docs)


STAGES = [
    ("language_id", known_language),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("encoding", encoded),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every result is stored in the shared folder before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
