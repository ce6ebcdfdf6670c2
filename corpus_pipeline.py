"""Corpus preparation: five stages over `documents`, each one operator of ecoframe.llm.

A stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the docs of the next stage.  All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ecoframe.llm import decontaminate, exact_dedup, mixing, near_dedup, quality
from ecoframe.llm.stages import Stages, owned


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, quality.train(docs, _table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.dedup_rows(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles (similarity 0.8 or more) the smallest doc_id stays."""
    return near_dedup.keep_one(docs, width=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean_rows(docs, _table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens have the target shares of source, language and topic."""
    return mixing.mix(docs).filter("sampled").drop("sampled")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", accept_quality),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("mix", mix_sources),
]

# Signatures, trained scores and alignments have no SQL form; tests/llm compares the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, over the documents of ``sf_dir``.  Tables that an operator leaves go when its stage is written."""
    stages, docs, before = Stages(spark, "pipeline"), _table(spark, sf_dir, "documents"), None
    for name, apply in STAGES:
        with owned():
            docs = stages.write(apply(spark, docs, sf_dir), name)
        if before:
            stages.remove(before)
        before = name
    return docs
