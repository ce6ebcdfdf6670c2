"""Registered queries of the subpackage: each applies one operator, with its
production parameters, to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ecoframe.llm import (
    centroids, decontaminate, exact_dedup, html_extract, language, mixing, near_dedup, quality, repeats, token_counts, toxicity, warc,
    whitening,
)
from ecoframe.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(_table(spark, sf_dir, "pages"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, _table(spark, sf_dir, "labels")))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.link_documents(_table(spark, sf_dir, "documents"), width=2)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archive(warc.plan_records(_table(spark, sf_dir, "pages")), path)
    return (warc.read_archive(spark, path, payloads=False)
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return mixing.mix(docs).drop("text", "n_chars")


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(_table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.assign(_table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_report(_table(spark, sf_dir, "embeddings"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten_report(_table(spark, sf_dir, "embeddings"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return language.identify(docs, language.train(docs))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extract": op1_html_extract,
    "op2_quality": op2_quality,
    "op3_near_dedup": op3_near_dedup,
    "op4_warc": op4_warc,
    "op5_decontaminate": op5_decontaminate,
    "op6_mixing": op6_mixing,
    "op7_repeats": op7_repeats,
    "op8_token_counts": op8_token_counts,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_toxicity": op10_toxicity,
    "op11_centroids": op11_centroids,
    "op12_whitening": op12_whitening,
    "op13_language_id": op13_language_id,
}

ORACLE: dict[str, str] = {
    "op4_warc": warc.ORACLE_SQL,
    "op9_exact_dedup": exact_dedup.ORACLE_SQL,
    "op11_centroids": centroids.ORACLE_SQL,
}
