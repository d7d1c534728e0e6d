"""The registered queries of this folder, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    decontaminate, exact_dedup, language, licences, line_dedup, mixing, near_dups, perplexity, phrases, ranked_search,
    secrets, toxicity, warc,
)
from tidemark.workspace import Workspace


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archived_pages(spark, _read(spark, folder, "pages"))


def op2_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_dups.near_duplicates(spark, _read(spark, folder, "documents"), near_dups.TensorBands(words=2))


def op3_licences(spark: SparkSession, folder: str) -> DataFrame:
    return licences.licences(spark, _read(spark, folder, "documents"))


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    params = line_dedup.LineParams(short_copies=True)
    return line_dedup.line_report(spark, _read(spark, folder, "documents"), params)


def op5_perplexity(spark: SparkSession, folder: str) -> DataFrame:
    return perplexity.quality(spark, _read(spark, folder, "documents"))


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixing_plan(spark, _read(spark, folder, "documents"))


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_passages(spark, _read(spark, folder, "documents"), _read(spark, folder, "benchmark"))


def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    ledger = secrets.Ledger(spark, f"{Workspace(spark).path}/ledger")
    return secrets.secrets(spark, _read(spark, folder, "documents"), ledger)


def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(spark, _read(spark, folder, "documents"))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(spark, _read(spark, folder, "documents"), _read(spark, folder, "labels"))


def op11_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_copies(spark, _read(spark, folder, "documents"))


def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search.search(spark, _read(spark, folder, "documents"), _read(spark, folder, "benchmark"))


def op13_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(spark, _read(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_warc, op2_near_duplicates, op3_licences, op4_line_dedup, op5_perplexity, op6_mixing,
        op7_decontamination, op8_secrets, op9_language, op10_toxicity, op11_exact_dedup, op12_ranked_search, op13_phrases,
    )
}
