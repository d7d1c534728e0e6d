"""The corpus pipeline: five stages over `documents`, each written as Parquet and reread by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.decontaminate import without_contaminated
from tidemark.llm.line_dedup import LineParams, without_repeated_lines
from tidemark.llm.mixing import mix_sources
from tidemark.llm.near_dups import without_near_duplicates
from tidemark.llm.toxicity import without_toxic
from tidemark.workspace import Workspace

_left: list[Workspace] = []


def _workspace(spark: SparkSession) -> Workspace:
    """A stage's own folder. The folder of the stage before goes: its result has been written and is reread from there,
    so nothing reads what that stage staged on the way."""
    while _left:
        _left.pop().close()
    _left.append(Workspace(spark))
    return _left[-1]


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the machine rejects go; labels are those of `labels`. A null text is scored like an empty one."""
    return without_toxic(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines, short ones too, go from the texts; every document stays, an emptied one with an empty text."""
    return without_repeated_lines(spark, docs, LineParams(short_copies=True), _workspace(spark))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays; documents without words are in no group and stay."""
    return without_near_duplicates(spark, docs, workspace=_workspace(spark))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of `benchmark` go."""
    _workspace(spark)
    return without_contaminated(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources come to their target weights."""
    return mix_sources(spark, docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

# Fitted weights, MinHash and a regular-expression engine have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    workspace = Workspace(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        before, docs = docs, workspace.stage(stage(spark, docs, sf_dir), name)
        workspace.drop(before)
    return docs
