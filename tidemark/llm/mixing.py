"""Mixing sources to target weights, in DataFrame functions only.

A source's target is its weight's share of `total_share` of all words, at most
`most_repeats` times its own words; what is above is shared again by weight until
no target is above. With rate = target / words of the source, each document is
emitted floor(rate) times plus once more if a hash of its id and the seed falls
below the fraction, so that reruns agree.

Sources are ordered by code point, null last, and take the weights in turn. A
source without words has rate 0. Documents that repeat an id draw alike; a null id
draws as an id of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.text import n_words, prepare
from tidemark.workspace import Workspace


@dataclass(frozen=True)
class MixParams:
    weights: tuple[float, ...] = (3.0, 1.0, 2.0)
    total_share: float = 1.5
    most_repeats: float = 2.0
    seed: str = "mix-1"


def _ranked(sources: DataFrame, workspace: Workspace) -> DataFrame:
    """Sources with their place in code-point order: ranges are sorted apart and offset by the ranges before."""
    ranged = workspace.stage(
        sources.repartitionByRange(F.col("source").isNull(), "source").withColumn("part", F.spark_partition_id()),
        "ranges",
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = ranged.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("skip"))
    inside = Window.partitionBy("part").orderBy(F.asc_nulls_last("source"))
    return ranged.join(F.broadcast(offsets), "part").withColumn(
        "place", F.col("skip") + F.row_number().over(inside) - 1
    ).drop("part", "skip")


def source_targets(sizes: DataFrame, workspace: Workspace, p: MixParams = MixParams()) -> DataFrame:
    """(source, source_size, target, rate) from rows (source, size)."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = _ranked(totals, workspace)
    weight = F.element_at(F.array(*map(F.lit, p.weights)), (F.col("place") % len(p.weights) + 1).cast("int"))
    ranked = workspace.stage(
        ranked.select("source", "source_size", weight.alias("weight"),
                      (p.most_repeats * F.col("source_size")).alias("most")),
        "weighted",
    )
    whole = ranked.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    words, weights = p.total_share * (whole["words"] or 0), whole["weight"] or 0.0
    level, filled = 0.0, None
    while weights:
        capped = ranked.where(F.col("most") <= level * F.col("weight")).agg(
            F.count("*").alias("n"), F.sum("most").alias("most"), F.sum("weight").alias("weight")
        ).first()
        if capped["n"] == filled or weights - (capped["weight"] or 0.0) <= 0:
            break
        filled = capped["n"]
        level = (words - (capped["most"] or 0.0)) / (weights - (capped["weight"] or 0.0))
    target = F.least(F.col("most"), F.lit(level) * F.col("weight"))
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(F.lit(0.0))
    return workspace.stage(
        ranked.select("source", "source_size", target.alias("target"), rate.alias("rate")), "targets"
    )


def copies(rate: Column, doc_id: Column, seed: str) -> Column:
    """floor(rate), and one more with the probability of the fraction."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":{seed}")).cast("binary"))
    draw = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(1 << 32)
    return F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")


def _planned(spark: SparkSession, docs: DataFrame, p: MixParams) -> DataFrame:
    """Rows (row, size, source_size, target, n_copies); `row` is the document."""
    workspace = Workspace(prepare(spark))
    sized = docs.select(F.struct("*").alias("row"), F.col("source").alias("at"), n_words(F.col("text")).alias("size"))
    targets = source_targets(sized.select(F.col("at").alias("source"), "size"), workspace, p)
    named = targets.withColumnRenamed("source", "of")
    return sized.join(named, sized["at"].eqNullSafe(named["of"]), "left").select(
        "row", "size", "source_size", "target", copies(F.col("rate"), F.col("row.doc_id"), p.seed).alias("n_copies")
    )


def mixing_plan(spark: SparkSession, docs: DataFrame, p: MixParams = MixParams()) -> DataFrame:
    """Per row: doc_id, size, source_size, target, taken."""
    planned = _planned(spark, docs.select("doc_id", "source", "text"), p)
    return planned.select(
        F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target",
        (F.col("n_copies") * F.col("size")).alias("taken"),
    )


def mix_sources(spark: SparkSession, docs: DataFrame, p: MixParams = MixParams()) -> DataFrame:
    """The mixed table: each document as often as it is taken. Documents without words are never taken more
    than their source's rate says."""
    planned = _planned(spark, docs, p).where("n_copies > 0")
    return planned.select("row", F.explode(F.sequence(F.lit(1), F.col("n_copies").cast("int")))).select("row.*")
