"""Toxicity by a factorization machine over hashed terms.

A term is a word of letters in lower case, or its first four to seven letters, so
that inflected forms share evidence. The machine adds to the linear weights the
products of factor vectors of the terms that occur together. Terms enter by
presence; hashes have `hash_bits` bits.

It is fitted on at most `fit_rows` labelled rows, those with the smallest hash of
their id. Terms are chosen on these rows by their z-score between the two classes, and in
pairs: of any two whole words that each `pair_share` of the rows hold and as many lack, both enter
if the share of label 1 with both differs from what the shares with either one add up to. So
words enter that say nothing alone. Pairs are counted by matrix products over the rows' presence
bits (fit_rows times the number of such words), which reach the driver and are broadcast; of
the rest only the chosen terms (at most 2 ** hash_bits) and their places in the rows do, and the
fitted weights are broadcast. Prefixes are in no pair: a prefix that two words share changes its
meaning with every word of their languages, which the words themselves tell better.

Empty and null texts have no term and get the score of the intercept. Labels are
the greatest non-null label of an id; of a labelled id with several texts the least one is learnt
from. With no labelled rows every score is 0; with labels of one class it is that class.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.text import folder_remainder, mix, prepare
from tidemark.workspace import Workspace

_LETTERS = re.compile(r"[^\W\d_]+")
_PREFIXES = (4, 5, 6, 7)
_COLUMNS, _ROWS = 256, 1024  # of one step of counting pairs


@dataclass(frozen=True)
class FitParams:
    fit_rows: int = 16_000
    hash_bits: int = 18
    least_rows: int = 3
    least_z: float = 3.5
    pair_share: float = 0.02
    pair_rows: int = 10
    pair_z: float = 6.0
    pair_gain: float = 0.3
    factors: int = 8
    epochs: int = 30
    batch: int = 128
    rate: float = 0.1
    penalty: float = 1e-4
    seed: int = 7
    reject_from: float = 0.3


def hashed_terms(text: str | None, bits: int) -> set[int]:
    words = set(_LETTERS.findall((text or "").lower()))
    terms = words | {f"^{w[:n]}" for w in words for n in _PREFIXES}
    return _hashed(terms, bits)


def hashed_words(text: str | None, bits: int) -> set[int]:
    return _hashed(set(_LETTERS.findall((text or "").lower())), bits)


def _hashed(terms: set[str], bits: int) -> set[int]:
    return {xxhash.xxh32_intdigest(t.encode("utf-8", "surrogatepass")) >> (32 - bits) for t in terms}


class Machine:
    """Weights of the intercept and of the chosen terms; `index` maps a hash to its row."""

    def __init__(self, index: dict[int, int], bias: float, linear: np.ndarray, factors: np.ndarray, bits: int):
        self.index, self.bias, self.linear, self.factors, self.bits = index, bias, linear, factors, bits

    def score(self, text: str | None) -> float:
        rows = [self.index[t] for t in hashed_terms(text, self.bits) if t in self.index]
        rows.sort()
        total = self.bias + self.linear[rows].sum()
        v = self.factors[rows]
        total += 0.5 * float((v.sum(axis=0) ** 2 - (v * v).sum(axis=0)).sum())
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def fit(rows: list[np.ndarray], labels: np.ndarray, terms: list[int], p: FitParams) -> Machine:
    """Minibatch Adagrad on the logistic loss. `terms` ascend; each row holds some of them."""
    index = {t: k for k, t in enumerate(terms)}
    share = float(labels.mean()) if len(labels) else 0.0
    random = np.random.default_rng(p.seed)
    linear, factors = np.zeros(len(terms)), random.normal(0, 0.05, (len(terms), p.factors))
    if share in (0.0, 1.0):
        return Machine(index, 40.0 if share else -40.0, linear, factors * 0, p.hash_bits)
    bias = float(np.log(share / (1 - share)))
    seen_bias, seen_linear, seen_factors = 1e-3, np.full(len(terms), 1e-3), np.full(factors.shape, 1e-3)
    places = [np.searchsorted(terms, row) for row in rows]
    for _ in range(p.epochs):
        order = random.permutation(len(rows))
        for start in range(0, len(order), p.batch):
            chosen = order[start : start + p.batch]
            owner = np.repeat(np.arange(len(chosen)), [len(places[k]) for k in chosen])
            touched, at = np.unique(np.concatenate([places[k] for k in chosen]), return_inverse=True)
            present = np.zeros((len(chosen), len(touched)))  # only the batch's own terms have a column
            present[owner, at] = 1
            v = factors[touched]
            summed = present @ v
            margin = bias + present @ linear[touched] + 0.5 * (summed**2 - present @ v**2).sum(axis=1)
            error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[chosen]) / len(chosen)
            slope = present.T @ error
            push = slope + p.penalty * linear[touched]
            pull = present.T @ (error[:, None] * summed) - slope[:, None] * v + p.penalty * v
            seen_bias += error.sum() ** 2
            bias -= p.rate * error.sum() / np.sqrt(seen_bias)
            seen_linear[touched] += push**2
            linear[touched] -= p.rate * push / np.sqrt(seen_linear[touched])
            seen_factors[touched] += pull**2
            factors[touched] -= p.rate * pull / np.sqrt(seen_factors[touched])
    return Machine(index, bias, linear, factors, p.hash_bits)


def interacting(packed: np.ndarray, toxic: np.ndarray, size: int, first: int, p: FitParams) -> set[int]:
    """Columns that interact, of the pairs of columns `first` to `first` + 255 with all from `first` on.

    `packed` holds `size` presence bits a row. The contrast is the share of label 1 with both terms, less that with
    the one, less that with the other, plus that with neither; each of the four needs `pair_rows` rows, and the
    contrast `pair_z` deviations and `pair_gain`, as with many rows small contrasts are sure ones too.
    """
    width = min(_COLUMNS, size - first)
    with_both = {False: np.zeros((size - first, width), np.float32), True: np.zeros((size - first, width), np.float32)}
    single = {False: np.zeros(size - first, np.float32), True: np.zeros(size - first, np.float32)}
    for k in range(0, len(packed), _ROWS):
        present = np.unpackbits(packed[k : k + _ROWS], axis=1, count=size)[:, first:].astype(np.float32)
        for label in (False, True):
            part = present[toxic[k : k + _ROWS] == label]
            with_both[label] += part.T @ part[:, :width]
            single[label] += part.sum(axis=0)
    rows = {label: np.float32((toxic == label).sum()) for label in (False, True)}
    cells = {}
    for label, both in with_both.items():
        one, other = single[label][:, None], single[label][None, :width]
        cells[label] = both, one - both, other - both, rows[label] - one - other + both
    contrast, spread, enough = 0.0, 0.0, True
    for sign, good, bad in zip((1, -1, -1, 1), cells[False], cells[True]):
        share = (bad + 0.5) / (good + bad + 1)
        contrast, spread = contrast + sign * share, spread + share * (1 - share) / (good + bad + 1)
        enough &= good + bad >= p.pair_rows
    found = np.nonzero(enough & (np.abs(contrast) >= np.maximum(p.pair_gain, p.pair_z * np.sqrt(spread))))
    return {first + int(k) for side in found for k in np.unique(side)}


def _sketch(words: np.ndarray) -> bytes:
    """Least words by three hashes, the same for most near copies."""
    least = [mix(words + np.uint64(k << 32)).min() if len(words) else np.uint64(0) for k in (1, 2, 3)]
    return np.array(least, np.uint64).tobytes()


def _paired(spark: SparkSession, rows: DataFrame, total: int, p: FitParams) -> set[int]:
    """Words of pairs that interact. Rows with the same three least hashed words and label count once, because in copies
    of one text all of its words go together."""
    counts = rows.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    usual = F.least(F.col("n"), total - F.col("n")) >= max(p.pair_share * total, p.pair_rows)
    common = np.array(sorted(r[0] for r in counts.where(usual).select("word").collect()), np.int64)
    if len(common) < 2:
        return set()

    @F.pandas_udf("bits binary, sketch binary")
    def presence(lists: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({
            "bits": [np.packbits(np.isin(common, words)).tobytes() for words in lists],
            "sketch": [_sketch(np.asarray(words, np.uint64)) for words in lists]})

    found = rows.select("toxic", presence("words").alias("p")).groupBy("p.sketch", "toxic").agg(
        F.min("p.bits").alias("bits")).toPandas()
    packed = np.frombuffer(b"".join(found["bits"]), np.uint8).reshape(len(found), -1)
    shared = spark.sparkContext.broadcast((packed, found["toxic"].to_numpy() == 1))

    def screen(batches):
        for batch in batches:
            for first in batch["id"]:
                yield pd.DataFrame({"at": sorted(interacting(*shared.value, len(common), int(first), p))}, dtype="int64")

    steps = -(-len(common) // _COLUMNS)
    hits = spark.range(0, len(common), _COLUMNS, steps).mapInPandas(screen, "at long").distinct().collect()
    shared.destroy()
    return {int(common[r[0]]) for r in hits}


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, p: FitParams = FitParams()) -> Machine:
    """Fit on labelled rows of `docs` (doc_id, text) and `labels` (doc_id, toxic)."""
    prepare(spark)
    workspace = Workspace(spark)
    marked = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic")
    )
    ids = marked.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    order = F.xxhash64("doc_id", F.lit(p.seed))
    chosen = workspace.stage(ids.orderBy(order, "doc_id").limit(p.fit_rows), "fit_ids")
    bits = p.hash_bits

    @F.pandas_udf("terms array<int>, words array<int>")
    def terms_of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({
            "terms": [sorted(hashed_terms(t, bits)) for t in texts], "words": [sorted(hashed_words(t, bits)) for t in texts]})

    # At most fit_rows ids of a few bytes: bounded by the parameter.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(
        F.min("text").alias("text"))
    rows = workspace.stage(rows.select("doc_id", "toxic", terms_of("text").alias("t")).select("doc_id", "toxic", "t.*"), "fit_rows")
    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    counts = rows.select("toxic", F.explode("terms").alias("term")).groupBy("term").agg(
        F.sum("toxic").alias("bad"), F.count("*").alias("n")
    )
    gap = F.abs(F.col("bad") / max(bad, 1) - (F.col("n") - F.col("bad")) / max(good, 1))
    pooled = (F.col("n") + 1) / (bad + good + 2)
    spread = F.sqrt(pooled * (1 - pooled) * (1 / max(bad, 1) + 1 / max(good, 1)))
    picked = counts.where(F.col("n") >= p.least_rows).where(gap >= p.least_z * spread).select("term")
    terms = sorted({r[0] for r in picked.collect()} | (_paired(spark, rows, bad + good, p) if bad and good else set()))
    known = np.array(terms, np.int64)

    @F.pandas_udf("binary")
    def known_of(lists: pd.Series) -> pd.Series:
        return pd.Series([np.intersect1d(t, known).astype(np.int32).tobytes() for t in lists], dtype=object)

    data = rows.select("doc_id", "toxic", known_of("terms").alias("terms")).orderBy("doc_id").toPandas()
    workspace.close()
    return fit([np.frombuffer(t, np.int32) for t in data["terms"]], data["toxic"].to_numpy(float), terms, p)


def score_column(spark: SparkSession, machine: Machine):
    shared = spark.sparkContext.broadcast(machine)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.score(t) for t in texts], dtype=float)

    return score("text")


def toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame, p: FitParams = FitParams()) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted. Learns from ids whose remainder by 4 is not 2."""
    prepare(spark)
    learn = folder_remainder(F.col("doc_id"), 4) != 2
    machine = train(spark, docs.where(learn), labels.where(learn), p)
    held_out = F.coalesce(~learn, F.lit(False)).alias("held_out")
    scored = docs.select("doc_id", held_out, score_column(spark, machine).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= p.reject_from).cast("int"))


def without_toxic(spark: SparkSession, docs: DataFrame, labels: DataFrame, p: FitParams = FitParams()) -> DataFrame:
    """The documents whose score stays below the limit; learns from all labelled documents."""
    machine = train(spark, docs.select("doc_id", "text"), labels, p)
    return docs.where(score_column(spark, machine) < p.reject_from)
