"""Language identification with bit-sliced Bloom filters of byte n-grams.

Each position of one table holds a bit per language. An n-gram of a language sets
that bit at its hash positions; the AND of the words at an n-gram's positions
gives at once all languages whose filters contain it. A language's count of
n-grams found is corrected for the share its filter would find by chance, and the
greatest corrected count decides (ties: the smaller language value). The score is
the share of n-grams found, between 0 and 1.

Counting covers all learnable rows. An n-gram enters a filter if it has at least
`least_share` of all n-grams of the language, which bounds the filter's load; the
table has `slots` positions, so what is broadcast has a fixed size per 64
languages. Texts are lower-cased, ASCII other than letters becomes a space.
A null text, or one without a letter, is `und` with score 0; so is every text if
nothing can be learned. Rows without an id are never learned from.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.text import encoded, folder_remainder, mix, prepare
from tidemark.workspace import Workspace

_KEEP = bytes(c if chr(c).isalpha() or c > 127 else 32 for c in range(256))


@dataclass(frozen=True)
class BloomParams:
    sizes: tuple[int, ...] = (3, 5)
    slots: int = 1 << 20
    hashes: int = 3
    least_share: float = 4e-6


def grams(text: str, sizes: tuple[int, ...]) -> np.ndarray:
    data = np.frombuffer(b" " + encoded(text.lower()).translate(_KEEP) + b" ", np.uint8).astype(np.uint64)
    found = []
    for size in sizes:
        last = len(data) - size + 1
        if last > 0:
            packed = np.full(last, size, np.uint64)
            for k in range(size):
                packed = (packed << np.uint64(8)) | data[k : k + last]
            found.append(packed)
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def positions(keys: np.ndarray, number: int, slots: int) -> np.ndarray:
    return (mix(keys + np.uint64(number * 0x9E3779B9)) % np.uint64(slots)).astype(np.int64)


class Filters:
    def __init__(self, languages: list[str], table: np.ndarray, p: BloomParams):
        self.languages, self.table, self.p = languages, table, p
        load = [
            ((table[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)).mean() for k in range(len(languages))
        ]
        self.chance = np.array(load) ** p.hashes

    def decide(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not text or not any(map(str.isalpha, text)):
            return "und", 0.0
        keys = grams(text, self.p.sizes)
        member = self.table[positions(keys, 0, self.p.slots)]
        for number in range(1, self.p.hashes):
            member &= self.table[positions(keys, number, self.p.slots)]
        hits = np.array([
            np.count_nonzero(member[:, k // 64] & np.uint64(1 << (k % 64))) for k in range(len(self.languages))
        ])
        share = hits / max(1, len(keys))
        corrected = np.clip((share - self.chance) / np.maximum(1 - self.chance, 1e-9), 0, 1)
        best = int(np.argmax(corrected))
        return self.languages[best], float(corrected[best])


def learn(spark: SparkSession, docs: DataFrame, p: BloomParams = BloomParams()) -> Filters:
    """Filters of the rows of `docs` (text, lang); rows without text or lang are left out."""
    prepare(spark)
    sizes, slots, hashes = p.sizes, p.slots, p.hashes

    def count(batches):
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                found, times = np.unique(np.concatenate([grams(t, sizes) for t in texts]), return_counts=True)
                yield pd.DataFrame({"lang": lang, "gram": found.view(np.int64), "n": times.astype(np.int64)})

    known = docs.where("text is not null and lang is not null").select("lang", "text")
    counts = known.mapInPandas(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    workspace = Workspace(spark)
    counts = workspace.stage(counts, "grams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    languages = sorted(r[0] for r in totals.select("lang").collect())
    number = {lang: k for k, lang in enumerate(languages)}
    kept = counts.join(totals, "lang").where(F.col("n") >= p.least_share * F.col("total")).select("lang", "gram")

    def place(batches):
        for batch in batches:
            keys = batch["gram"].to_numpy(np.int64).view(np.uint64)
            bit = batch["lang"].map(number).to_numpy(np.int64)
            mask = (np.uint64(1) << (bit % 64).astype(np.uint64)).view(np.int64)
            for k in range(hashes):
                yield pd.DataFrame({"slot": positions(keys, k, slots), "part": bit // 64, "mask": mask})

    bits = kept.mapInPandas(place, "slot long, part long, mask long").groupBy("slot", "part").agg(
        F.bit_or("mask").alias("mask")
    )
    words = bits.toPandas()  # at most `slots` rows per 64 languages
    workspace.close()
    table = np.zeros((slots, max(1, -(-len(languages) // 64))), np.uint64)
    table[words["slot"].to_numpy(int), words["part"].to_numpy(int)] = words["mask"].to_numpy(np.int64).view(np.uint64)
    return Filters(languages, table, p)


def identify(spark: SparkSession, docs: DataFrame, p: BloomParams = BloomParams()) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score. Learns from ids whose remainder by 3 is not 1."""
    remainder = folder_remainder(F.col("doc_id"), 3)
    filters = learn(spark, docs.where(remainder != 1).select("lang", "text"), p)
    shared = spark.sparkContext.broadcast(filters)

    @F.pandas_udf("lang_pred string, score double")
    def decide(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.decide(t) for t in texts], columns=["lang_pred", "score"])

    held_out = F.coalesce(remainder == 1, F.lit(False)).alias("held_out")
    return docs.select("doc_id", held_out, decide("text").alias("d")).select("doc_id", "held_out", "d.*")
