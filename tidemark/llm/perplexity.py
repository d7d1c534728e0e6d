"""Quality rules: base counts and word n-gram perplexity bands.

The model is a modified Kneser-Ney trigram model per language over all words of all texts: every word is a token,
every n-gram is kept (`kneser_ney`). Occurrences within the same six words count once, exactly and at any size, so
copies of a text do not train the model. Discounts come from the counts of counts.

`learn` is the same model on the driver for those who bound it: words with less than `word_share` of all words of
their language stand for their shape (letter case, digits, symbols, punctuation, length class), and n-grams with
less than `gram_share` of them are left to the lower order after the statistics are taken.

A text is rejected if the mean log-probability of its words lies outside its
language's band: median +- `width` robust deviations, wider for short texts by
sqrt(1 + `short` / n_words). Medians and quartiles are taken over the texts that
pass the base rules. A null lang is a language of its own; rows with a null or empty text have
no words and fail the base rules. A band without any text rejects nothing.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.kneser_ney import SweepParams, losses, text_digest
from tidemark.llm.text import distinct, encoded, mix, prepare, window_hashes, word_bounds, word_hashes
from tidemark.workspace import Workspace

# What counts as a symbol.
SYMBOLS = b"#*$%&|<>"
_BITS = 21
_LOW = (1 << _BITS) - 1
_SHAPES = 64
_NONE = ""  # stands for a null language inside the model


def _byte_class(test) -> np.ndarray:
    return np.array([test(c) for c in range(256)], bool)


_UPPER = _byte_class(lambda c: 65 <= c <= 90)
_DIGIT = _byte_class(lambda c: 48 <= c <= 57)
_SYMBOL = _byte_class(lambda c: c in SYMBOLS)
_MARK = _byte_class(lambda c: c < 128 and c > 32 and not chr(c).isalnum() and c not in SYMBOLS)


@dataclass(frozen=True)
class PerplexityParams:
    word_share: float = 0.0  # above 0: bounds the model to what can be broadcast, see `learn`
    gram_share: float = 0.0
    width: float = 5.0
    short: float = 100.0
    least_words: int = 10
    most_repeated: int = 20


class Words:
    """The words of one text as hashes, with their bytes' positions."""

    def __init__(self, text: str | None):
        self.data = encoded(text)
        self.raw = np.frombuffer(self.data, np.uint8)
        self.starts, self.ends = word_bounds(self.raw)
        self.hashes = word_hashes(self.raw, self.starts, self.ends)

    def shapes(self) -> np.ndarray:
        """1 to 64 per word."""
        if not len(self.starts):
            return np.empty(0, np.int64)
        counts = [np.add.reduceat(kind[self.raw].astype(np.int64), self.starts) for kind in (_UPPER, _DIGIT, _SYMBOL, _MARK)]
        length = np.searchsorted([5, 9, 17], self.ends - self.starts, "right")
        flags = (counts[0] > 1) + 2 * (counts[1] > 0) + 4 * (counts[2] > 0) + 8 * (counts[3] > 1)
        return 1 + flags * 4 + length


def base_counts(datas: list[bytes]) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text, by 64-bit hashes of words and lines."""
    raw = np.frombuffer(b"\n".join(datas), np.uint8)
    ends = np.cumsum([len(d) + 1 for d in datas])
    of = lambda places: np.diff(np.searchsorted(places, ends), prepend=0)
    starts, stops = word_bounds(raw)
    n_words = of(starts)
    which = np.repeat(np.arange(len(datas)), n_words)
    inside = np.zeros(len(raw) + 1, np.int8)  # 1 on the bytes of words
    inside[starts], inside[stops] = 1, -1
    chars = np.flatnonzero(np.cumsum(inside[:-1], dtype=np.int8).view(bool) & (raw & 0xC0 != 0x80))

    breaks = np.flatnonzero(raw == 10)
    line = np.searchsorted(breaks, starts)
    first = np.flatnonzero(np.diff(line, prepend=-1))  # the first word of each line that has one
    edges = np.concatenate(([0], breaks + 1, [len(raw) + 1]))
    lines = word_hashes(raw, edges[line[first]], edges[line[first] + 1] - 1)
    n_lines = np.bincount(which[first], minlength=len(datas))
    once = distinct(mix(lines + mix(which[first].astype(np.uint64))))[1]
    repeated_lines = n_lines - np.bincount(which[first[once]], minlength=len(datas))

    windows = window_hashes(word_hashes(raw, starts, stops), 5)
    valid = np.flatnonzero(which[4:] == which[:-4]) if len(windows) else np.empty(0, np.int64)
    _, _, key, times = distinct(mix(windows[valid] + mix(which[valid].astype(np.uint64))))
    again = valid[times[key] > 1]
    edge = np.bincount(again, minlength=len(starts) + 5) - np.bincount(again + 5, minlength=len(starts) + 5)
    marked = which[np.cumsum(edge)[: len(starts)] > 0]
    return {"n_words": n_words, "word_chars": of(chars), "n_symbols": of(np.flatnonzero(_SYMBOL[raw])),
            "n_dup_lines": repeated_lines, "n_repeat_words": np.bincount(marked, minlength=len(datas))}


def _contexts(hashes: np.ndarray) -> np.ndarray:
    """Per word a hash of the three words before it, itself and the two behind it."""
    wide = np.concatenate((np.zeros(3, np.uint64), hashes, np.zeros(2, np.uint64)))
    run = np.zeros(len(hashes), np.uint64)
    for k in range(6):
        run = mix(run + wide[k : k + len(hashes)]) * np.uint64(0x9E3779B97F4A7C15)
    return mix(run)


def _occurrences(keys_of):
    """mapInPandas function: language, context hash and key of every word."""

    def list_words(batches):
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                words = Words(text)
                keys, contexts = keys_of(lang, words).view(np.int64), _contexts(words.hashes).view(np.int64)
                for k in range(0, len(keys), 50_000):
                    yield pd.DataFrame({"lang": lang, "context": contexts[k : k + 50_000], "key": keys[k : k + 50_000]})

    return list_words


def _counted(texts: DataFrame, keys_of) -> DataFrame:
    """(lang, key, n) over all texts. Occurrences in the same six words count once, so copies of a text do not
    make its words common: the same rule for every key at every size."""
    rows = texts.mapInPandas(_occurrences(keys_of), "lang string, context long, key long")
    return rows.distinct().groupBy("lang", "key").agg(F.count("*").alias("n"))


def _packed(batches):
    """Model rows as arrays of 12 bytes an entry: what the driver receives is bounded by the shares kept."""
    for batch in batches:
        for (lang, name), part in batch.groupby(["lang", "name"]):
            yield pd.DataFrame({
                "lang": [lang], "name": [name], "keys": [part["key"].to_numpy(np.int64).tobytes()],
                "shares": [part["value"].to_numpy(np.float32).tobytes()]})


class Table:
    """Sorted hashes of keys with a value each."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        hashes = mix(keys.astype(np.uint64))
        order = np.argsort(hashes)
        self.hashes, self.values = hashes[order], values[order].astype(np.float32)

    def __call__(self, keys: np.ndarray, default: float) -> np.ndarray:
        if not len(self.hashes):
            return np.full(len(keys), default)
        hashes = mix(keys.astype(np.uint64))
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.values[at], default)


class Vocabulary:
    """Per language the hashes of its frequent words in ascending order."""

    def __init__(self, words: dict[str, np.ndarray]):
        self.words = words

    def ids(self, lang: str, words: Words) -> np.ndarray:
        """Token ids behind two start tokens of id 0."""
        known = self.words.get(lang)
        ids = words.shapes()
        if known is not None and len(known) and len(ids):
            at = np.minimum(np.searchsorted(known, words.hashes), len(known) - 1)
            ids = np.where(known[at] == words.hashes, at + _SHAPES + 1, ids)
        return np.concatenate((np.zeros(2, np.int64), ids))


def trigrams(ids: np.ndarray) -> np.ndarray:
    return (ids[:-2] << (2 * _BITS)) | (ids[1:-1] << _BITS) | ids[2:]


class Model:
    def __init__(self, vocabulary: Vocabulary, tables: dict[tuple[str, str], Table], kinds: dict[str, int]):
        self.vocabulary, self.tables, self.kinds = vocabulary, tables, kinds
        self.empty = Table(np.empty(0, np.int64), np.empty(0))

    def loss(self, lang: str, words: Words) -> float:
        """Mean negative log-probability of a word."""
        ids = self.vocabulary.ids(lang, words)
        table = lambda name: self.tables.get((lang, name), self.empty)
        three = trigrams(ids)
        two, one = three & ((1 << 2 * _BITS) - 1), ids[2:]
        p = table("p1")(one, 0.0) + table("g1")(one * 0, 1.0) / max(1, self.kinds.get(lang, 1))
        p = table("p2")(two, 0.0) + table("g2")(ids[1:-1], 1.0) * p
        p = table("p3")(three, 0.0) + table("g3")(three >> _BITS, 1.0) * p
        return float(-np.log(np.maximum(p, 1e-12)).mean())


def _discounted(counts: DataFrame) -> DataFrame:
    """Counts (lang, key, context, n, least) with the modified Kneser-Ney discount of each."""
    of = {k: F.sum((F.col("n") == k).cast("long")).alias(f"n{k}") for k in (1, 2, 3, 4)}
    seen = counts.groupBy("lang").agg(*of.values())
    y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))
    bounded = lambda k, up: F.greatest(F.lit(0.0), F.least(F.lit(float(k)), F.coalesce(up, F.lit(0.5 * k))))
    step = lambda k: bounded(k, k - (k + 1) * y * F.col(f"n{k + 1}") / F.when(F.col(f"n{k}") > 0, F.col(f"n{k}")))
    seen = seen.select("lang", step(1).alias("d1"), step(2).alias("d2"), step(3).alias("d3"))
    chosen = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    return counts.join(seen, "lang").select(
        "lang", "key", "context", "n", "least", (F.col("n") - chosen).alias("rest"))


def _order(counts: DataFrame, number: int) -> DataFrame:
    """Model rows (lang, name, key, value): discounted shares p and the mass g left to the lower order."""
    counts = _discounted(counts)
    totals = counts.groupBy("lang", "context").agg(
        F.sum("n").alias("total"), F.sum(F.when(F.col("n") >= F.col("least"), F.col("rest"))).alias("given")
    ).where("given is not null")
    shares = counts.where(F.col("n") >= F.col("least")).join(totals, ["lang", "context"]).select(
        "lang", F.lit(f"p{number}").alias("name"), "key", (F.col("rest") / F.col("total")).alias("value")
    )
    left = totals.select(
        "lang", F.lit(f"g{number}").alias("name"), F.col("context").alias("key"),
        (1 - F.col("given") / F.col("total")).alias("value"),
    )
    return shares.union(left)


def learn(spark: SparkSession, docs: DataFrame, p: PerplexityParams, workspace: Workspace) -> Model:
    """Count the corpus (lang without nulls, text) and build the model."""
    texts = docs.where("text is not null").select("lang", "text")
    words = workspace.stage(_counted(texts, lambda lang, w: w.hashes), "words")
    totals = workspace.stage(words.groupBy("lang").agg(F.sum("n").alias("total")), "totals")
    frequent = words.join(totals, "lang").where(F.col("n") >= p.word_share * F.col("total")).select("lang", "key").toPandas()
    vocabulary = Vocabulary({
        lang: np.sort(part["key"].to_numpy(np.int64).view(np.uint64)) for lang, part in frequent.groupby("lang")
    })
    shared = spark.sparkContext.broadcast(vocabulary)
    grams = _counted(texts, lambda lang, w: trigrams(shared.value.ids(lang, w)).view(np.uint64))
    three = workspace.stage(grams, "trigrams")
    pair = (1 << 2 * _BITS) - 1
    two = workspace.stage(
        three.groupBy("lang", F.col("key").bitwiseAND(F.lit(pair)).alias("key")).agg(F.count("*").alias("n")), "bigrams"
    )
    one = workspace.stage(
        two.groupBy("lang", F.col("key").bitwiseAND(F.lit(_LOW)).alias("key")).agg(F.count("*").alias("n")), "tokens"
    )
    upper = F.shiftright("key", _BITS).alias("context")
    least = totals.select("lang", (p.gram_share * F.col("total")).alias("least"))
    rows = (
        _order(three.join(least, "lang").select("lang", "key", upper, "n", "least"), 3)
        .union(_order(two.join(least, "lang").select("lang", "key", upper, "n", "least"), 2))
        .union(_order(one.select("lang", "key", F.lit(0).cast("long").alias("context"), "n", F.lit(0.0).alias("least")), 1))
        .mapInPandas(_packed, "lang string, name string, keys binary, shares binary")
        .collect()
    )
    parts: dict[tuple[str, str], list] = defaultdict(list)
    for r in rows:
        parts[r["lang"], r["name"]].append((np.frombuffer(r["keys"], np.int64), np.frombuffer(r["shares"], np.float32)))
    tables = {name: Table(*(np.concatenate(x) for x in zip(*found))) for name, found in parts.items()}
    kinds = {lang: len(table.hashes) for (lang, name), table in tables.items() if name == "p1"}
    return Model(vocabulary, tables, kinds)


def quality(
    spark: SparkSession, docs: DataFrame, p: PerplexityParams = PerplexityParams(), cut: SweepParams = SweepParams()
) -> DataFrame:
    """Per row: doc_id, the five base counts, base_failed, kept, perplexity (null without words)."""
    prepare(spark)
    workspace = Workspace(spark)
    named = docs.select("doc_id", F.coalesce("lang", F.lit(_NONE)).alias("lang"), "text")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    bounded = p.word_share > 0 or p.gram_share > 0
    shared = spark.sparkContext.broadcast(learn(spark, named, p, workspace)) if bounded else None

    def judge(batches):
        for batch in batches:
            texts = [t or b"" for t in batch.column(3).to_pylist()]
            found = base_counts(texts)
            words = [Words(t.decode("utf-8", "surrogatepass")) for t in texts] if bounded else [None] * len(texts)
            loss = [shared.value.loss(lang, w) if w and len(w.hashes) else None for lang, w in zip(batch.column(1).to_pylist(), words)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], *(pa.array(found[n], pa.int64()) for n in names), pa.array(loss, pa.float64())],
                names=["doc_id", "lang", "digest", *names, "loss"])

    digest = text_digest(F.col("lang"), F.col("text")).alias("digest")
    rows = named.select("doc_id", "lang", digest, F.col("text").cast("binary"))
    schema = T.StructType([*rows.schema.fields[:3], *(T.StructField(n, T.LongType()) for n in names), T.StructField("loss", T.DoubleType())])
    judged = workspace.stage(rows.mapInArrow(judge, schema), "judged")
    if not bounded:
        totals = judged.where("n_words > 0").groupBy("lang").agg(F.sum("n_words").alias("n")).collect()
        texts = named.where("text is not null").select("lang", "text", digest)
        found = losses(spark, texts, {r["lang"]: r["n"] for r in totals}, workspace, cut)
        mean = (F.col("loss") / F.col("n_words")).alias("loss")
        judged = workspace.stage(
            judged.drop("loss").join(found, "digest", "left").select("doc_id", "lang", *names, mean), "scored")
    failed = (F.col("n_words") < p.least_words) | (100 * F.col("n_repeat_words") > p.most_repeated * F.col("n_words"))
    judged = judged.withColumn("base_failed", failed)
    bands = judged.where("not base_failed").groupBy("lang").agg(
        F.percentile_approx("loss", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.lit(10_000)).alias("q")
    )
    bands = workspace.stage(bands, "bands")
    spread = F.greatest((F.col("q")[2] - F.col("q")[0]) / 1.349, F.lit(0.02))
    limit = p.width * spread * F.sqrt(1 + p.short / F.greatest(F.col("n_words"), F.lit(1)))
    outside = F.coalesce(F.abs(F.col("loss") - F.col("q")[1]) > limit, F.lit(False))
    return judged.join(bands, "lang", "left").select(
        "doc_id", *names, "base_failed", (~F.col("base_failed") & ~outside).alias("kept"),
        F.exp("loss").alias("perplexity"),
    )
