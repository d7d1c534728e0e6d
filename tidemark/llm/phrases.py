"""Phrase collocations by best-first branch and bound over growing phrases.

A phrase is a node; its children are one word longer. For a phrase of count c with first
word u, every longer phrase that starts with it has count a <= c, and the cut after u
alone has l = f(u), r >= a; so floor(2000000 * c / (f(u) + c)) bounds the score of all its
descendants from the prefix counts, and the bound only falls as the phrase grows.

Words and pairs of frequent words are counted first. Then, per language, the nodes with the
highest bounds are expanded: one scan counts all phrases that prolong them to the
right (their descendants) and to the left (which tell whether the node itself is dropped),
for pairs and for phrases of three words. The frontier goes down to the score of
rank `slack` * top; if, after the phrases contained in longer ones are dropped, the score of
rank `top` lies below what was expanded, the next nodes follow, ties included. So no
phrase that is not expanded can reach the report, and each phrase in it has exact
counts and is known to survive.

What a scan has to count is told by Bloom filters of `filter_bits` bits over the wanted
prefixes, per kind of prefix: the broadcast has a fixed size whatever the frontier. A phrase the filter lets through in
error is counted whole all the same, so counts are exact: tasks count on their own word
numbers, and Spark adds up the rows of a phrase. The pieces of a text are read in
parts of `part_bytes`, cut between pieces (a piece is never cut, so one piece must fit in memory).

A null text has no words, a null lang is `und`. Rows that repeat an id or a text all count. Empty
tables give an empty report; other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.text import encoded, mix, prepare
from tidemark.workspace import Workspace

# What ends a piece. All of it becomes one mark, which then cannot be part of a word.
_MARK = b"."
_ENDS = b".,;:!?\n\x0b\x0c\r"
_PLAIN = bytes(
    ord(_MARK) if c in _ENDS else c + 32 if 65 <= c <= 90 else c for c in range(256))
_COUNTS = "lang string, phrase string, f long"
_SCALE = 2_000_000


@dataclass(frozen=True)
class PhraseParams:
    top: int = 2000
    least: int = 30
    contained_num: int = 80
    contained_den: int = 100
    slack: int = 2
    filter_bits: int = 1 << 23
    part_bytes: int = 6 << 20
    salts: int = 32


def _hash_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))


def _fold(lang: str, columns: list[np.ndarray]) -> np.ndarray:
    """Hash of a phrase from the hashes of its words."""
    run = np.full(len(columns[0]), xxhash.xxh64_intdigest(lang.encode()), np.uint64)
    for words in columns:
        run = mix(run * np.uint64(0x9E3779B97F4A7C15) + words)
    return run


class Filter:
    """Bloom filter of phrase hashes with two bits a phrase."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @staticmethod
    def places(hashes: np.ndarray, size: int) -> np.ndarray:
        half = np.uint64(32)
        return np.stack([(hashes & np.uint64(0xFFFFFFFF)) % np.uint64(size), (hashes >> half) % np.uint64(size)])

    def has(self, hashes: np.ndarray) -> np.ndarray:
        first, second = self.places(hashes, 8 * len(self.bits)).astype(np.int64)
        get = lambda at: (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1
        return (get(first) & get(second)).astype(bool)


def _filter_bits(size: int):
    """mapInArrow function: the bits of the task's phrases, as 64-bit words with their place."""

    def place(batches):
        for batch in batches:
            by_lang = defaultdict(list)
            for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by_lang[lang, phrase.count(" ")].append(phrase.encode().split(b" "))
            at = [
                Filter.places(_fold(lang, [_hash_words(list(w)) for w in zip(*phrases)]), size).ravel()
                for (lang, _), phrases in by_lang.items()]
            at = np.unique(np.concatenate([*at, np.empty(0, np.uint64)]))
            yield pa.RecordBatch.from_arrays(
                [pa.array((at >> np.uint64(6)).astype(np.int32)),
                 pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))], ["place", "bits"])

    return place


def _filter(spark: SparkSession, phrases: DataFrame, p: PhraseParams):
    """Broadcast filter of (lang, phrase); its bits are put together by Spark."""
    rows = phrases.select("lang", "phrase").mapInArrow(_filter_bits(p.filter_bits), "place int, bits long")
    rows = rows.groupBy("place").agg(F.expr("bit_or(bits)").alias("bits")).toPandas()
    bits = np.zeros(p.filter_bits // 64, np.uint64)
    bits[rows["place"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(np.uint64)
    return spark.sparkContext.broadcast(Filter(bits.view(np.uint8)))


class Part:
    """The words of some pieces of one language as numbers; 0 stands between pieces."""

    def __init__(self, lang: str, data: bytes):
        number = defaultdict(count(1).__next__, {_MARK: 0})
        tokens = data.replace(_MARK, b" . ").split()
        self.lang = lang
        self.ids = np.fromiter(map(number.__getitem__, tokens), np.int64, len(tokens))
        self.words = list(number)
        self.hashes = _hash_words(self.words)

    def runs(self, size: int) -> np.ndarray:
        """Whether `size` words of one piece start at each place."""
        ok = np.ones(max(0, len(self.ids) - size + 1), bool)
        for k in range(size):
            ok &= self.ids[k : k + len(ok)] != 0
        return ok

    def numbered(self, size: int, ok: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct phrases at the places `ok`, as rows of word numbers, and the row of every such place."""
        at = np.flatnonzero(ok)
        keys = self.ids[at]
        for k in range(1, size):
            _, keys = np.unique(keys, return_inverse=True)
            keys = keys * len(self.words) + self.ids[at + k]
        _, first, which = np.unique(keys, return_index=True, return_inverse=True)
        return np.stack([self.ids[at[first] + k] for k in range(size)], axis=1), which

    def members(self, size: int, ok: np.ndarray, wanted: Filter) -> np.ndarray:
        """Whether the phrase at each place is in the filter; false where none starts."""
        phrases, which = self.numbered(size, ok)
        out = np.zeros(len(ok), bool)
        if len(phrases):
            out[np.flatnonzero(ok)] = wanted.has(_fold(self.lang, [self.hashes[phrases[:, k]] for k in range(size)]))[which]
        return out

    def counted(self, size: int, ok: np.ndarray) -> pa.RecordBatch:
        """Count rows of the phrases at the places `ok`."""
        phrases, which = self.numbered(size, ok)
        times = np.bincount(which, minlength=len(phrases))
        columns = [[self.words[k] for k in phrases[:, j].tolist()] for j in range(size)]
        texts = columns[0] if size == 1 else list(map(b" ".join, zip(*columns)))
        return _count_rows(self.lang, texts, times)


def _count_rows(lang: str, texts: list, times) -> pa.RecordBatch:
    names = pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(texts), np.int32)), pa.array([lang])).dictionary_decode()
    return pa.RecordBatch.from_arrays(
        [names, pa.array(texts, pa.string()), pa.array(times, pa.int64())], ["lang", "phrase", "f"])


def _parts(batches, size: int):
    """The texts of the task in parts of at most `size` bytes and the rest of a piece, by language."""
    waiting, volume = defaultdict(list), defaultdict(int)
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            data = encoded(text.as_py()).translate(_PLAIN)
            start = 0
            while start < len(data):
                stop = len(data) if len(data) - start <= size else data.find(_MARK, start + size)
                stop = len(data) if stop < 0 else stop
                waiting[lang].append(data[start:stop])
                volume[lang] += stop - start
                start = stop
                if volume[lang] >= size:
                    yield Part(lang, _MARK.join(waiting.pop(lang)))
                    del volume[lang]
            if sum(volume.values()) >= 2 * size:
                largest = max(volume, key=volume.get)
                yield Part(largest, _MARK.join(waiting.pop(largest)))
                del volume[largest]
    for lang, texts in waiting.items():
        yield Part(lang, _MARK.join(texts))


def _scan(texts: DataFrame, rows_of, p: PhraseParams) -> DataFrame:
    """(lang, phrase, f) added up over all texts; rows_of(part) gives a part's count rows."""

    def scan(batches):
        for part in _parts(batches, p.part_bytes):
            yield from rows_of(part)

    return texts.mapInArrow(scan, _COUNTS).groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def _word_rows(part: Part):
    ok = part.runs(1)
    yield part.counted(1, ok)
    yield _count_rows(part.lang, [None], [int(ok.sum())])


def _pair_rows(words):
    def rows(part: Part):
        often = part.members(1, part.runs(1), words.value)
        yield part.counted(2, part.runs(2) & often[:-1] & often[1:] if len(often) > 1 else np.empty(0, bool))

    return rows


def _long_rows(pairs, frontier2, frontier3, suffixes):
    """Phrases of three words that prolong a pair of the frontier, or start with a pair that a phrase of three in the
    frontier ends with, and phrases of four words that prolong one of three. All pairs in them must be frequent."""

    def rows(part: Part):
        if len(part.ids) < 3:
            return
        ok = part.runs(2)
        often = part.members(2, ok, pairs.value)
        three = often[:-1] & often[1:]
        wanted = np.zeros(len(three), bool)
        if frontier2 is not None:
            open2 = part.members(2, often, frontier2.value)
            wanted |= open2[:-1] | open2[1:]
        if suffixes is not None:
            wanted |= part.members(2, often, suffixes.value)[:-1]
        yield part.counted(3, three & wanted)
        if frontier3 is not None and len(three) > 1:
            open3 = part.members(3, three, frontier3.value)
            yield part.counted(4, three[:-1] & three[1:] & (open3[:-1] | open3[1:]))

    return rows


def _ratio(a: Column, whole: Column) -> Column:
    """floor(2000000 * a / whole), exact beyond 64 bits."""
    wide = F.lit(_SCALE).cast("decimal(7,0)") * a.cast("decimal(19,0)")
    return F.call_function("div", wide, whole.cast("decimal(27,0)")).cast("long")


def _first(phrase: str, k: int | Column) -> Column:
    return F.call_function("substring_index", F.col(phrase), F.lit(" "), F.lit(k) if isinstance(k, int) else k)


def _n_words(phrase: str) -> Column:
    return F.length(phrase) - F.length(F.translate(F.col(phrase), " ", "")) + 1


class Collocations:
    """The search over staged count tables."""

    def __init__(self, spark: SparkSession, docs: DataFrame, p: PhraseParams):
        self.spark, self.p = prepare(spark), p
        self.workspace = Workspace(spark)
        self.texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").where("text is not null")
        words = self.workspace.stage(
            _scan(self.texts, _word_rows, p).where((F.col("f") >= p.least) | F.col("phrase").isNull()), "words")
        self.totals = words.where("phrase is null").select("lang", F.col("f").alias("n"))
        self.words = words.where("phrase is not null")
        often = _filter(spark, self.words, p)
        self.pairs = self._counted(_pair_rows(often), "pairs")
        self.long = self.spark.createDataFrame([], _COUNTS)
        often.unpersist()

    def _counted(self, rows_of, name: str) -> DataFrame:
        return self.workspace.stage(_scan(self.texts, rows_of, self.p).where(F.col("f") >= self.p.least), name)

    def scored(self) -> DataFrame:
        """Candidates (lang, phrase, a, score, l, r, bound, dropped) as far as the counts known tell. A cut whose
        parts are not counted yet is left out, so a score may be too high, but never above the prefix's bound."""
        found = self.pairs.unionByName(self.long)
        size = _n_words("phrase")
        ends = F.flatten(F.transform(F.sequence(F.lit(1), size - 1), lambda k: F.array(
            F.struct(k.alias("k"), F.lit(True).alias("head"), _first("phrase", k).alias("part")),
            F.struct(k.alias("k"), F.lit(False).alias("head"), _first("phrase", k - size).alias("part")))))
        parts = found.select("lang", "phrase", F.col("f").alias("a"), F.explode(ends).alias("e")).select(
            "lang", "phrase", "a", "e.k", "e.head", "e.part")
        known = self.words.unionByName(self.pairs).unionByName(self.long.where(_n_words("phrase") == 3))
        parts = parts.join(known.select("lang", F.col("phrase").alias("part"), "f"), ["lang", "part"])
        value = lambda k, head: F.max(F.when((F.col("k") == k) & (F.col("head") == head), F.col("f")))
        sides = parts.groupBy("lang", "phrase", "a").agg(
            *(value(k, True).alias(f"l{k}") for k in (1, 2, 3)), *(value(k, False).alias(f"r{k}") for k in (1, 2, 3)))
        cut = lambda k: F.when(F.col(f"l{k}").isNotNull() & F.col(f"r{k}").isNotNull(), F.struct(
            _ratio(F.col("a"), F.col(f"l{k}") + F.col(f"r{k}")).alias("score"), F.lit(k).alias("k"),
            F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
        best = F.least(cut(1), cut(2), cut(3))
        bound = _ratio(F.col("a"), F.col("l1") + F.col("a"))
        scores = sides.select("lang", "phrase", "a", bound.alias("bound"), best.alias("best")).select(
            "lang", "phrase", "a", "bound", "best.score", "best.l", "best.r")
        size = _n_words("phrase")
        inside = self.long.select("lang", "f", F.explode(F.array(
            _first("phrase", size - 1), _first("phrase", 1 - size))).alias("phrase"))
        inside = inside.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
        p = self.p
        dropped = p.contained_den * F.col("longer") >= p.contained_num * F.col("a")
        return scores.join(inside, ["lang", "phrase"], "left").select(
            "lang", "phrase", "a", "score", "l", "r", "bound", F.coalesce(dropped, F.lit(False)).alias("dropped"))

    @staticmethod
    def _score_at(scored: DataFrame, rank: int) -> DataFrame:
        """(lang, level): the score of that rank among the phrases not dropped, 0 if there are fewer."""
        totals = scored.groupBy("lang", "score").agg(F.sum((~F.col("dropped")).cast("long")).alias("times"))
        order = Window.partitionBy("lang").orderBy(F.col("score").desc())
        reach = totals.withColumn("reach", F.sum("times").over(order))
        return reach.groupBy("lang").agg(
            F.coalesce(F.max(F.when(F.col("reach") >= rank, F.col("score"))), F.lit(0)).alias("level"))

    def expand(self) -> DataFrame:
        """Grow until nothing below the frontier can change the report; the candidates from the score of rank `top` up."""
        p, done = self.p, None
        pairs = _filter(self.spark, self.pairs, p)
        while True:
            scored = self.workspace.stage(self.scored(), "scored")
            if done is not None:
                reached = self._score_at(scored, p.top).withColumnRenamed("level", "now")
                short = self.workspace.stage(done.join(reached, "lang").where("now < level").select("lang"), "short")
                if short.isEmpty():
                    return scored.join(reached, "lang").where("score >= now")
            level = self._score_at(scored, p.slack * p.top)
            before = level.select("lang", F.lit(1 << 62).alias("before")) if done is None else done.withColumnRenamed("level", "before")
            if done is not None:  # only where the report reaches below the frontier
                level = level.join(short, "lang", "left_semi")
            span = before.join(level, "lang", "left").select(
                "lang", "before", F.least("before", F.coalesce("level", "before")).alias("level"))
            span = self.workspace.stage(span, "span")
            done = span.select("lang", "level")
            self._grow(scored, span, pairs, 2)
            self._grow(self.workspace.stage(self.scored(), "scored"), span, pairs, 3)

    def _grow(self, scored: DataFrame, span: DataFrame, pairs, size: int) -> None:
        """Count what prolongs the open nodes of `size` words: bounds from `level` up to, not including, `before`."""
        opened = scored.where(_n_words("phrase") == size).join(span, "lang").where("bound >= level and bound < before")
        opened = self.workspace.stage(opened.select("lang", "phrase"), "opened")
        if opened.isEmpty():
            return
        shared = _filter(self.spark, opened, self.p)
        tails = None
        if size == 3:  # phrases of three words that phrases of four end with
            tails = _filter(self.spark, opened.select("lang", _first("phrase", -2).alias("phrase")).distinct(), self.p)
        rows = _long_rows(pairs, shared, None, None) if size == 2 else _long_rows(pairs, None, shared, tails)
        new = self._counted(rows, "long")
        self.long = self.workspace.stage(self.long.unionByName(new).dropDuplicates(["lang", "phrase"]), "long")
        shared.unpersist()

    def report(self) -> DataFrame:
        """(lang, rank, phrase, a, l, r, n, score): the first `top` phrases of each language."""
        p = self.p
        alive = self.expand().where("not dropped")
        order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
        salted = alive.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(p.salts)))
        some = salted.withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
        some = some.where(F.col("place") <= p.top)
        ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
        return ranked.where(F.col("rank") <= p.top).join(self.totals, "lang").select(
            "lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations(spark: SparkSession, docs: DataFrame, p: PhraseParams = PhraseParams()) -> DataFrame:
    """The phrase report of a table with columns lang and text."""
    return Collocations(spark, docs, p).report()
