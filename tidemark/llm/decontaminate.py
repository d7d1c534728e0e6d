"""Benchmark decontamination by pigeonhole edit matching.

Texts and items are compared as lower-case words joined by single spaces. An item
of m characters may differ by k = floor(m * edits) characters. It is cut into
k + 1 pieces, of which one must occur unchanged in any passage that close; an
automaton finds all pieces of a block of items in one walk over a text, and
Myers' bit-parallel distance verifies the window around each hit. It does so from
the piece upwards: of two neighbouring runs of i and j pieces one must be within
i - 1 or j - 1 edits, so a hit is given up at the first run around it that is not.

The items are the stated query set: they are broadcast in blocks of about
`block_chars` characters, each against all texts. Null or empty texts hit
nothing; items without a word match nothing; repeated items each match.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce
from math import ceil

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.text import prepare

_WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class EditBudget:
    edits: float = 0.1
    block_chars: int = 2_000_000


def normal(text: str) -> str:
    return " ".join(_WORD.findall(text.lower()))


class Pattern:
    """A piece of text to be matched approximately, as the bits at which each character stands."""

    def __init__(self, text: str):
        self.size = len(text)
        self.places: dict[str, int] = {}
        for k, char in enumerate(text):
            self.places[char] = self.places.get(char, 0) | 1 << k

    def best_end(self, text: str) -> tuple[int, int]:
        """Least edit distance to a substring of the text, and where the first such one ends."""
        full, top, get = (1 << self.size) - 1, 1 << (self.size - 1), self.places.get
        up, down, score, best, end = full, 0, self.size, self.size, 0
        for j, char in enumerate(text, 1):
            equal = get(char, 0)
            across = (((equal & up) + up) ^ up) | equal
            grow = (down | ~(across | up)) & full
            shrink = up & across
            if grow & top:
                score += 1
            elif shrink & top:
                score -= 1
                if score < best:
                    best, end = score, j
            grow, still = grow << 1, equal | down
            up, down = ((shrink << 1) | ~(still | grow)) & full, grow & still & full
        return best, end


class Item:
    """A normal text cut into budget + 1 pieces, and the runs of pieces around each of them up to the whole."""

    def __init__(self, key: object, text: str, edits: float):
        self.key, self.text, self.budget = key, text, int(len(text) * edits)
        count = self.budget + 1
        self.cuts = [len(text) * k // count for k in range(count + 1)]
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(count)]
        open_runs = [(0, count)]
        while open_runs:
            low, high = open_runs.pop()
            if high - low > 1:
                middle = (low + high) // 2
                open_runs += [(low, middle), (middle, high)]
                for k in range(low, high):
                    self.runs[k].append((low, high))
        for path in self.runs:
            path.sort(key=lambda run: run[1] - run[0])
        self.patterns: dict[tuple[int, int], Pattern] = {}

    def pieces(self) -> list[str]:
        return [self.text[low:high] for low, high in zip(self.cuts, self.cuts[1:])]

    def match(self, text: str, piece: int, start: int) -> tuple[int, int] | None:
        """(distance, end) if every run around a piece is near enough where the item would start at `start`."""
        best = 0, start + len(self.text)
        for run in self.runs[piece]:
            low, high, budget = self.cuts[run[0]], self.cuts[run[1]], run[1] - run[0] - 1
            pattern = self.patterns.get(run)
            if pattern is None:
                pattern = self.patterns[run] = Pattern(self.text[low:high])
            left = max(0, start + low - budget)
            distance, end = pattern.best_end(text[left : max(0, start + high + budget)])
            if distance > budget:
                return None
            best = distance, left + end
        return best


class Matcher:
    """All items of one block as an automaton."""

    def __init__(self, items: Iterable[tuple[object, str | None]], edits: float):
        self.items = [Item(key, norm, edits) for key, text in items if (norm := normal(text or ""))]
        uses: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for k, item in enumerate(self.items):
            for place, piece in enumerate(item.pieces()):
                uses[piece].append((k, place))
        self.uses = list(uses.items())
        self.automaton = ahocorasick.Automaton()
        for k, (piece, _) in enumerate(self.uses):
            self.automaton.add_word(piece, k)
        self.automaton.make_automaton()

    def find(self, text: str | None) -> Iterator[tuple[object, int, int, int, int]]:
        """(item, budget, distance, start, end) of the closest passage of each item; code points of the normal text."""
        if not text or not self.items:
            return
        norm = normal(text)
        best: dict[int, tuple[int, int]] = {}
        seen: set[tuple[int, int]] = set()
        for last, k in self.automaton.iter(norm):
            piece, uses = self.uses[k]
            for number, place in uses:
                item = self.items[number]
                start = last + 1 - len(piece) - item.cuts[place]
                if (number, start) in seen:
                    continue
                found = item.match(norm, place, start)
                if found:
                    seen.add((number, start))
                    best[number] = min(best.get(number, found), found)
        for number, (distance, end) in sorted(best.items()):
            item = self.items[number]
            left = max(0, end - len(item.text) - item.budget)
            _, length = Pattern(item.text[::-1]).best_end(norm[left:end][::-1])
            yield item.key, item.budget, distance, end - length, end

    def places(self, text: str, start: int, end: int) -> tuple[int, int]:
        """Code points of the text itself for a passage of the normal text."""
        words, at, origin = [], 0, []
        for word in _WORD.finditer(text):
            origin.append(at)
            words.append(word.span())
            at += len(word.group().lower()) + 1
        return words[bisect_right(origin, start) - 1][0], words[bisect_right(origin, max(start, end - 1)) - 1][1]


def _blocks(benchmark: DataFrame, params: EditBudget) -> Iterator[list[tuple[object, str | None]]]:
    total = benchmark.agg(F.sum(F.length("text"))).first()[0] or 0
    count = max(1, ceil(total / params.block_chars))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    for k in range(count):
        yield [tuple(r) for r in benchmark.where(block == k).select("item_id", "text").orderBy("item_id").collect()]


def find_passages(spark: SparkSession, docs: DataFrame, benchmark: DataFrame,
                  params: EditBudget = EditBudget()) -> DataFrame:
    """One row per document row and item found: doc_id, item_id, budget, distance, start_char, end_char, passage."""
    prepare(spark)
    kinds = dict(docs.dtypes)["doc_id"], dict(benchmark.dtypes)["item_id"]
    schema = (f"doc_id {kinds[0]}, item_id {kinds[1]}, budget long, distance long, "
              "start_char long, end_char long, passage string")

    def one(block):
        shared = spark.sparkContext.broadcast(block)

        def scan(batches):
            matcher = Matcher(shared.value, params.edits)
            for batch in batches:
                rows = []
                for doc_id, text in zip(batch["doc_id"], batch["text"]):
                    for item, budget, distance, start, end in matcher.find(text):
                        low, high = matcher.places(text, start, end)
                        rows.append((doc_id, item, budget, distance, low, high, text[low:high]))
                yield pd.DataFrame(rows, columns=[
                    "doc_id", "item_id", "budget", "distance", "start_char", "end_char", "passage"])

        return docs.select("doc_id", "text").mapInPandas(scan, schema)

    return reduce(DataFrame.union, map(one, _blocks(benchmark, params)))


def without_contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame,
                         params: EditBudget = EditBudget()) -> DataFrame:
    """The documents in which no item is found."""
    prepare(spark)
    for block in _blocks(benchmark, params):
        shared = spark.sparkContext.broadcast(block)

        @F.pandas_udf("boolean")
        def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            matcher = Matcher(shared.value, params.edits)
            for texts in batches:
                yield pd.Series([next(matcher.find(t), None) is None for t in texts], dtype=bool)

        docs = docs.where(clean("text"))
    return docs
