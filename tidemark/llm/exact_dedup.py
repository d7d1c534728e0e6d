"""Exact dedup of a delivery of texts against history, by a minimal perfect hash.

A text's key is the SHA-256 of its whole text with every run of white space made one
space; a null text counts as empty. The distinct digests of history are spread over
buckets of some `slots` digests; each bucket has a minimal perfect hash: levels of
bits, where a digest that is alone in its place of a level takes it and the others go
on to the next, so that the rank of its bit is its slot. A slot holds the full digest and
the winner's locator (its doc_id) with the number of rows so far.

A delivery is grouped by digest first, so that a group of copies is one row however
large, and each group probes the one slot its digest may be in. Equal bytes in the slot make
it a repeat of that winner; any other group is a nonmember and stands for itself. Of
history and repeats the smallest doc_id stays.

The index is a table of one row a bucket; buckets are as many as the digests need, so a
task holds one bucket whatever the corpus. Nothing of it passes through the driver.

Null ids rank last: a group has none only if all its rows have none. Rows that repeat an
id and a text are all marked as kept; `without_copies` passes one of them.
An empty table gives an empty result. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.text import folder_remainder, mix, prepare
from tidemark.workspace import Workspace

BLANKS = r"[\x20\x09-\x0D]+"
_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class DigestParams:
    slots: int = 2048
    places: float = 1.6  # of a level, for each digest that reaches it


def text_digest(text: Column) -> Column:
    """The 32 bytes that equal texts share."""
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")
    return F.unhex(F.sha2(plain.cast("binary"), 256))


def _words(digests: bytes) -> np.ndarray:
    return np.frombuffer(digests, "<u8").reshape(-1, 4) if digests else np.empty((0, 4), np.uint64)


def _places(words: np.ndarray, level: int, size: int) -> np.ndarray:
    """Place of each digest in a level of `size` bits."""
    run = np.full(len(words), level + 1, np.uint64) * _STEP
    for k in range(4):
        run = mix(run + words[:, k])
    return (run % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """A bijection from a set of distinct digests to 0 .. n-1; of other digests it says nothing."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.ranks = [np.cumsum(bits) - 1 for bits in levels]
        self.offsets = np.cumsum([0, *(int(bits.sum()) for bits in levels)])

    @classmethod
    def over(cls, words: np.ndarray, places: float) -> "PerfectHash":
        levels = []
        while len(words):
            size = max(2, int(np.ceil(places * len(words))))
            at = _places(words, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            words = words[~alone[at]]
        return cls(levels)

    def slots(self, words: np.ndarray) -> np.ndarray:
        """The slot of each digest, -1 where no level has its bit."""
        out = np.full(len(words), -1, np.int64)
        rest = np.arange(len(words))
        for level, bits in enumerate(self.levels):
            at = _places(words[rest], level, len(bits))
            hit = bits[at]
            out[rest[hit]] = self.offsets[level] + self.ranks[level][at[hit]]
            rest = rest[~hit]
        return out

    def packed(self) -> tuple[list[int], bytes]:
        bits = np.concatenate([*self.levels, np.empty(0, bool)])
        return [len(level) for level in self.levels], np.packbits(bits).tobytes()

    @classmethod
    def unpacked(cls, sizes: list[int], data: bytes) -> "PerfectHash":
        bits = np.unpackbits(np.frombuffer(data, np.uint8), count=sum(sizes)).astype(bool)
        return cls(np.split(bits, np.cumsum(sizes)[:-1]) if sizes else [])


def _joined(column: pa.ChunkedArray) -> bytes:
    return b"".join(column.to_pylist())


def _builder(p: DigestParams):
    """The index row of one bucket."""

    def build(rows: pa.Table) -> pa.Table:
        digests = _joined(rows["digest"])
        words = _words(digests)
        hashed = PerfectHash.over(words, p.places)
        order = np.argsort(hashed.slots(words))
        sizes, bits = hashed.packed()
        by_slot = rows.take(pa.array(order))
        return pa.table({
            "bucket": rows["bucket"][:1].combine_chunks(),
            "sizes": pa.array([sizes], pa.list_(pa.int32())),
            "bits": pa.array([bits], pa.binary()),
            "digests": pa.array([words[order].tobytes()], pa.binary()),
            "winners": pa.array([by_slot["keep_id"].to_pylist()], pa.list_(rows.schema.field("keep_id").type)),
            "counts": pa.array([by_slot["n"].to_pylist()], pa.list_(pa.int64())),
        })

    return build


def _prober(kind: pa.DataType):
    """Groups of a delivery against the index row of their bucket: digest, keep_id, n, known."""

    def row(digests: list, keep: pa.Array, n: pa.Array, known: bool | None) -> pa.Table:
        return pa.table({
            "digest": pa.array(digests, pa.binary()), "keep_id": keep.cast(kind), "n": n.cast(pa.int64()),
            "known": pa.array([known] * len(digests), pa.bool_())})

    def probe(groups: pa.Table, index: pa.Table) -> pa.Table:
        groups = groups.combine_chunks()
        digests = groups["digest"].to_pylist()
        keep, n = pa.array(groups["keep_id"].to_pylist(), kind), pa.array(groups["n"].to_pylist(), pa.int64())
        if not index.num_rows:
            return row(digests, keep, n, False)
        entry = index.to_pylist()[0]
        held = entry["digests"]
        winners, counts = pa.array(entry["winners"], kind), pa.array(entry["counts"], pa.int64())
        slots = PerfectHash.unpacked(entry["sizes"], entry["bits"]).slots(_words(b"".join(digests)))
        known = np.array([s >= 0 and held[32 * s : 32 * s + 32] == d for s, d in zip(slots.tolist(), digests)], bool)
        at = pa.array(slots[known])
        mine = pa.array(known)
        first = pc.min_element_wise(keep.filter(mine), winners.take(at), skip_nulls=True)
        total = pc.add(n.filter(mine), counts.take(at))
        untouched = np.setdiff1d(np.arange(len(winners)), slots[known])
        others = pa.array(~known)
        return pa.concat_tables([
            row([d for d, k in zip(digests, known) if k], first, total, True),
            row([d for d, k in zip(digests, known) if not k], keep.filter(others), n.filter(others), False),
            row([held[32 * s : 32 * s + 32] for s in untouched.tolist()],
                winners.take(pa.array(untouched)), counts.take(pa.array(untouched)), None),
        ])

    return probe


def grouped(rows: DataFrame) -> DataFrame:
    """(digest, keep_id, n) of rows (doc_id, digest)."""
    return rows.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("n"))


class DigestIndex:
    """The distinct digests of history with their winners, by bucket."""

    def __init__(self, frame: DataFrame, buckets: int, kind: str):
        self.frame, self.buckets, self.kind = frame, buckets, kind

    @staticmethod
    def _bucket(buckets: int) -> Column:
        return F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int").alias("bucket")

    @classmethod
    def build(cls, groups: DataFrame, workspace: Workspace, p: DigestParams = DigestParams(),
              probes: int = 0) -> "DigestIndex":
        """From (digest, keep_id, n) with distinct digests; `probes` groups of a delivery are expected."""
        groups = workspace.stage(groups, "history")
        kind = groups.schema["keep_id"].dataType.simpleString()
        buckets = max(1, -(-max(groups.count(), probes) // p.slots))
        schema = f"bucket int, sizes array<int>, bits binary, digests binary, winners array<{kind}>, counts array<bigint>"
        rows = groups.select(cls._bucket(buckets), "digest", "keep_id", "n")
        frame = rows.groupBy("bucket").applyInArrow(_builder(p), schema)
        return cls(workspace.stage(frame, "digest-index"), buckets, kind)

    def probe(self, groups: DataFrame) -> DataFrame:
        """(digest, keep_id, n, known): groups of the delivery that history knows (true, with the winner and the
        rows of both), those it does not (false), and what only history has (null)."""
        kind = to_arrow_type(self.frame.schema["winners"].dataType.elementType)
        left = groups.select(self._bucket(self.buckets), "digest", "keep_id", "n").groupBy("bucket")
        return left.cogroup(self.frame.groupBy("bucket")).applyInArrow(
            _prober(kind), f"digest binary, keep_id {self.kind}, n bigint, known boolean")


def deliver(spark: SparkSession, docs: DataFrame, recent: Column, workspace: Workspace,
            p: DigestParams = DigestParams()) -> DataFrame:
    """(doc_id, digest, keep_id, group_size, known) of every row: rows with `recent` are the delivery, all others
    are history. `known` tells whether history had the text of a delivered row, null for history itself."""
    prepare(spark)
    rows = workspace.stage(
        docs.select("doc_id", text_digest(F.col("text")).alias("digest"), F.coalesce(recent, F.lit(True)).alias("recent")),
        "digests")
    delivery = workspace.stage(grouped(rows.where("recent")), "delivery")
    index = DigestIndex.build(grouped(rows.where("not recent")), workspace, p, delivery.count())
    found = workspace.stage(index.probe(delivery), "found")
    # A text of its own is its own winner: only groups of several rows are joined back.
    several = found.where("n > 1").select("digest", "keep_id", F.col("n").alias("group_size"), "known")
    several = workspace.stage(several, "several")
    joined = rows.join(several.withColumnRenamed("digest", "of"), F.col("digest") == F.col("of"), "left")
    return joined.select(
        "doc_id", "digest", F.when(F.col("of").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.when(F.col("recent"), F.coalesce("known", F.lit(False))).alias("known"),
    )


def exact_copies(spark: SparkSession, docs: DataFrame, recent: Column | None = None,
                 p: DigestParams = DigestParams()) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256. By default the rows with an odd crc32 of their id
    are a delivery on top of the others; the result does not depend on what is history."""
    recent = folder_remainder(F.col("doc_id"), 2) == 1 if recent is None else recent
    found = deliver(spark, docs, recent, Workspace(spark), p)
    return found.select(
        "doc_id", "keep_id", "group_size", F.expr("doc_id <=> keep_id").alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def without_copies(spark: SparkSession, docs: DataFrame, recent: Column | None = None,
                   p: DigestParams = DigestParams()) -> DataFrame:
    """The documents, all columns, one row of each text: of rows that repeat an id and a text any one."""
    recent = folder_remainder(F.col("doc_id"), 2) == 1 if recent is None else recent
    workspace = Workspace(spark)
    found = deliver(spark, docs, recent, workspace, p).where("doc_id <=> keep_id")
    winners = workspace.stage(
        found.groupBy(F.col("doc_id").alias("of"), F.col("digest").alias("hash")).agg(F.count("*").alias("times")), "winners")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), text_digest(F.col("text")).alias("digest"))
    chosen = rows.join(winners, F.col("id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("hash")))
    single = chosen.where("times = 1").select("row.*")
    return single.unionByName(chosen.where("times > 1").dropDuplicates(["of", "hash"]).select("row.*"))
