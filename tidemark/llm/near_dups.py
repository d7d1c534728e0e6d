"""MinHash near-duplicates by tensored banding.

Two small collections of bands are hashed per text, and every pair of a band of
the one with a band of the other makes a table key: `bands_a * bands_b` tables
from `bands_a * rows_a + bands_b * rows_b` minima, about the square root of what
separate bands would take. Texts with equal shingle sets are one class from the
start. Candidates are confirmed on full sets (64-bit shingle hashes).

Each class is first compared with one lead only, of all its buckets the one that collides
most: a group of copies is linked by about as many pairs as it has members. Buckets that then
lie in one component are done. In every other bucket the lead most of its members have been
compared with is the reference h, and the members that have not are compared with it too.
Let u have no link to h. A class y of the same bucket that is similar to u then shares with u
a shingle that h lacks, for otherwise u would share as much with h; the one exception is a y so
much smaller than h that its size tells. So what is left are classes under the same reference,
in different components, that share one of the first 20 % (and one) of their shingles that the
reference lacks, in hash order - the usual prefix bound - or have such a size. Of such a pair is known
what each shares with h, and so how many shingles that h lacks it must share to be similar:
pairs that share too few are left out, as marks of all that h lacks of each show before a pair is made, the others
confirmed too. No link is given up.

Empty and null texts and texts of spaces have no set and are linked with nothing.
A text with fewer words than a shingle has one shingle. Rows that repeat an id
get the same component if their texts are equal or near. A null id ranks last.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.graph import components
from tidemark.llm.text import encoded, maybe_among, mix, prepare, shingle_set, surely_not_among
from tidemark.workspace import Workspace

_LACK, _OWN = 4, 8  # integers of marks
_KEY_BITS = 1 << 26  # of the filter of bucket keys that several classes have


@dataclass(frozen=True)
class TensorBands:
    words: int = 5
    similar_num: int = 80
    similar_den: int = 100
    bands_a: int = 9
    rows_a: int = 3
    bands_b: int = 6
    rows_b: int = 2
    seed: int = 17


def words_of(text: str | None) -> bytes:
    return encoded(text).lower()  # bytes.lower() changes A-Z only


def band_hashes(grams: np.ndarray, bands: int, rows: int, seed: int) -> np.ndarray:
    """One hash per band, folded from the minima of its rows."""
    random = np.random.default_rng(seed)
    factor = random.integers(0, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    offset = random.integers(0, 2**63, bands * rows, dtype=np.uint64)
    least = np.full(bands * rows, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(grams), 2048):
        values = grams[start : start + 2048, None] * factor + offset
        np.minimum(least, (values ^ (values >> np.uint64(29))).min(axis=0), out=least)
    least = least.reshape(bands, rows)
    folded = np.arange(bands, dtype=np.uint64) + np.uint64(seed)
    for k in range(rows):
        folded = mix(folded * np.uint64(0x9E3779B97F4A7C15) + least[:, k])
    return folded.view(np.int64)


def _signer(p: TensorBands):
    @F.pandas_udf("n long, node binary, a array<long>, b array<long>")
    def sign(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            grams = shingle_set(words_of(text), p.words)
            if not len(grams):
                out.append((0, None, None, None))
                continue
            salt = np.arange(len(grams), dtype=np.uint64)
            node = np.array(
                [mix(grams * np.uint64(3) + salt).sum(), mix(grams ^ (salt << np.uint64(17))).sum()], np.uint64
            ).tobytes()
            out.append((
                len(grams),
                node,
                band_hashes(grams, p.bands_a, p.rows_a, p.seed),
                band_hashes(grams, p.bands_b, p.rows_b, p.seed + 1),
            ))
        return pd.DataFrame(out, columns=["n", "node", "a", "b"])

    return sign


def _set_maker(p: TensorBands):
    @F.pandas_udf("binary")
    def make(texts: pd.Series) -> pd.Series:
        return pd.Series([shingle_set(words_of(t), p.words).tobytes() for t in texts], dtype=object)

    return make


def _marks(grams: np.ndarray, words: int) -> np.ndarray:
    """The shingles as bits in `words` integers, a power of two: never more bits than shingles."""
    bits = np.zeros(64 * words, bool)
    bits[(grams >> np.uint64(64 - len(bits).bit_length() + 1)).astype(np.int64)] = True
    return np.packbits(bits).view(np.int64)


def _comparer(p: TensorBands):
    """Shared shingles of two sets, the prefix of the second's shingles that the first lacks, and marks of those of the
    first that the second lacks and of those of the second that the first lacks."""

    @F.pandas_udf("shared long, size_a long, size_b long, rest array<long>, lack array<long>, own array<long>")
    def compare(first: pd.Series, second: pd.Series) -> pd.DataFrame:
        out = []
        for x, y in zip(first, second):
            a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            rest = np.setdiff1d(b, a, assume_unique=True)
            least = -(-p.similar_num * len(b) // p.similar_den)
            out.append((len(b) - len(rest), len(a), len(b), np.sort(rest)[: len(b) - least + 1].view(np.int64),
                        _marks(np.setdiff1d(a, b, assume_unique=True), _LACK), _marks(rest, _OWN)))
        return pd.DataFrame(out, columns=["shared", "size_a", "size_b", "rest", "lack", "own"])

    return compare


class NearDuplicates:
    """Staged near-duplicate classes of a table with columns doc_id and text (others are carried)."""

    def __init__(self, spark: SparkSession, docs: DataFrame, params: TensorBands = TensorBands(),
                 workspace: Workspace | None = None):
        self.spark, self.params = prepare(spark), params
        self.workspace = workspace or Workspace(spark)
        signed = docs.select(
            F.struct("*").alias("row"), F.monotonically_increasing_id().alias("uid"), _signer(params)("text").alias("s")
        )
        self.rows = self.workspace.stage_packed(signed.select("row", "uid", "s.*"), "signed")
        found = self.rows.where("n > 0").groupBy("node").agg(
            F.min("uid").alias("uid"), F.min("row.doc_id").alias("doc_id"),
            F.first("n").alias("n"), F.first("a").alias("a"), F.first("b").alias("b"),
        )
        self.classes = self.workspace.stage(found, "classes")

    def _buckets(self) -> tuple[DataFrame, DataFrame]:
        """(key, uid) of the buckets of several classes, and (uid, a): the lead of each class, itself if it leads all."""
        pairs = F.flatten(F.transform("a", lambda x: F.transform("b", lambda y: F.xxhash64(x, y))))
        keyed = self.classes.select("uid", F.explode(pairs).alias("key"))
        stage, drop = self.workspace.stage, self.workspace.drop
        shared = stage(keyed.groupBy("key").agg(F.count("*").alias("crowd")).where("crowd > 1"), "buckets")
        # Most keys are of one class only: those the filter tells need not be shuffled to learn it.
        members = stage(maybe_among(keyed, shared, "key", _KEY_BITS).join(shared, "key"), "members")
        degree = stage(members.groupBy("uid").agg(F.sum("crowd").alias("degree")), "degree")
        ranked = members.join(degree, "uid").groupBy("key").agg(F.max(F.struct("degree", "uid")).alias("top"))
        leads = stage(ranked, "leads")
        homes = stage(members.join(leads, "key").groupBy("uid").agg(F.max("top").getField("uid").alias("a")), "homes")
        drop(shared, degree, leads)
        return members, homes

    def _star(self) -> DataFrame:
        """Compared pairs (a, b, shared, size_a, size_b, rest, lack, own, linked) of a reference a and a class b: every class with its lead,
        and every class of a bucket that these links do not put in one component with the bucket's reference."""
        columns = ["a", "b", "shared", "size_a", "size_b", "rest", "lack", "own", "linked"]
        stage, drop = self.workspace.stage, self.workspace.drop
        members, homes = self._buckets()
        first = self._compared(homes.where("uid != a").select("a", F.col("uid").alias("b")), columns)
        labels = components(first.where("linked").select("a", "b"), self.workspace)
        placed = stage(
            homes.join(labels.withColumnRenamed("node", "uid"), "uid", "left").select(
                "uid", F.col("a").alias("home"), F.coalesce("label", "uid").alias("label")), "placed")
        named = stage(members.select("key", "uid").join(placed, "uid"), "named")
        mixed = named.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
        mixed = stage(named.join(stage(mixed.select("key"), "mixed"), "key"), "open")
        often = mixed.groupBy("key", "home").agg(F.count("*").alias("n")).groupBy("key").agg(
            F.max(F.struct("n", "home")).getField("home").alias("a"))
        pairs = mixed.join(stage(often, "references"), "key").where("uid != a and home != a")
        second = self._compared(stage(pairs.select("a", F.col("uid").alias("b")).distinct(), "pairs"), columns)
        star = stage(first.union(second), "star")
        drop(members, homes, placed, named, mixed, first, second)
        return star

    def _compared(self, pairs: DataFrame, columns: list[str]) -> DataFrame:
        """Pairs (a, b) with what their full sets share, and whether that links them."""
        ends = pairs.select(F.explode(F.array("a", "b")).alias("uid")).distinct()
        texts = self.rows.select("uid", F.col("row.text").alias("text"))
        sets = maybe_among(texts, ends, "uid").join(ends, "uid").select("uid", _set_maker(self.params)("text").alias("grams"))
        sets = self.workspace.stage(sets, "sets")
        # References are few beside the classes compared with them.
        first = maybe_among(sets.select(F.col("uid").alias("a"), F.col("grams").alias("grams_a")), pairs, "a")
        second = sets.select(F.col("uid").alias("b"), F.col("grams").alias("grams_b"))
        both = pairs.join(first, "a").join(second, "b").select(
            "a", "b", _comparer(self.params)("grams_a", "grams_b").alias("c")).select("a", "b", "c.*")
        p = self.params
        linked = p.similar_den * F.col("shared") >= p.similar_num * (F.col("size_a") + F.col("size_b") - F.col("shared"))
        compared = self.workspace.stage(both.withColumn("linked", linked).select(*columns), "compared")
        self.workspace.drop(sets)
        return compared

    def _left_over(self, star: DataFrame, labels: DataFrame) -> DataFrame:
        """Pairs under one lead that are in different components and may still be similar."""
        p = self.params
        under = star.join(labels.withColumnRenamed("node", "b"), "b", "left").withColumn("label", F.coalesce("label", "b"))
        crowds = star.groupBy("a").agg(F.count("*").alias("n"), F.max((~F.col("linked")).cast("int")).alias("loose"))
        crowds = self.workspace.stage(crowds.where("n > 1 and loose = 1").select("a"), "crowds")
        under = self.workspace.stage(under.join(crowds, "a", "left_semi"), "under")
        self.workspace.drop(crowds)

        def named(side: str, *more) -> DataFrame:
            at = lambda name: f"{name}_{side}"
            return under.select(
                "a", F.col("b").alias(side), F.col("label").alias(at("label")), F.col("size_b").alias(at("size")),
                F.col("shared").alias(at("shared")), F.col("lack").alias(at("lack")), F.col("own").alias(at("own")), (F.col("size_b") - F.col("shared") - F.size("rest")).alias(at("cut")), *more)

        # What x and y must share, less the most they may share within the reference: the rest lies outside of it.
        least = F.ceil((F.col("size_x") + F.col("size_y")) * p.similar_num / (p.similar_num + p.similar_den))
        gone = sum((F.bit_count(F.get("lack_x", F.lit(k)).bitwiseOR(F.get("lack_y", F.lit(k)))) for k in range(_LACK)), F.lit(0))
        need = least - F.least("shared_x", "shared_y", F.col("size_a") - gone)

        def beyond(one: str, other: str) -> Column:
            """The most of its shingles beyond the reference that one may share: not those with a mark the other lacks."""
            only = sum((F.bit_count(F.get(f"own_{one}", F.lit(k)).bitwiseAND(F.bitwise_not(F.get(f"own_{other}", F.lit(k)))))
                        for k in range(_OWN)), F.lit(0))
            return F.col(f"size_{one}") - F.col(f"shared_{one}") - only

        possible = (need <= beyond("x", "y")) & (need <= beyond("y", "x"))
        ends = (F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        gram = F.explode("rest").alias("gram")
        sharing = named("x", gram, "linked", "size_a").where("not linked").join(named("y", gram), ["a", "gram"]).where(
            F.expr("x != y and label_x != label_y") & possible)
        # A common shingle outside both prefixes lies in what one of them cut off.
        sharing = sharing.groupBy("a", "x", "y").agg(
            F.count("*").alias("n"), F.first(need).alias("need"), F.first(F.greatest("cut_x", "cut_y")).alias("cut")
        ).where("n + cut >= need").select(*ends)
        low = F.ceil(F.col("size_b") * p.similar_num / p.similar_den)
        high = F.floor(F.col("shared") * (p.similar_num + p.similar_den) / p.similar_num - F.col("size_b"))
        small = named("x", "linked", "size_a", low.alias("low"), high.alias("high")).where("not linked and low <= high")
        small = small.withColumn("size_y", F.explode(F.sequence("low", "high")))
        smaller = small.join(named("y"), ["a", "size_y"]).where(
            F.expr("x != y and label_x != label_y") & (need <= 0)).select(*ends)
        found = self.workspace.stage(sharing.union(smaller).distinct(), "left_over")
        self.workspace.drop(under)
        return found

    def labels(self) -> DataFrame:
        """(node, label) of the classes that have a link."""
        star = self._star()
        links = star.where("linked").select("a", "b")
        labels = components(links, self.workspace)
        rest = self._left_over(star, labels)
        if rest.isEmpty():
            return labels
        more = self._compared(rest, ["a", "b", "linked"]).where("linked").select("a", "b")
        return components(links.union(more), self.workspace)

    def result(self) -> DataFrame:
        """Per row doc_id, uid, n_shingles, label and component_id (the component's smallest doc_id), without its text."""
        labels = self.labels()
        named = self.workspace.stage(
            self.classes.select("node", "uid", "doc_id")
            .join(labels.withColumnRenamed("node", "uid"), "uid", "left")
            .select("node", "doc_id", F.coalesce("label", "uid").alias("label")),
            "named",
        )
        smallest = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
        smallest = self.workspace.stage(smallest, "smallest")
        found = self.workspace.stage(named.join(smallest, "label").select("node", "label", "component_id"), "found")
        rows = self.rows.select(F.col("row.doc_id").alias("of"), "uid", "node", F.col("n").alias("n_shingles"))
        return rows.join(found, "node", "left").select(
            F.col("of").alias("doc_id"), "uid", "n_shingles", "label",
            F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("of")).alias("component_id"),
        )


def near_duplicates(spark: SparkSession, docs: DataFrame, params: TensorBands = TensorBands()) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept (doc_id is its component's smallest)."""
    found = NearDuplicates(spark, docs.select("doc_id", "text"), params).result()
    return found.select(
        "doc_id", "n_shingles", "component_id", F.expr("doc_id <=> component_id").alias("kept"),
    )


def without_near_duplicates(spark: SparkSession, docs: DataFrame, params: TensorBands = TensorBands(),
                            workspace: Workspace | None = None) -> DataFrame:
    """The documents, one row of each component: the first with the smallest id. Rows without a set stay."""
    job = NearDuplicates(spark, docs, params, workspace)
    found = job.workspace.stage(job.result().select("uid", "label", "n_shingles",
                                                    F.expr("doc_id <=> component_id").alias("least")), "judged")
    keepers = found.where("n_shingles > 0 and least").groupBy("label").agg(F.min("uid").alias("uid")).select("uid")
    keepers = job.workspace.stage(keepers, "keepers")
    gone = job.workspace.stage(found.where("n_shingles > 0").select("uid").join(keepers, "uid", "left_anti"), "gone")
    # Rows that surely stay are not moved to learn it.
    stay = surely_not_among(job.rows, gone, "uid").unionByName(
        maybe_among(job.rows, gone, "uid").join(gone, "uid", "left_anti"))
    return stay.select("row.*")
