"""Line dedup by a segment-partition edit join, in DataFrame functions only.

Lines of at least `least_chars` code points take part with edits. Distinct lines are one
class each. A line of length l is cut into edits + 1 segments of nearly equal
length, of which one must occur unchanged in any line within `edits` edits, at a
place that both ends of the line bound. So a line probes, for each length from its
own down to `edits` less, the index of that length and segment with the few
substrings at such places. Pairs found are verified with a banded bit-parallel
edit distance: the band of 2 * edits + 1 diagonals is one small integer per column.

Lines linked directly or by others are one class; of all its occurrences the
first (by doc_id, then text, then place; null ids last) stays and the others go.
Each line is first compared with one line only, the first of its fullest bucket of the
index; buckets whose lines are then in different classes are compared with their first
line; only lines still in different classes after that are compared pair by pair, unless their marks
(parities of their pairs of neighbouring characters, of which an edit changes four at most) differ in more places than
the edits can change. So a group of variants of one line is linked by about as many pairs as it has members, and no
link is given up.

Shorter lines are left alone or, with `short_copies` (the query and the pipeline), take part as exact copies
unless blank; then the length only decides whether a line may have edits. A null text has no lines and stays null. Rows that repeat id and
text are one document and are treated alike.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.graph import components
from tidemark.llm.text import let, maybe_among, prepare, surely_not_among
from tidemark.workspace import Workspace

_PROBE = 1 << 62  # added to the id of a line that is not in the index of the bucket


@dataclass(frozen=True)
class LineParams:
    edits: int = 2
    least_chars: int = 40
    short_copies: bool = False


def banded_distance(short: Column, long: Column, edits: int) -> Column:
    """Edit distance of two strings whose lengths differ by at most `edits`, exact up to `edits`, else above it.

    Bit k of a column's integers is the row `k - edits` off the diagonal; rows are characters of `short`.
    """
    width = 2 * edits + 1
    full, top = (1 << width) - 1, 1 << (width - 1)
    equal = let(F.split(short, ""), lambda a: F.transform(F.split(long, ""), lambda c, j: sum(
        (F.when(F.get(a, j - edits + k) == c, 1 << k).otherwise(0) for k in range(width)), F.lit(0)).cast("long")))

    def step(s: Column, x: Column) -> Column:
        d = ((((x.bitwiseAND(s.vp) + s.vp).bitwiseXOR(s.vp)).bitwiseOR(x).bitwiseOR(s.vn)).bitwiseAND(F.lit(full)))
        more = lambda d: s.vn.bitwiseOR(F.bitwise_not(d.bitwiseOR(s.vp))).bitwiseAND(F.lit(full))

        def rest(t: Column) -> Column:
            d, up = t.d, t.up
            down, moved = d.bitwiseAND(s.vp), F.shiftright(d, 1)
            at = F.call_function("shiftleft", F.lit(1).cast("long"), (s.rows - s.j + edits).cast("int"))
            bit = lambda v, m: (v.bitwiseAND(m) != 0).cast("int")
            score = F.when(s.j + edits <= s.rows, s.score + 1 - bit(d, F.lit(top))).otherwise(
                s.score + bit(up, at) - bit(down, at))
            return F.struct(
                down.bitwiseOR(F.bitwise_not(moved.bitwiseOR(up))).bitwiseAND(F.lit(full)).alias("vp"),
                moved.bitwiseAND(up).alias("vn"), score.alias("score"), (s.j + 1).alias("j"), s.rows.alias("rows"))

        first = F.transform(F.array(d), lambda d: F.struct(d.alias("d"), more(d).alias("up")))
        return F.get(F.transform(first, rest), F.lit(0))

    start = F.struct(
        F.lit(((1 << (edits + 1)) - 1) << edits).cast("long").alias("vp"), F.lit(0).cast("long").alias("vn"),
        F.lit(edits).alias("score"), F.lit(1).alias("j"), F.length(short).alias("rows"))
    return F.aggregate(equal, start, step, lambda s: s.score)


def _keyed(lines: DataFrame, edits: int) -> DataFrame:
    """(uid, key, probe) of lines (uid, line): a line's own segments have probe false."""
    parts, cuts = edits + 1, []
    for less in range(edits + 1):
        for part in range(1, parts + 1):
            low, high = max(1 - part, less - (parts - part)), min(part - 1, less + (parts - part))
            cuts += [(less, part, off) for off in range(low, high + 1)]
    # The cuts are rows, not one long array of expressions, whose code would be too long to be compiled.
    made = lines.select("uid", "line", F.col("line").cast("binary").alias("bytes"), F.length("line").alias("chars"), F.explode(
        F.array(*(F.struct(*(F.lit(v).alias(n) for n, v in zip(("less", "part", "off"), cut))) for cut in cuts))).alias("cut"))
    less, part, off = (F.col(f"cut.{n}") for n in ("less", "part", "off"))
    length = F.col("chars") - less
    size, longer = F.expr(f"cast((chars - cut.less) div {parts} as int)"), length % parts  # the last `longer` segments have one character more
    begin = (part - 1) * size + F.greatest(F.lit(0), part - 1 - (parts - longer)) + 1 + off
    chars = size + F.when(part > parts - longer, 1).otherwise(0)
    # Places of characters are places of bytes in a line of ASCII: nothing is scanned to find them. The hashes are equal.
    key = F.when(F.octet_length("line") == F.col("chars"), F.xxhash64(length, part, F.substr("bytes", begin, chars))).otherwise(
        F.xxhash64(length, part, F.substr("line", begin, chars)))
    return made.select("uid", key.alias("key"), ((less != 0) | (off != 0)).alias("probe"))


def marks(line: Column) -> Column:
    """Parities, in 256 bits, of how often each pair of neighbouring characters occurs: an edit turns four at most."""
    pairs = let(F.split(line, ""), lambda a: F.transform(
        F.slice(a, 1, F.size(a) - 1), lambda c, k: F.pmod(F.xxhash64(c, F.get(a, k + 1)), F.lit(256)).cast("int")))
    # Bits are turned by exclusive or: a pair that occurs an even number of times leaves none.
    word = lambda at, k: F.aggregate(
        F.filter(at, lambda p: F.shiftright(p, 6) == k), F.lit(0).cast("long"),
        lambda bits, p: bits.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), p.bitwiseAND(F.lit(63)))))
    return F.when(F.length(line) > 1, let(pairs, lambda at: F.array(*(word(at, k) for k in range(4))))).otherwise(
        F.array(*(F.lit(0).cast("long") for _ in range(4))))


def _turned(x: Column, y: Column) -> Column:
    """In how many places two marks differ."""
    return F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda n, k: n + k)


class LineClasses:
    """Classes of the distinct lines of a table with columns doc_id and text."""

    def __init__(self, spark: SparkSession, docs: DataFrame, params: LineParams = LineParams(),
                 workspace: Workspace | None = None):
        self.spark, self.params, self.docs = prepare(spark), params, docs
        self.workspace = workspace or Workspace(spark)
        lines = self.occurrences().groupBy("line").agg(F.count("*").alias("n"))
        self.lines = self.workspace.stage(lines.withColumn("uid", F.monotonically_increasing_id()), "lines")

    @staticmethod
    def document(text: Column) -> Column:
        return F.unhex(F.md5(text.cast("binary")))

    def occurrences(self) -> DataFrame:
        """Lines that take part: doc_id, doc (hash of the text), place, line."""
        # The hash is taken before the lines are made: once per text, not once per line.
        texts = self.docs.select("doc_id", self.document(F.col("text")).alias("doc"), "text")
        lines = texts.select(
            "doc_id", "doc", F.posexplode(F.split("text", "\n")).alias("place", "line"))
        return lines.where(self._long() | F.col("line").rlike(r"\S")) if self.params.short_copies else lines.where(self._long())

    def _long(self) -> Column:
        return F.length("line") >= self.params.least_chars

    def _confirm(self, pairs: DataFrame) -> DataFrame:
        first = self.lines.select(F.col("uid").alias("a"), F.col("line").alias("line_a"))
        second = self.lines.select(F.col("uid").alias("b"), F.col("line").alias("line_b"))
        both = pairs.join(maybe_among(first, pairs, "a"), "a").join(maybe_among(second, pairs, "b"), "b")
        ordered = F.length("line_a") <= F.length("line_b")
        short, long = F.when(ordered, F.col("line_a")).otherwise(F.col("line_b")), F.when(
            ordered, F.col("line_b")).otherwise(F.col("line_a"))
        near = both.select("a", "b", short.alias("short"), long.alias("long")).where(
            F.length("long") - F.length("short") <= self.params.edits)
        # Most pairs fail, and their marks tell it of most of them.
        possible = _turned(marks(F.col("short")), marks(F.col("long"))) <= 4 * self.params.edits
        distance = banded_distance(F.col("short"), F.col("long"), self.params.edits)
        linked = F.when(possible, distance <= self.params.edits).otherwise(False)
        return self.workspace.stage(near.where(linked).select("a", "b"), "links")

    def labels(self) -> DataFrame:
        """(node, label) of the distinct lines that have a link."""
        keyed = _keyed(self.lines.where(self._long()), self.params.edits)
        keyed = keyed.select("key", (F.col("uid") + F.when(F.col("probe"), _PROBE).otherwise(0)).alias("member"))
        stage, drop = self.workspace.stage, self.workspace.drop
        bucket = Window.partitionBy("key")
        buckets = keyed.select(
            "key", "member", F.min("member").over(bucket).alias("lead"), F.count("*").over(bucket).alias("n"))
        members = buckets.where((F.col("lead") < _PROBE) & (F.col("n") > 1)).select(
            "key", "lead", "n", (F.col("member") % _PROBE).alias("uid"), (F.col("member") >= _PROBE).alias("probe"))
        members = stage(members, "members")
        pair = (F.least("lead", "uid").alias("a"), F.greatest("lead", "uid").alias("b"))
        fullest = members.where("uid != lead").groupBy("uid").agg(F.max(F.struct("n", "lead")).getField("lead").alias("lead"))
        tested = stage(fullest.select(*pair).distinct(), "tested")
        links = self._confirm(tested)
        named = self._still_open(members, components(links, self.workspace))
        drop(members)
        heads = named.select("key", F.col("uid").alias("head"), F.col("label").alias("head_label"), "probe").where(
            "not probe").drop("probe").distinct()
        star = named.join(heads, (named["key"] == heads["key"]) & (named["lead"] == heads["head"])).where(
            "label != head_label").select(*pair).distinct()
        star = stage(star.join(tested, ["a", "b"], "left_anti"), "star")
        links = links.union(self._confirm(star))
        labels = components(links, self.workspace)
        open_ = self._still_open(named.drop("label"), labels)
        ends = open_.select("uid").distinct()
        drawn = maybe_among(self.lines.select("uid", "line"), open_, "uid").join(ends, "uid").select(
            "uid", marks(F.col("line")).alias("marks"))
        drawn = stage(drawn, "marks")
        still = open_.join(drawn, "uid")
        index = still.where("not probe").select(
            "key", F.col("uid").alias("x"), F.col("label").alias("label_x"), F.col("marks").alias("marks_x"))
        probes = still.select("key", F.col("uid").alias("y"), F.col("label").alias("label_y"), F.col("marks").alias("marks_y"))
        turned = _turned(F.col("marks_x"), F.col("marks_y"))
        rest = index.join(probes, "key").where(F.expr("x != y and label_x != label_y") & (turned <= 4 * self.params.edits)).select(
            F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        rest = stage(rest.join(tested.union(star), ["a", "b"], "left_anti"), "rest")
        drop(named, open_, drawn, tested, star)
        if not rest.isEmpty():
            labels = components(links.union(self._confirm(rest)), self.workspace)
        drop(rest)
        return labels

    def _still_open(self, members: DataFrame, labels: DataFrame) -> DataFrame:
        """The members, with their label, of buckets whose lines are not in one class."""
        named = members.join(labels.withColumnRenamed("node", "uid"), "uid", "left").withColumn(
            "label", F.coalesce("label", "uid"))
        named = self.workspace.stage(named, "named")
        mixed = named.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
        mixed = self.workspace.stage(mixed.select("key"), "mixed")
        still = self.workspace.stage(named.join(mixed, "key"), "open")
        self.workspace.drop(named, mixed)
        return still

    def removed(self) -> DataFrame:
        """Occurrences that go: doc_id, doc, place."""
        labels = self.labels()
        digest = lambda line: F.unhex(F.md5(line.cast("binary")))
        # Only lines that occur twice or have a link can go. Those that have none are not moved to learn it.
        labels = labels.withColumnRenamed("node", "uid")
        linked = maybe_among(self.lines, labels, "uid").select("uid", "n", digest(F.col("line")).alias("digest")).join(
            labels, "uid", "left").where("n > 1 or label is not null").select("digest", F.coalesce("label", "uid").alias("label"))
        alone = surely_not_among(self.lines, labels, "uid").where("n > 1").select(
            digest(F.col("line")).alias("digest"), F.col("uid").alias("label"))
        shared = self.workspace.stage(linked.union(alone), "shared")
        places = self.occurrences().select("doc_id", "doc", "place", digest(F.col("line")).alias("digest"))
        places = maybe_among(places, shared, "digest").join(shared, "digest")
        places = self.workspace.stage(places.select("doc_id", "doc", "place", "label"), "places")
        order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "doc", "place")
        first = places.groupBy("label").agg(F.min(order).alias("first"))
        first = self.workspace.stage(first, "first")
        self.workspace.drop(self.lines, shared)
        return places.join(first, "label").where(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "doc", "place") != F.col("first")).select(
            "doc_id", "doc", "place")


def line_report(spark: SparkSession, docs: DataFrame, p: LineParams = LineParams()) -> DataFrame:
    """Per row: doc_id, n_lines, n_removed, kept_sha256 (of the text that stays; null for a null text)."""
    clean = _cleaned(spark, docs.select("doc_id", "text"), p, None)
    return clean.select(
        F.col("row.doc_id").alias("doc_id"),
        F.when(F.col("row.text").isNull(), 0).otherwise(F.size(F.split("row.text", "\n"))).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.sha2(F.col("clean").cast("binary"), 256).alias("kept_sha256"),
    )


def _cleaned(spark: SparkSession, docs: DataFrame, p: LineParams, workspace: Workspace | None) -> DataFrame:
    """Rows (row, clean, gone): the document, its text without the removed lines, and their places."""
    job = LineClasses(spark, docs.where("text is not null").select("doc_id", "text"), p, workspace)
    gone = job.removed().groupBy("doc_id", "doc").agg(F.collect_set("place").alias("gone"))
    gone = job.workspace.stage(gone.withColumnRenamed("doc_id", "of").withColumnRenamed("doc", "hash"), "gone")
    rows = docs.select(F.struct("*").alias("row"), LineClasses.document(F.col("text")).alias("doc"))
    # Texts that lose no line are not moved.
    ids = gone.select(F.col("hash").alias("doc"))
    losing, whole = maybe_among(rows, ids, "doc"), surely_not_among(rows, ids, "doc")
    losing = losing.join(gone, (losing["doc"] == gone["hash"]) & losing["row.doc_id"].eqNullSafe(gone["of"]), "left")
    rows = losing.select("row", "gone").union(whole.select("row", F.lit(None).cast("array<int>").alias("gone")))
    stay = lambda lines: F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone")), lambda k: F.get(lines, k))
    clean = F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(
        F.array_join(let(F.split("row.text", "\n"), stay), "\n"))
    return rows.select("row", clean.alias("clean"), "gone")


def without_repeated_lines(spark: SparkSession, docs: DataFrame, p: LineParams = LineParams(),
                           workspace: Workspace | None = None) -> DataFrame:
    """The documents with repeated lines taken out of their texts; a document may end up empty."""
    clean = _cleaned(spark, docs, p, workspace)
    columns = [F.col("clean").alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return clean.select(*columns)
