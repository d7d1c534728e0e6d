"""Secret scans over an incremental blob ledger, in DataFrame functions only.

Every version of every path is content-addressed by the SHA-256 of its text. The
ledger folder holds which (blob, rule, version) were scanned and what was found;
an update scans only the pairs it has not seen, and findings are joined back to
all paths that ever held the blob. A rule whose version changes is scanned anew.

A match is kept if its value (the whole match or one group) is long enough; the
pattern runs leftmost and non-overlapping before that test. Spans are code
points, end exclusive. A null text is an empty blob; a null path is a path of its
own; repeated rows are reported as often as they occur. Texts are scanned whole,
however long; an empty table scans nothing and reports nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.text import prepare
from tidemark.workspace import Workspace


@dataclass(frozen=True)
class Rule:
    name: str
    pattern: str
    least: int
    group: int = 0
    version: int = 1


# What the scan looks for. For a run of one character class, {n,} finds
# what the unbounded run with a length test would.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
    Rule("access", r"AKIA[A-Z0-9]{12,}", 16),
    Rule("hex", r"[0-9a-f]{32,}", 32),
    Rule("private", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 1),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 40),
)
BASE = ("assign", "access", "hex")


def blob_of(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def _matches(text: Column, rule: Rule) -> Column:
    """Per match: characters since the end of the match before, its length, and the length of its value."""
    pattern = F.lit(rule.pattern)
    between = F.transform(F.split(text, rule.pattern, -1), F.length)
    whole = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    value = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length)
    return F.arrays_zip(between.alias("gap"), whole.alias("size"), value.alias("value"))


class Ledger:
    """A folder with the tables `scanned` (blob, rule, version) and `findings` (with spans)."""

    def __init__(self, spark: SparkSession, path: str, rules: tuple[Rule, ...] = RULES):
        self.spark, self.path, self.rules = prepare(spark), path.rstrip("/"), rules

    def _table(self, name: str, schema: str) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        if path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        return self.spark.createDataFrame([], schema)

    @property
    def scanned(self) -> DataFrame:
        return self._table("scanned", "blob binary, rule string, version int")

    @property
    def findings(self) -> DataFrame:
        return self._table("findings", "blob binary, rule string, version int, start long, stop long").distinct()

    def update(self, versions: DataFrame) -> DataFrame:
        """Scan the unseen pairs of `versions` (path, text); returns the pairs that were scanned."""
        current = F.array(*[F.lit(f"{r.name}@{r.version}") for r in self.rules])
        blobs = versions.select("path", blob_of(F.col("text")).alias("blob")).groupBy("blob").agg(F.min("path").alias("at"))
        seen = self.scanned.groupBy("blob").agg(F.collect_set(F.concat_ws("@", "rule", "version")).alias("seen"))
        unseen = blobs.join(seen, "blob", "left").select(
            "blob", "at", F.array_except(current, F.coalesce("seen", F.array().cast("array<string>"))).alias("missing")
        ).where("size(missing) > 0")
        workspace = Workspace(self.spark)
        unseen = workspace.stage(unseen, "unseen").withColumnRenamed("blob", "todo")
        texts = versions.select("path", "text", blob_of(F.col("text")).alias("blob"))
        texts = texts.join(unseen, (texts["blob"] == unseen["todo"]) & texts["path"].eqNullSafe(unseen["at"])).select(
            "blob", "missing", "text"
        )
        hits = F.array(*[
            F.struct(
                F.lit(r.name).alias("rule"), F.lit(r.version).alias("version"), F.lit(r.least).alias("least"),
                F.when(
                    F.array_contains("missing", f"{r.name}@{r.version}") & F.col("text").rlike(r.pattern),
                    _matches(F.col("text"), r),
                ).alias("matches"),
            )
            for r in self.rules
        ])
        found = texts.select("blob", F.explode(hits).alias("h")).where("h.matches is not null").select(
            "blob", "h.rule", "h.version", "h.least", F.posexplode("h.matches").alias("at", "m")
        ).where("m.size is not null").select("blob", "rule", "version", "least", "at", "m.gap", "m.size", "m.value")
        # Rows that repeat a path and its text give the same matches: one of each by blob, whichever task made it.
        found = found.repartition("blob", "rule").dropDuplicates(["blob", "rule", "at"])
        through = Window.partitionBy("blob", "rule").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
        stop = F.sum(F.col("gap") + F.col("size")).over(through)
        spans = found.withColumn("stop", stop).where("value >= least").select(
            "blob", "rule", "version", (F.col("stop") - F.col("size")).alias("start"), "stop"
        )
        spans.write.mode("append").parquet(f"{self.path}/findings")
        done = unseen.select(F.col("todo").alias("blob"), F.explode("missing").alias("pair")).select(
            "blob", F.substring_index("pair", "@", 1).alias("rule"), F.substring_index("pair", "@", -1).cast("int").alias("version")
        )
        done.write.mode("append").parquet(f"{self.path}/scanned")
        return done

    def report(self, versions: DataFrame) -> DataFrame:
        """Per row of `versions`: path, blob, and spans, an array of (start, place of the rule, stop) in order."""
        place = {r.name: (k, r.version) for k, r in enumerate(self.rules)}
        rules = self.spark.createDataFrame([(n, v, k) for n, (k, v) in place.items()], "rule string, version int, place int")
        spans = self.findings.join(F.broadcast(rules), ["rule", "version"]).groupBy("blob").agg(
            F.array_sort(F.collect_list(F.struct("start", "place", "stop"))).alias("spans")
        )
        workspace = Workspace(self.spark)
        spans = workspace.stage(spans, "spans")
        return versions.select("path", blob_of(F.col("text")).alias("blob")).join(spans, "blob", "left").select(
            "path", "blob", F.coalesce("spans", F.array().cast(spans.schema["spans"].dataType)).alias("spans")
        )


def secrets(spark: SparkSession, docs: DataFrame, ledger: Ledger) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans (kind:start:end, comma-joined)."""
    versions = docs.select(F.col("doc_id").alias("path"), "text")
    ledger.update(versions)
    names = F.array(*[F.lit(r.name) for r in ledger.rules])
    places = [k for k, r in enumerate(ledger.rules) if r.name in BASE]
    written = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["place"]), s["start"], s["stop"])), ","
    )
    base = F.filter("spans", lambda s: s["place"].isin(places))

    def count(place: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["place"] == place)).cast("long")

    counts = [count(k).alias(f"n_{ledger.rules[k].name}") for k in places]
    return ledger.report(versions).select(
        F.col("path").alias("doc_id"), *counts, F.sha2(written(base).cast("binary"), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )
