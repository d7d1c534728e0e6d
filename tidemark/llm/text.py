"""Words, word hashes and session settings shared by the operators of this folder."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import tune

WORD = r"[^\x20\x09-\x0D]+"
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
# Rows that one Arrow batch may hold: very long texts must not pile up in a Python worker.
ARROW_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}

_BYTE_VALUE = np.random.default_rng(1).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_CHUNK = 1 << 18
_powers: list[np.ndarray] = []


_shipped: set[str] = set()


def _ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application; Spark serves the driver's copy to executors."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="tidemark-code-")) / "tidemark.zip"
    with zipfile.ZipFile(archive, "w") as code:
        for source in sorted(package.rglob("*.py")):
            code.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def prepare(spark: SparkSession) -> SparkSession:
    _ship(spark)
    tune(spark)
    for key, value in ARROW_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def encoded(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers that spreads every input bit."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _power_tables(length: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < length:
        size = max(length, _CHUNK)
        tables = []
        for base in (_BASE, _INVERSE):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            tables.append(np.cumprod(table))
        _powers[:] = tables
    return _powers


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end byte of every word."""
    space = np.ones(len(data) + 2, bool)
    space[1:-1] = (data == 32) | (data - np.uint8(9) < 5)
    edges = np.flatnonzero(space[1:] != space[:-1])
    return edges[::2], edges[1::2]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word: differences of one running polynomial, shifted back to position zero."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + _CHUNK, "right")))
        low, high = int(starts[i]), int(ends[j - 1])
        power, inverse = _power_tables(high - low)
        running = np.zeros(high - low + 1, np.uint64)
        np.cumsum(_BYTE_VALUE[data[low:high]] * power[: high - low], out=running[1:])
        first = starts[i:j] - low
        out[i:j] = (running[ends[i:j] - low] - running[first]) * inverse[first]
        i = j
    return mix(out)


def ascending(keys: np.ndarray) -> np.ndarray:
    """Stable ascending order of 64-bit keys: sorted as numbers that end in their place, which is faster than argsort."""
    bits, at = len(keys).bit_length(), np.arange(len(keys), dtype=np.uint64)
    small = not len(keys) or int(keys.max()) >> (64 - bits) == 0
    places = (keys << bits if small else keys >> bits << bits) | at
    places.sort()
    order = (places & ((1 << bits) - 1)).astype(np.int64)
    found = keys[order]
    return order if small or (found[1:] >= found[:-1]).all() else np.argsort(keys, kind="stable")


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys ascending, first place, place among the distinct ones of every key, number of each."""
    order = ascending(keys)
    found = keys[order]
    new = np.ones(len(found), bool)
    new[1:] = found[1:] != found[:-1]
    starts = np.flatnonzero(new)
    which = np.empty(len(keys), np.int64)
    which[order] = np.cumsum(new) - 1
    return found[starts], order[starts], which, np.diff(starts, append=len(found))


def text_hashes(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    return word_hashes(raw, *word_bounds(raw))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of `size` words; empty if there are fewer."""
    if len(words) < size:
        return np.empty(0, np.uint64)
    last = len(words) - size + 1
    run = np.full(last, size, np.uint64)
    for k in range(size):
        run = mix(run + words[k : k + last]) * _BASE
    return run


def shingle_set(data: bytes, size: int) -> np.ndarray:
    """Sorted distinct hashes of `size`-word shingles; fewer words count as one shingle, none as no shingle."""
    words = text_hashes(data)
    return np.unique(window_hashes(words, max(1, min(size, len(words)))))


def folder_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, by `modulus`; null without an id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def let(value: Column, body) -> Column:
    """body(value) with the value computed once, also where a lambda of the body uses it for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _marked(rows: DataFrame, ids: DataFrame, column: str, bits: int, how: str) -> tuple[DataFrame, Column]:
    """The rows beside a filter of `bits` bits over the `column` of `ids`, and whether the filter holds theirs."""
    slot = F.pmod(F.xxhash64(column), F.lit(bits))
    place, mark = F.shiftright(slot, 6), F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63)).cast("int"))
    marked = ids.groupBy(place.alias("_place")).agg(F.bit_or(mark).alias("_marks"))
    held = F.coalesce(F.col("_marks").bitwiseAND(mark) != 0, F.lit(False))
    return rows.join(F.broadcast(marked), place == marked["_place"], how), held


def maybe_among(rows: DataFrame, ids: DataFrame, column: str, bits: int = 1 << 24) -> DataFrame:
    """The rows whose `column` is that of a row of `ids`, and few others: a filter of `bits` bits, which is what is
    broadcast whatever the number of ids, keeps wide rows that no join needs from being shuffled for it."""
    held, among = _marked(rows, ids, column, bits, "inner")
    return held.where(among).select(*rows.columns)


def surely_not_among(rows: DataFrame, ids: DataFrame, column: str, bits: int = 1 << 24) -> DataFrame:
    """The rows that `maybe_among` leaves out: none has a partner in `ids`, so a left join need not move them."""
    held, among = _marked(rows, ids, column, bits, "left")
    return held.where(~among).select(*rows.columns)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
