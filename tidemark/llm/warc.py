"""WARC: archives written by Spark, and a reader that salvages damaged ones.

Writing: a record per page. Of pages with equal payloads of at least
`revisit_from` bytes the one with the smallest page_id is a response and the others
revisit it. Rows that repeat that smallest id are all responses; a null id ranks
last, so a payload found only under null ids has responses only. A record is text
that ends in the record separator, so Spark's own writer and committer make the archives.

Reading: each archive, plain or of gzip members, is walked from record to record.
A record must have a version line, a valid length, its closing blank lines and,
where it states one, the right block digest. After a failed check the reader
searches for the next member or version line that passes, recovers from there, and
logs the bytes between as a gap. An archive of no bytes has neither records nor gaps.
A task holds one archive at a time, as one binary value: archives of 2 GiB or more cannot be read and fail the job.
Time grows with the bytes of an archive, whatever its number of members. The writer ends a file after
`records_per_file` records, so with payloads beyond 100 KB on average a smaller number must be given.
Payloads, however long, are written and read whole.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.text import prepare
from tidemark.workspace import Workspace

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_VERSION = re.compile(rb"WARC/\d\.\d\r?\n")
_END = b"\r\n\r\n"
_MEMBER = b"\x1f\x8b\x08"
RECORD = ("archive string, offset long, size long, problem string, record_type string, record_id string, "
          "target_uri string, refers_to string, payload_digest string, payload_bytes long, payload binary")
_FIELDS = [f.split()[0] for f in RECORD.split(", ")]


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1: four letters from every five hexadecimal digits."""
    digest = F.sha1(data)
    letters = []
    for k in range(8):
        number = F.conv(F.substring(digest, 5 * k + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            letters.append(F.substr(F.lit(_BASE32), F.shiftright(number, shift).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*letters)


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def write_archives(spark: SparkSession, pages: DataFrame, path: str, revisit_from: int = 0,
                   date: str = "2000-01-01T00:00:00Z", records_per_file: int = 20_000) -> None:
    """Write `pages` (page_id, url, html) as plain archives below `path`."""
    prepare(spark)
    workspace = Workspace(spark)
    html = F.coalesce("html", F.lit(""))
    named = pages.select("page_id", "url", html.alias("html"), base32_sha1(html.cast("binary")).alias("digest"),
                         F.octet_length(html).alias("bytes"))
    same = named.where(F.col("bytes") >= revisit_from).groupBy("digest", "bytes").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
    same = workspace.stage(same.select(F.col("digest").alias("of"), F.col("bytes").alias("long"), "first"), "same")
    rows = named.join(same, (F.col("digest") == F.col("of")) & (F.col("bytes") == F.col("long")), "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("bytes").cast("string"), F.lit(_END.decode()))
    block = F.when(again, head).otherwise(F.concat(head, F.col("html")))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    uri = F.regexp_replace(F.trim(F.col("url")), r"[\x00-\x20\x7F]", "%20")
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", _urn(F.col("page_id"))),
        line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", uri), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("WARC-Block-Digest", F.concat(F.lit("sha1:"), base32_sha1(F.col("block").cast("binary")))),
        F.when(again, F.concat(
            line("WARC-Refers-To", _urn(F.col("first"))),
            line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        )).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length("block").cast("string")),
        F.lit("\r\n"), F.col("block"),
    )
    rows.withColumn("block", block).select(record.alias("value")).write.option("lineSep", _END.decode()).option(
        "maxRecordsPerFile", records_per_file).text(path)


def sha1_text(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _headers(data: bytes, start: int) -> tuple[dict[str, str], int] | str:
    """Header fields and where the block starts, or what is wrong."""
    version = _VERSION.match(data, start)
    if not version:
        return "no version line"
    end = data.find(_END, version.end() - 2)
    if end < 0:
        return "headers do not end"
    fields: dict[str, str] = {}
    for raw in data[version.end() : end].split(b"\r\n"):
        name, colon, value = raw.partition(b":")
        if not colon:
            return "malformed header"
        fields[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    return fields, end + len(_END)


def record_at(data: bytes, start: int) -> tuple[dict[str, str], bytes, int] | str:
    """Fields, block and end of the record at `start`, or which check failed."""
    found = _headers(data, start)
    if isinstance(found, str):
        return found
    fields, body = found
    length = fields.get("content-length", "")
    if not length.isdecimal():
        return "no valid length"
    end = body + int(length)
    if end > len(data):
        return "truncated"
    if data[end : end + 4] != _END:
        return "record does not end"
    block = data[body:end]
    stated = fields.get("warc-block-digest", "")
    if stated.lower().startswith("sha1:") and stated[5:].upper() != sha1_text(block):
        return "block digest differs"
    return fields, block, end + 4


def _plain(data: bytes) -> Iterator[tuple[int, int, object]]:
    """(offset, end, record or reason of the gap)."""
    at = 0
    while at < len(data):
        found = record_at(data, at)
        if not isinstance(found, str):
            yield at, found[2], found
            at = found[2]
            continue
        problem, gap = found, at
        while True:
            version = _VERSION.search(data, at + 1)
            if version is None:
                at = len(data)
                break
            at = version.start()
            if not isinstance(record_at(data, at), str):
                break
        yield gap, at, problem


def _before_fault(data: bytes, at: int) -> tuple[bytes, list[tuple[int, int]], bool]:
    """What a damaged member yields before its fault, (bytes out, bytes in) on the way, and whether it is only cut off."""
    inflate, parts, marks, out = zlib.decompressobj(31), [], [], 0
    step, cut, view = max(1, min(1 << 12, (len(data) - at) >> 16)), True, memoryview(data)
    while at < len(data) and not inflate.eof:
        before = inflate.copy()
        try:
            part = inflate.decompress(view[at : at + step])
        except zlib.error:
            if step == 1:
                cut = False
                break
            inflate, step = before, 1
            continue
        at, out = at + step, out + len(part)
        parts.append(part)
        marks.append((out, min(at, len(data))))
    return b"".join(parts), marks, cut


def _rescued(data: bytes, at: int) -> tuple[list, int]:
    """Records of a damaged member that end before its fault, and where what yielded them ends.

    The one at which the yield ends goes with the fault. If the member is not only cut off, its bytes
    may be wrong from anywhere, so records count only with a block digest.
    """
    text, marks, cut = _before_fault(data, at)
    found = [(end, r) for _, end, r in _plain(text) if isinstance(r, tuple) and end < len(text) and (
        cut or r[0].get("warc-block-digest", "").lower().startswith("sha1:"))]
    if not found:
        return [], at
    return [r for _, r in found], next(read for out, read in marks if out >= found[-1][0])


def _inflated(view: memoryview, at: int) -> tuple[bytes, int]:
    """The member at `at`, inflated in growing steps, and where it ends: no more of the archive is touched than that."""
    inflate, parts, step = zlib.decompressobj(31), [], 1 << 12
    while at < len(view) and not inflate.eof:
        parts.append(inflate.decompress(view[at : at + step]))
        at, step = min(at + step, len(view)), min(2 * step, 1 << 20)
    if not inflate.eof:
        raise zlib.error("truncated member")
    return b"".join(parts), at - len(inflate.unused_data)


def _members(data: bytes) -> Iterator[tuple[int, int, object]]:
    """As _plain, with the offsets of gzip members; a damaged member yields its records before the fault."""
    at, gap, problem, view = 0, None, "", memoryview(data)
    while at < len(data):
        try:
            text, end = _inflated(view, at)
            inside = list(_plain(text))
            if not any(isinstance(r, tuple) for _, _, r in inside):
                raise zlib.error("no valid record in member")
        except zlib.error as error:
            rescued, read = _rescued(data, at) if data.startswith(_MEMBER, at) else ([], at)
            if rescued:
                if gap is not None:
                    yield gap, at, problem
                for record in rescued:
                    yield at, read, record
                gap = None
            if gap is None:
                gap, problem = read, str(error)
            following = data.find(_MEMBER, max(at + 1, read))
            at = len(data) if following < 0 else following
            continue
        if gap is not None:
            yield gap, at, problem
            gap = None
        for _, _, record in inside:
            yield at, end, record
        at = end
    if gap is not None:
        yield gap, at, problem


def salvage(data: bytes) -> Iterator[tuple[int, int, object]]:
    """(offset, size, record or reason) over a whole archive; a record is (fields, block, end)."""
    member = data.find(_MEMBER)
    version = _VERSION.search(data)
    walk = _members if member >= 0 and (version is None or member < version.start()) else _plain
    for start, end, found in walk(data):
        yield start, end - start, found


def _row(archive: str, start: int, size: int, found: object, payloads: bool) -> tuple:
    if isinstance(found, str):
        return archive, start, size, found, None, None, None, None, None, None, None
    fields, block, _ = found
    kind, payload, count = fields.get("warc-type"), block, None
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if "application/http" in fields.get("content-type", ""):
        head, _, payload = block.partition(_END)
        if kind == "revisit":
            told = re.search(rb"(?im)^content-length:\s*(\d+)", head)
            count, payload = (int(told[1]) if told else None), None
    if payload is not None and kind != "revisit":
        count, digest = len(payload), sha1_text(payload)
    return (archive, start, size, None, kind, fields.get("warc-record-id"), fields.get("warc-target-uri"),
            fields.get("warc-refers-to"), digest, count, payload if payloads else None)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record, with `problem` null, and one per quarantined gap, with only archive, offset, size, problem."""
    prepare(spark)

    def scan(batches):
        for batch in batches:
            for archive, data in zip(batch["path"], batch["content"]):
                rows, held = [], 0
                for start, size, found in salvage(data):
                    rows.append(_row(archive, start, size, found, payloads))
                    held += size if payloads else 0
                    if held > 4 << 20 or len(rows) >= 5000:
                        yield pd.DataFrame(rows, columns=_FIELDS)
                        rows, held = [], 0
                yield pd.DataFrame(rows, columns=_FIELDS)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(scan, RECORD)


def page_records(records: DataFrame) -> DataFrame:
    """The archived pages: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    page = lambda urn: F.expr(f"try_cast(regexp_extract({urn}, '<urn:page:(.*)>', 1) as bigint)")
    return records.where("problem is null").select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page("refers_to").alias("refers_to"))


def archived_pages(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write all pages and read the archives back."""
    path = f"{Workspace(spark).path}/warc"
    write_archives(spark, pages, path)
    return page_records(read_archives(spark, path, payloads=False))
