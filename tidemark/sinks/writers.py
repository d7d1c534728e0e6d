"""Writers that replace an output only when its successor is complete. Each reports the rows in the output."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _publish(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """write(folder beside the path), then put that folder in the path's place.

    A write that fails leaves the old output as it was. The old one is taken away only after
    the new one stands; where two writers meet, the later one fails instead of mixing files.
    """
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    beside = lambda what: jvm.org.apache.hadoop.fs.Path(
        target.getParent(), f"_{target.getName()}-{what}-{uuid.uuid4().hex[:8]}")
    fresh, old = beside("new"), beside("old")
    try:
        write(fresh.toString())
    except BaseException:
        system.delete(fresh, True)
        raise
    replaces = system.exists(target) and system.rename(target, old)
    if not system.rename(fresh, target):
        if replaces:
            system.rename(old, target)
        raise OSError(f"cannot publish {path}")
    if replaces:
        system.delete(old, True)


def write_table(frame: DataFrame, path: str) -> int:
    """Parquet, the form every later step reads. The count comes from the footers."""
    _publish(frame.sparkSession, path, lambda folder: frame.write.parquet(folder))
    return frame.sparkSession.read.schema(frame.schema).parquet(path).count()


def write_csv(frame: DataFrame, path: str, single_file: bool = False, staged: bool = False) -> int:
    """CSV with a header. single_file is for tables with a small, known bound.

    The frame is written as Parquet first (unless it is `staged`, that is reads such a table
    already): the CSV is made from that and its rows are counted in the footers, so neither is
    the frame computed twice nor the CSV read back. Observing the rows on the way out would leave
    the session unable to ship a fitted forest (its summary holds the session, and a session that
    has observed anything does not serialise).
    """
    spark = frame.sparkSession
    counted: list[int] = []

    def write(folder: str) -> None:
        rows = f"{folder}-rows"
        source = frame
        try:
            if not staged:
                frame.write.parquet(rows)
                source = spark.read.schema(frame.schema).parquet(rows)
            out = source.coalesce(1) if single_file else source
            out.write.option("header", True).csv(folder)
            counted.append(source.count())
        finally:
            where = spark._jvm.org.apache.hadoop.fs.Path(rows)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)

    _publish(spark, path, write)
    return counted[0]


def write_document(one_row: DataFrame, path: str) -> None:
    """A one-row frame as one JSON document; null keys are kept."""
    out = one_row.coalesce(1)
    _publish(one_row.sparkSession, path, lambda folder: out.write.option("ignoreNullFields", False).json(folder))
