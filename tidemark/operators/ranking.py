"""Exact order statistics over columns with about as many values as rows.

Nothing here sorts everything in one task. Running totals count equal values first (ties
merge on the map side, so a value shared by a third of the rows becomes one row), then
range-partition them; each range adds up its own rows where it is sorted, and is shifted by
the sum of the ranges before it. The median orders only what a sketch leaves in doubt.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.workspace import Workspace


def _adder(n_columns: int, sums: list[int]):
    """mapInArrow function: appends the running sum of some columns over the partition's rows, in their order.

    Local, so that workers get its code, not an import.
    """

    def add_up(batches):
        carried = [0] * len(sums)
        for batch in batches:
            columns = [batch.column(k) for k in range(n_columns)]
            names = list(batch.schema.names)
            for j, k in enumerate(sums):
                running = np.cumsum(columns[k].to_numpy(zero_copy_only=False).astype(np.int64)) + carried[j]
                if len(running):
                    carried[j] = int(running[-1])
                columns.append(pa.array(running, pa.int64()))
                names.append(f"running_{names[k]}")
            yield pa.RecordBatch.from_arrays(columns, names)

    return add_up


def _ranges(
    counts: DataFrame, key: str, sums: list[str], workspace: Workspace, partitions: int | None
) -> DataFrame:
    """The rows with their range partition, running sums inside it and, per sum, its offset and total.

    Keys are unique, so the ranges come out even whatever the data's skew was. A range is
    sorted and added up in the task that holds it and is written with its partition number,
    which makes that one fixed fact for the rows and for the offsets; adaptive execution may
    merge neighbouring ranges before, but never reorders them. After that no row moves:
    offsets are one row per range, and the window that adds them up and the broadcast are
    bounded by that number.
    """
    ranged = counts.repartitionByRange(*([partitions] if partitions else []), key)
    ranged = ranged.sortWithinPartitions(key).withColumn("part", F.spark_partition_id())
    schema = T.StructType([*ranged.schema.fields, *[T.StructField(f"running_{s}", T.LongType()) for s in sums]])
    added = ranged.mapInArrow(_adder(len(ranged.columns), [ranged.columns.index(s) for s in sums]), schema)
    table = workspace.stage(added, "ranges")

    per_part = table.groupBy("part").agg(*[F.sum(s).alias(f"part_{s}") for s in sums])
    in_order = Window.orderBy("part")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = per_part.select(
        "part",
        *[(F.sum(f"part_{s}").over(so_far) - F.col(f"part_{s}")).alias(f"offset_{s}") for s in sums],
        *[F.sum(f"part_{s}").over(everything).alias(f"total_{s}") for s in sums],
    )
    return table.join(F.broadcast(offsets), "part")


def running_totals(
    counts: DataFrame, key: str, sums: list[str], workspace: Workspace, partitions: int | None = None
) -> DataFrame:
    """Ascending running sums over a table with one row per key.

    Adds before_<sum> (over all smaller keys) and total_<sum>.
    """
    ranges = _ranges(counts, key, sums, workspace, partitions)
    before = [(F.col(f"offset_{s}") + F.col(f"running_{s}") - F.col(s)).alias(f"before_{s}") for s in sums]
    return ranges.select(*counts.columns, *before, *[f"total_{s}" for s in sums])


def exact_median(values: DataFrame, column: str, accuracy: int = 10_000) -> DataFrame:
    """One row with the exact median (mean of the middle two for an even count).

    A quantile sketch, merged from the map side, gives two values around the middle ranks; a
    second pass counts the values below them; only values between them (4 / accuracy of the
    rows, equal ones counted first) are ordered. Should the middle ranks lie outside, the
    bracket is widened to all values. All of it is one lazy plan: no row is shuffled but
    those counts, nothing is staged.
    """
    known = values.filter(F.col(column).isNotNull()).select(F.col(column).alias("v"))
    slack = min(0.5, 2.0 / accuracy)
    around = F.percentile_approx("v", F.array(F.lit(0.5 - slack), F.lit(0.5 + slack)), F.lit(accuracy))
    sketch = known.agg(F.count("*").alias("n"), F.min("v").alias("least"), F.max("v").alias("most"), around.alias("q"))
    s = sketch.select(F.struct(
        "n", "least", "most", F.col("q")[0].alias("low"), F.col("q")[1].alias("high"),
        F.expr("(n - 1) DIV 2").alias("lower"), F.expr("n DIV 2").alias("upper"))).scalar()
    below = known.withColumn("s", s).agg(
        F.any_value("s").alias("s"),
        F.count_if(F.col("v") < F.col("s.low")).alias("below"),
        F.count_if(F.col("v") <= F.col("s.high")).alias("reached"),
    )
    inside = (F.col("below") <= F.col("s.lower")) & (F.col("reached") > F.col("s.upper"))
    bracket = below.select(F.struct(
        F.when(inside, F.col("s.low")).otherwise(F.col("s.least")).alias("low"),
        F.when(inside, F.col("s.high")).otherwise(F.col("s.most")).alias("high"),
        F.when(inside, F.col("below")).otherwise(0).alias("below"),
        F.col("s.lower").alias("lower"), F.col("s.upper").alias("upper"))).scalar()
    counts = known.filter(F.col("v").between(bracket.getField("low"), bracket.getField("high"))).groupBy("v").agg(
        F.count("*").alias("n"))
    in_order = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.withColumn("b", bracket).select(
        "v", "b", (F.col("b.below") + F.sum("n").over(in_order) - F.col("n")).alias("before"))
    at_lower = F.max(F.when(F.col("before") <= F.col("b.lower"), F.col("v")))
    at_upper = F.max(F.when(F.col("before") <= F.col("b.upper"), F.col("v")))
    return ranked.agg(((at_lower + at_upper) / 2).alias("median"))
