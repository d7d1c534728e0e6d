"""Small JSON documents (run metadata, metrics, results) as one-row DataFrames."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_document(
    spark: SparkSession, path: str, schema: T.StructType, defaults: dict | None = None
) -> DataFrame | None:
    """The document's declared keys; a missing key takes its default.

    Without the file the result is the row of defaults, or None if there are none.
    """
    defaults = defaults or {}
    try:
        document = spark.read.schema(schema).option("multiLine", True).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        if not defaults:
            return None
        empty = [F.lit(None).cast(field.dataType).alias(field.name) for field in schema.fields]
        document = spark.range(1).select(*empty)
    filled = [
        F.coalesce(field.name, F.lit(defaults[field.name]).cast(field.dataType)).alias(field.name)
        if field.name in defaults
        else F.col(field.name)
        for field in schema.fields
    ]
    return document.select(*filled)
