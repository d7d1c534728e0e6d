"""CSV files with a header, one per table, to typed DataFrames."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.sources.shop import ShopTables

# Which part of a file name identifies each role, and its schema.
ROLES = {
    "orders": ("orders", schemas.ORDERS),
    "customers": ("customers", schemas.CUSTOMERS),
    "items": ("order_items", schemas.ITEMS),
    "products": ("products", schemas.PRODUCTS),
    "translation": ("product_category_name_translation", schemas.TRANSLATION),
    "payments": ("order_payments", schemas.PAYMENTS),
}
OPTIONAL_ROLES = {"translation", "payments"}


def table_name(file_name: str) -> str:
    """Table name of a CSV file: the name without "_dataset.csv" or ".csv"."""
    return file_name.removesuffix(".csv").removesuffix("_dataset")


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The declared columns, found by header name and cast to their types.

    Files may hold more columns in any order. Nothing is inferred, so only the
    header line is read before the query runs, and the parser reads just the
    selected columns.
    """
    raw = spark.read.option("header", True).csv(path)
    return raw.select(*[F.col(field.name).cast(field.dataType) for field in schema.fields])


def read_csv_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """An absent optional file counts as an empty table of the declared schema."""
    try:
        return read_csv(spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def load_csv_folder(
    spark: SparkSession, folder: str, prefix: str = "", files: dict[str, str] | None = None
) -> ShopTables:
    """All six roles from a folder.

    File names default to <prefix><table>_dataset.csv, and the translation table
    to <table>.csv without prefix; files overrides them by role. Required roles
    fail at once when absent.
    """
    names = {role: f"{prefix}{table}_dataset.csv" for role, (table, _) in ROLES.items()}
    names["translation"] = f"{ROLES['translation'][0]}.csv"
    names.update(files or {})
    tables = {}
    for role, (_, schema) in ROLES.items():
        read = read_csv_or_empty if role in OPTIONAL_ROLES else read_csv
        tables[role] = read(spark, f"{folder.rstrip('/')}/{names[role]}", schema)
    return ShopTables(**tables)
