"""Adapter from a star schema (orders, lineitem, part, customer) to the six roles."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark.params import Params
from tidemark.sources.shop import ShopTables

# Part types that have a translated name; others keep their own.
TRANSLATED_TYPES = {
    "ECONOMY": "economy",
    "LARGE": "large",
    "MEDIUM": "medium",
    "PROMO": "promo",
}
VOUCHER_DISCOUNT = 0.10

# Declared, so that building a plan reads no file footers.
SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_extendedprice double, l_discount double"
    ),
    "part": "p_partkey bigint, p_type string",
}


def star_params(params: Params | None = None) -> Params:
    """The run constants that depend on this schema's status codes and dates."""
    return replace(params or Params(), completed_status="F", split_date=date(1998, 1, 1))


def star_tables(spark: SparkSession, folder: str) -> ShopTables:
    def table(name: str):
        return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")

    lines = table("lineitem")
    pairs = F.array(
        *[
            F.struct(
                F.lit(name).alias("product_category_name"),
                F.lit(english).alias("product_category_name_english"),
            )
            for name, english in TRANSLATED_TYPES.items()
        ]
    )
    return ShopTables(
        orders=table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderstatus").alias("order_status"),
            F.col("o_orderdate").alias("order_purchase_timestamp"),
        ),
        customers=table("customer").select(
            F.col("c_custkey").alias("customer_id"), F.col("c_custkey").alias("customer_unique_id")
        ),
        items=lines.select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_extendedprice").alias("price"),
        ),
        products=table("part").select(
            F.col("p_partkey").alias("product_id"), F.col("p_type").alias("product_category_name")
        ),
        translation=spark.range(1).select(F.inline(pairs)),
        payments=lines.select(
            F.col("l_orderkey").alias("order_id"),
            F.when(F.col("l_discount") >= VOUCHER_DISCOUNT, "voucher")
            .otherwise("other")
            .alias("payment_type"),
        ),
    )
