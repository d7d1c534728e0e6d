"""Order-level facts: one row per completed order, with value and category.

Shuffle layout of the full fact: everything keyed by order meets first (orders,
basket totals, voucher flags: one exchange each on order_id), then the category
look-up, and the customer look-up last, so that the customer-level aggregates
that follow can reuse its partitioning.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import from_cents, to_cents
from tidemark.params import Params
from tidemark.sources.shop import ShopTables


def placed_orders(
    orders: DataFrame, status: str, as_of: date | None = None, after: date | None = None
) -> DataFrame:
    """Orders in the given status, optionally only those in (after, as_of].

    The date limits are literals on the raw timestamp, which the scan can use to
    skip row groups; a condition on to_date() would not reach it.
    """
    kept = orders.filter(F.col("order_status") == status)
    if as_of is not None:
        kept = kept.filter(F.col("order_purchase_timestamp") < _midnight(as_of + timedelta(days=1)))
    if after is not None:
        kept = kept.filter(F.col("order_purchase_timestamp") >= _midnight(after + timedelta(days=1)))
    return kept.select("order_id", "customer_id", "order_purchase_timestamp")


def _midnight(day: date):
    return F.lit(day.isoformat()).cast("timestamp_ntz")


def with_customer(placed: DataFrame, customers: DataFrame) -> DataFrame:
    """Replace the order's customer id by the person's id; add the order date.

    customer_id is unique on the right, so a hot customer only makes the left
    side heavy, which AQE splits while it copies the single matching row.
    """
    people = customers.select("customer_id", "customer_unique_id")
    return (
        placed.join(people, "customer_id")
        .drop("customer_id")
        .withColumn("order_date", F.to_date("order_purchase_timestamp"))
    )


_ITEM_NUMBERS = {"tinyint", "smallint", "int"}
_PRODUCT_KEYS = {"tinyint", "smallint", "int", "bigint"}
# Pairs below these bounds share one long; all others, missing values among them, one decimal.
_ITEM_BITS, _PRODUCT_BITS = 20, 42
_PRODUCT_SPAN = 1 << 65


def _decimal(value: int, digits: int) -> Column:
    return F.lit(str(value)).cast(f"decimal({digits},0)")


def _first_product(items: DataFrame, counts: Column) -> Column:
    """Product of the least (item number, product) among the items that count, a missing value below all others.

    With integer columns the pair is packed in one number, item number first, so that the
    minimum has a fixed width and the aggregate hashes. Other types (text ids) take the minimum of
    the pair itself, which makes Spark aggregate by sorting.
    """
    kinds = dict(items.dtypes)
    number, product = F.col("order_item_id"), F.col("product_id")
    if kinds["order_item_id"] not in _ITEM_NUMBERS or kinds["product_id"] not in _PRODUCT_KEYS:
        return F.min(F.when(counts, F.struct(number, product))).getField("product_id")
    number, product = number.cast("int"), product.cast("bigint")
    small = F.coalesce(
        number.between(0, (1 << _ITEM_BITS) - 1) & product.between(0, (1 << _PRODUCT_BITS) - 1), F.lit(False))
    narrow = F.min(F.when(counts & small, F.shiftleft(number.cast("bigint"), _PRODUCT_BITS).bitwiseOR(product)))
    shifted = lambda value, kind, low: F.coalesce(value.cast(kind) + _decimal(1 - low, 20), _decimal(0, 1))
    packed = (
        (shifted(number, "decimal(10,0)", -(1 << 31)).cast("decimal(11,0)") * _decimal(_PRODUCT_SPAN, 20)).cast("decimal(37,0)")
        + shifted(product, "decimal(19,0)", -(1 << 63)).cast("decimal(20,0)")
    )
    wide = F.min(F.when(counts & ~small, packed.cast("decimal(38,0)")))
    key, head = wide % _decimal(_PRODUCT_SPAN, 20), F.call_function("div", wide, _decimal(_PRODUCT_SPAN, 20))
    wide_pair = F.struct(
        F.when(head > 0, head - F.lit((1 << 31) + 1)).alias("number"),
        F.when(key > 0, (key - _decimal(1 + (1 << 63), 20)).cast("bigint")).alias("product"))
    narrow_pair = F.struct(
        F.shiftright(narrow, _PRODUCT_BITS).alias("number"),
        narrow.bitwiseAND(F.lit((1 << _PRODUCT_BITS) - 1)).alias("product"))
    least = F.when(wide.isNull(), narrow_pair).when(narrow.isNull(), wide_pair).otherwise(F.least(narrow_pair, wide_pair))
    return F.when(narrow.isNotNull() | wide.isNotNull(), least.getField("product")).cast(kinds["product_id"])


def order_baskets(items: DataFrame, category_pick: str = "lowest") -> DataFrame:
    """Value and first product per order, from one aggregate over the items.

    "lowest" takes the product of the smallest item number (ties: the smallest
    product id); "equals_one" takes only an item numbered exactly 1. Both are
    partial aggregates, so an order with very many items costs one row per map
    task.
    """
    if category_pick not in ("lowest", "equals_one"):
        raise ValueError(f"unknown category_pick: {category_pick}")
    counts = F.col("order_item_id") == 1 if category_pick == "equals_one" else F.lit(True)
    return items.groupBy("order_id").agg(
        F.sum(to_cents(F.col("price"))).alias("order_cents"),
        _first_product(items, counts).alias("product_id"),
    )


def order_totals(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(F.sum(to_cents(F.col("price"))).alias("order_cents"))


def order_value(items: DataFrame) -> DataFrame:
    totals = order_totals(items)
    return totals.select("order_id", from_cents(F.col("order_cents")).alias("order_value"))


def product_categories(products: DataFrame, translation: DataFrame, unknown: str) -> DataFrame:
    """One category name per product: translated, else original, else unknown."""
    named = products.select("product_id", "product_category_name").join(
        translation, "product_category_name", "left"
    )
    category = F.coalesce("product_category_name_english", "product_category_name", F.lit(unknown))
    return named.select("product_id", category.alias("category"))


def order_category(
    items: DataFrame, products: DataFrame, translation: DataFrame, unknown: str,
    category_pick: str = "lowest",
) -> DataFrame:
    """Category of each order's first item; an item of no known product gives none."""
    baskets = order_baskets(items, category_pick).select("order_id", "product_id")
    known = product_categories(products, translation, unknown)
    return baskets.join(known, "product_id").select("order_id", "category")


def voucher_orders(payments: DataFrame, voucher_type: str) -> DataFrame:
    """The distinct orders paid at least partly by voucher."""
    return payments.filter(F.col("payment_type") == voucher_type).select("order_id").distinct()


def customer_order_fact(
    placed: DataFrame,
    tables: ShopTables,
    params: Params,
    value: bool = True,
    category: bool = True,
    voucher: bool = False,
) -> DataFrame:
    """One row per placed order of a known customer, with the parts asked for.

    Each part costs a join that Spark cannot drop by itself (it does not know
    that the keys are unique), so tables that need less should ask for less.
    """
    joined, parts = placed, []
    if category:
        joined = joined.join(order_baskets(tables.items, params.category_pick), "order_id", "left")
    elif value:
        joined = joined.join(order_totals(tables.items), "order_id", "left")
    if voucher:
        paid = voucher_orders(tables.payments, params.voucher_type)
        joined = joined.join(paid.withColumn("used_voucher", F.lit(1)), "order_id", "left")
        parts.append(F.coalesce("used_voucher", F.lit(0)).alias("used_voucher"))
    if value:
        parts.append(F.coalesce("order_cents", F.lit(0).cast("bigint")).alias("order_cents"))
    if category:
        unknown = params.unknown_category
        known = product_categories(tables.products, tables.translation, unknown)
        joined = joined.join(known, "product_id", "left")
        parts.append(F.coalesce("category", F.lit(unknown)).alias("category"))
    return with_customer(joined, tables.customers).select(
        "order_id", "customer_unique_id", "order_purchase_timestamp", "order_date", *parts
    )


def present_fact(fact: DataFrame) -> DataFrame:
    """The fact as its consumers outside the library see it: money as double."""
    return fact.select(
        "order_id",
        "customer_unique_id",
        "order_purchase_timestamp",
        "order_date",
        from_cents(F.col("order_cents")).alias("order_value"),
        "category",
    )
