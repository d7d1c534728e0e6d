"""The six input roles every plan starts from."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class ShopTables:
    orders: DataFrame  # order_id, customer_id, order_status, order_purchase_timestamp
    customers: DataFrame  # customer_id, customer_unique_id
    items: DataFrame  # order_id, order_item_id, product_id, price
    products: DataFrame  # product_id, product_category_name
    translation: DataFrame  # product_category_name, product_category_name_english
    payments: DataFrame  # order_id, payment_type

    def register(self, prefix: str = "") -> None:
        """Make each table queryable by name in SQL."""
        for role in fields(self):
            getattr(self, role.name).createOrReplaceTempView(f"{prefix}{role.name}")
