"""The hand-made shop: seven orders with every edge of the order semantics."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.sources import ShopTables

ORDERS = [
    ("o1", "c1", "delivered", "2018-01-10 09:00:00"),
    ("o2", "c2", "delivered", "2018-03-11 23:59:59"),
    ("o3", "c3", "delivered", "2018-01-31 00:00:00"),
    ("o4", "c4", "delivered", "2018-02-01 10:00:00"),
    ("o5", "c5", "delivered", "2018-02-01 18:00:00"),
    ("o6", "c6", "delivered", "2018-06-30 12:00:00"),
    ("o7", "c7", "canceled", "2018-07-15 12:00:00"),
]
CUSTOMERS = [
    ("c1", "U1"), ("c2", "U1"), ("c3", "U2"), ("c4", "U3"), ("c5", "U3"), ("c6", "U3"), ("c7", "U4"),
]
ITEMS = [
    ("o1", 1, "p1", "10.0"), ("o1", 2, "p2", "5.5"), ("o2", 1, "p2", "20.0"), ("o3", 1, "p3", "7.0"),
    ("o4", 1, "p1", "30.0"), ("o5", 1, "p9", "12.0"), ("o7", 1, "p1", "99.0"),
]
PRODUCTS = [("p1", "beleza_saude"), ("p2", "pc_gamer"), ("p3", None)]
TRANSLATION = [("beleza_saude", "health_beauty")]
PAYMENTS = [
    ("o1", "credit_card"), ("o2", "voucher"), ("o2", "voucher"), ("o2", "credit_card"),
    ("o3", "boleto"), ("o4", "credit_card"), ("o6", "voucher"),
]


def shop(spark: SparkSession, items=None) -> ShopTables:
    orders = spark.createDataFrame(
        ORDERS, "order_id string, customer_id string, order_status string, ts string"
    ).select(
        "order_id",
        "customer_id",
        "order_status",
        F.col("ts").cast("timestamp_ntz").alias("order_purchase_timestamp"),
    )
    priced = [(o, n, p, Decimal(price)) for o, n, p, price in (items or ITEMS)]
    return ShopTables(
        orders=orders,
        customers=spark.createDataFrame(CUSTOMERS, schemas.CUSTOMERS),
        items=spark.createDataFrame(priced, schemas.ITEMS),
        products=spark.createDataFrame(PRODUCTS, schemas.PRODUCTS),
        translation=spark.createDataFrame(TRANSLATION, schemas.TRANSLATION),
        payments=spark.createDataFrame(PAYMENTS, schemas.PAYMENTS),
    )
