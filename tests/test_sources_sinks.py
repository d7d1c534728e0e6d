from __future__ import annotations

import json
import os
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrameReader
from pyspark.sql import functions as F

from shop_fixture import shop
from tidemark import schemas
from tidemark.sinks import write_csv, write_document, write_table
from tidemark.sources import load_csv_folder, read_document, table_name
from tidemark.workspace import Workspace, shared_root


class Context:
    """A session without spark.checkpoint.dir, on the given master."""

    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder
        self.sparkContext = self.conf = self

    def get(self, key, default):
        return default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder

FILES = {
    "shop_orders_dataset.csv": (
        '"order_id","customer_id","order_status","order_purchase_timestamp","order_approved_at"\n'
        '"o1","c1","delivered","2018-01-10 09:00:00","2018-01-10 09:10:00"\n'
        '"o2","c2","canceled","2018-02-11 23:59:59",\n'
    ),
    "shop_customers_dataset.csv": (
        '"customer_id","customer_unique_id","customer_city"\n"c1","u1","a, b"\n"c2","u2","x"\n'
    ),
    "shop_order_items_dataset.csv": (
        '"order_id","order_item_id","product_id","seller_id","price","freight_value"\n'
        '"o1",1,"p1","s1",58.90,13.29\n"o1",2,"p2","s1",1.05,0\n'
    ),
    "shop_products_dataset.csv": (
        '"product_id","product_category_name","product_name_lenght"\n"p1","livros",4\n"p2",,3\n'
    ),
}


@pytest.fixture()
def folder(tmp_path):
    for name, text in FILES.items():
        (tmp_path / name).write_text(text)
    return tmp_path


def test_table_names():
    assert table_name("shop_orders_dataset.csv") == "shop_orders"
    assert table_name("product_category_name_translation.csv") == "product_category_name_translation"


def test_csv_folder_by_header_name(spark, folder):
    tables = load_csv_folder(spark, str(folder), prefix="shop_")
    assert tables.orders.schema == schemas.ORDERS
    assert tables.items.schema == schemas.ITEMS
    assert tables.orders.first().order_purchase_timestamp == datetime(2018, 1, 10, 9)
    assert [r.price for r in tables.items.collect()] == [Decimal("58.90"), Decimal("1.05")]
    assert [r.product_category_name for r in tables.products.collect()] == ["livros", None]
    tables.register("raw_")
    assert spark.sql("SELECT count(*) AS n FROM raw_orders").first().n == 2


def test_optional_files_are_empty_and_required_ones_fail(spark, folder):
    tables = load_csv_folder(spark, str(folder), prefix="shop_")
    assert tables.payments.count() == 0 and tables.payments.schema == schemas.PAYMENTS
    assert tables.translation.count() == 0
    with pytest.raises(AnalysisException):
        load_csv_folder(spark, str(folder), prefix="other_")
    with pytest.raises(AnalysisException):
        load_csv_folder(spark, str(folder), prefix="shop_", files={"orders": "nothing.csv"})


def test_documents_take_defaults_by_key(spark, tmp_path):
    path = tmp_path / "metadata.json"
    path.write_text(json.dumps({"churn_threshold": 138}, indent=4))
    defaults = {"churn_threshold": 60, "snapshot_date": "2018-08-30"}
    got = read_document(spark, str(path), schemas.RUN_METADATA, defaults).first()
    assert tuple(got) == (138, "2018-08-30")
    assert read_document(spark, str(path), schemas.RUN_METADATA).first().snapshot_date is None
    missing = str(tmp_path / "absent.json")
    assert read_document(spark, missing, schemas.RUN_METADATA) is None
    assert tuple(read_document(spark, missing, schemas.RUN_METADATA, defaults).first()) == (60, "2018-08-30")


def test_writers_replace_and_count(spark, tmp_path):
    people = spark.createDataFrame([("a", 1.5), ("b", None)], "customer_unique_id string, clv double")
    csv, table = str(tmp_path / "out.csv"), str(tmp_path / "out")
    for _ in range(2):
        assert write_csv(people, csv, single_file=True) == 2
        assert write_table(people, table) == 2
    assert spark.read.parquet(table).count() == 2
    parts = [f for f in os.listdir(csv) if f.startswith("part-")]
    assert len(parts) == 1
    with open(os.path.join(csv, parts[0])) as handle:
        assert handle.read().splitlines()[0] == "customer_unique_id,clv"


def test_document_round_trip_keeps_nulls(spark, tmp_path):
    path = str(tmp_path / "doc.json")
    one = spark.createDataFrame([(138, None)], schemas.RUN_METADATA)
    write_document(one, path)
    part = next(f for f in os.listdir(path) if f.startswith("part-"))
    with open(os.path.join(path, part)) as handle:
        assert json.load(handle) == {"churn_threshold": 138, "snapshot_date": None}
    assert tuple(read_document(spark, path, schemas.RUN_METADATA).first()) == (138, None)


def test_workspace_lives_in_the_shared_folder(spark):
    with Workspace(spark) as workspace:
        assert workspace.path.startswith(shared_root(spark))
        staged = workspace.stage(shop(spark).orders, "orders")
        assert staged.schema == shop(spark).orders.schema
        assert staged.count() == 7
        assert os.path.isdir(workspace.path)
    assert not os.path.isdir(workspace.path)


def test_shared_root_never_is_a_local_folder_on_a_cluster():
    with pytest.raises(ValueError):
        shared_root(Context("spark://host:7077"))
    assert shared_root(Context("spark://host:7077", "hdfs:///shared")) == "hdfs:///shared"
    local = Context("local[2]")
    assert os.path.isdir(shared_root(local)) and shared_root(local) == shared_root(local) and local.folder is None


@pytest.mark.parametrize("write", [write_table, write_csv, write_document])
def test_a_failed_write_leaves_the_old_output(spark, tmp_path, write):
    path = str(tmp_path / "out")
    good = spark.createDataFrame([("a", 1)], "k string, n int")
    write(good, path)
    before = sorted(os.listdir(path))
    bad = good.select("k", F.expr("n + raise_error('no')").cast("int").alias("n"))
    with pytest.raises(Exception, match="no"):
        write(bad, path)
    assert sorted(os.listdir(path)) == before
    assert os.listdir(tmp_path) == ["out"]


def test_a_csv_is_never_read_back(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(DataFrameReader, "csv", None)
    frame = spark.range(100).select(F.col("id").cast("string").alias("k"), F.lit("line\nbreak").alias("v"))
    assert write_csv(frame, str(tmp_path / "out.csv")) == 100
    assert write_csv(frame, str(tmp_path / "out.csv"), staged=True) == 100


def test_workspace_drops_single_tables(spark):
    with Workspace(spark) as workspace:
        first, second = (workspace.stage(spark.range(3), "t") for _ in range(2))
        workspace.drop(first, spark.range(3))
        assert len(os.listdir(workspace.path)) == 1 and second.count() == 3
        workspace.drop(first)
