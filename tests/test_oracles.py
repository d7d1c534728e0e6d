"""Every registered query with an oracle, row by row against DuckDB at sf0.01."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as contract
from conftest import MEDIUM
from tidemark.plans.catalog import registered

QUERIES, ORACLES = dict(registered()), {k: v for k, v in contract.oracle_sql().items() if k in registered()}
# Iterative fits: no SQL form.
ROWS_ONLY = {"model_coefficients", "model_importances", "churn_scores", "model_quality", "model_reports"}
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}

# Anchors of the test tables at this scale.
ANCHOR_ROWS = {"order_fact": 4933, "rfm": 1429, "cohort_retention": 1930, "purchase_gaps": 3504, "cohort_sizes": 79}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(MEDIUM):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{MEDIUM}/{file}'")
    return con


def comparable(rows, order):
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def test_only_the_fits_lack_an_oracle():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, duck, name):
    frame = QUERIES[name](spark, MEDIUM)
    got = [tuple(row) for row in frame.collect()]
    cursor = duck.execute(ORACLES[name])
    names = [column[0] for column in cursor.description]
    types = {column[0]: str(column[1]) for column in cursor.description}
    expected = cursor.fetchall()
    assert sorted(frame.columns) == sorted(names)
    for field in frame.schema.fields:
        assert TYPES[field.dataType.simpleString()] == types[field.name], field.name
    spark_order = [frame.columns.index(c) for c in sorted(names)]
    duck_order = [names.index(c) for c in sorted(names)]
    assert comparable(got, spark_order) == comparable(expected, duck_order)
    if name in ANCHOR_ROWS:
        assert len(got) == ANCHOR_ROWS[name]


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.count() == 145
    assert "quadrant" in frame.columns
