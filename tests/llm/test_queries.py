"""Registered corpus queries against their SQL, held-out accuracy, and the pipeline's stages."""

from __future__ import annotations

import os
import re

import duckdb
import pytest

import corpus_pipeline
from conftest import MEDIUM, SMALL
from test_oracles import TYPES, comparable
from tidemark.llm.oracles import ORACLES
from tidemark.llm.queries import QUERIES
from tidemark.workspace import Workspace


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(MEDIUM):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{MEDIUM}/{file}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, duck, name):
    frame = QUERIES[name](spark, MEDIUM)
    got = [tuple(row) for row in frame.collect()]
    cursor = duck.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    expected = cursor.fetchall()
    assert sorted(frame.columns) == sorted(names)
    kinds = {c[0]: str(c[1]) for c in cursor.description}
    for field in frame.schema.fields:
        assert {**TYPES, "boolean": "BOOLEAN"}[field.dataType.simpleString()] == kinds[field.name], field.name
    order = sorted(names)
    assert comparable(got, [frame.columns.index(c) for c in order]) == comparable(
        expected, [names.index(c) for c in order])


def test_held_out_language(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op9_language"](spark, MEDIUM).join(docs, "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in rows) >= 0.97 * len(rows)


def test_clean_documents_are_kept(spark):
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet").where("quality = 1")
    rows = QUERIES["op5_perplexity"](spark, MEDIUM).join(labels, "doc_id").where("not base_failed").collect()
    assert sum(r.kept for r in rows) >= 0.99 * len(rows)


def test_toxic_documents(spark):
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet").where("toxic is not null")
    rows = QUERIES["op10_toxicity"](spark, MEDIUM).join(labels, "doc_id").collect()
    assert not [r for r in rows if r.predicted and not r.toxic]
    assert sum(r.predicted for r in rows) >= 0.6 * sum(r.toxic for r in rows)


def test_passages(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()
    items = spark.read.parquet(f"{MEDIUM}/benchmark.parquet").collect()
    normal = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    exact = {(d.doc_id, i.item_id) for d in docs for i in items if normal(i.text) in normal(d.text)}
    found = {(r.doc_id, r.item_id) for r in QUERIES["op7_decontamination"](spark, MEDIUM).collect()}
    assert exact and exact <= found and len(found) <= 1.5 * len(exact)


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    with Workspace(spark) as workspace:
        kept = docs
        for name, stage in corpus_pipeline.STAGES:
            before, kept = kept.count(), workspace.stage(stage(spark, kept, SMALL), name)
            assert sorted(kept.columns) == sorted(docs.columns)
            if name == "mixing":
                continue
            assert 0 < kept.count() <= before
            if name == "line_dedup":
                assert kept.count() == before
    assert len(corpus_pipeline.STAGES) == 5
