"""Registered corpus queries: results against their SQL, the pipeline against its stages, and the plans."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from compare import connect, differ
from gridspark.llm import text_dups
from gridspark.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


def test_all_operators_and_the_pipeline():
    numbers = sorted(int(m[1]) for n in QUERIES if (m := re.match(r"op(\d+)_", n)))
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    got = df.toPandas()
    assert len(got)
    if name in SQL:
        assert differ(got, connect(FOLDER).execute(SQL[name]).df()) is None


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, FOLDER)
        out.write.parquet(f"{tmp_path}/{k}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{k}")
        if name != "packing":
            assert docs.columns == columns
        if name == "mixing":
            assert {r.doc_id for r in docs.collect()} <= {r.doc_id for r in before.collect()}
        elif name == "near-duplicates":
            kept = {r.doc_id for r in text_dups.text_classes(before).collect() if r.kept}
            assert sorted(r.doc_id for r in docs.collect()) == sorted(kept)
        elif name != "packing":
            assert before.exceptAll(docs).count() == before.count() - docs.count() > 0
    total = sum(len((r.text or "").encode().split()) for r in before.collect())
    assert sum(r.n_tokens for r in docs.collect()) == total


def test_stages_without_rows(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).count() == 0


def test_stages_beside_columns_named_like_helpers(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for k, name in enumerate(("__own", "__id", "__mark", "__source", "__positions", "__rows", "__position", "mark", "class_id", "kept")):
        docs = docs.withColumn(name, F.lit(k))
    for stage in (corpus_pipeline.drop_copies, corpus_pipeline.mix_sources):
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns and out.select("__own", "__position", "kept").distinct().collect() == [(0, 6, 9)]
        assert out.count() > 0
