"""Registered corpus queries: SQL counterparts and the pipeline."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_module
import corpus_pipeline
from chatloom.llm import oracles, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_all_are_registered():
    named = entry_module.queries()
    assert {n.split("_")[0] for n in queries.queries()} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.queries()) | {"pipeline"} <= set(named)
    assert set(oracles.oracle_sql()) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_equals_duckdb(spark, duck, name):
    ours = queries.queries()[name](spark, SF_DIR).toArrow()
    theirs = duck.sql(oracles.oracle_sql()[name]).to_arrow_table()
    columns = sorted(theirs.column_names)
    assert sorted(ours.column_names) == columns
    ours, theirs = ours.select(columns), theirs.select(columns)
    assert [str(f.type) for f in ours.schema] == [str(f.type) for f in theirs.schema]
    duck.register("ours", ours)
    duck.register("theirs", theirs)
    for one, other in (("ours", "theirs"), ("theirs", "ours")):
        assert not duck.sql(f"SELECT * FROM {one} EXCEPT ALL SELECT * FROM {other}").fetchall()


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    counts = [docs.count()]
    for place, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_DIR)
        if place < len(corpus_pipeline.STAGES) - 1:
            assert out.schema.names == docs.schema.names
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        counts.append(docs.select("doc_id").distinct().count())
    assert counts[0] > counts[1] > counts[2] >= counts[3] == counts[4] > 0
    run = corpus_pipeline.run(spark, SF_DIR)
    assert run.select("doc_id").distinct().count() == counts[4]
