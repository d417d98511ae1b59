"""Every query and stage on the odd and on empty tables."""

import duckdb
import pytest

import corpus_pipeline
from cohortflow.llm.queries import ORACLE, QUERIES
from tests import oracle

TABLES = "documents labels benchmark pages conversations embeddings".split()


def connect(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet/*.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty(spark, empty_dir, name):
    assert QUERIES[name](spark, empty_dir).collect() == []


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_odd_same_as_sql(spark, odd_dir, name):
    assert oracle.compare(QUERIES[name](spark, odd_dir), connect(odd_dir), ORACLE[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_odd(spark, odd_dir, name):
    rows = QUERIES[name](spark, odd_dir).collect()
    if "doc_id" in rows[0].__fields__ and name != "op6_decontamination":
        ids = sorted((r[0] is not None, r[0]) for r in spark.read.parquet(f"{odd_dir}/documents.parquet").select("doc_id").collect())
        assert sorted((r["doc_id"] is not None, r["doc_id"]) for r in rows) == ids


def test_pipeline_empty(spark, empty_dir):
    assert corpus_pipeline.run(spark, empty_dir).collect() == []


def test_pipeline_odd(spark, odd_dir):
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, odd_dir)
        assert out.columns == docs.columns, name
        assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name
        docs = out
    kept = corpus_pipeline.run(spark, odd_dir).collect()
    assert sum(r["doc_id"] == 4 for r in kept) <= 1
    assert all(r["round_trip"] for r in kept)
