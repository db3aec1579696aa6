"""Registered queries of the subpackage against their SQL, and the pipeline."""

import duckdb
import pytest

import __spark_entry__ as entry_point
import corpus_pipeline
from shelfproof.llm import oracles, queries
from shelfproof.llm.graph import staged

SMALL = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = set(entry_point.queries())
    assert set(queries.QUERIES) <= names and "pipeline" in names
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 1 + len(queries.QUERIES)))
    assert set(oracles.ORACLES) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", list(oracles.ORACLES))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    df = queries.QUERIES[name](spark, SMALL)
    result = con.execute(oracles.ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    want = sorted(repr([row[columns.index(c)] for c in df.columns]) for row in result.fetchall())
    assert sorted(repr(list(r)) for r in df.collect()) == want


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = staged(stage(spark, docs, SMALL))
        assert out.columns == docs.columns, name
        docs = out
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] >= counts[3] > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert last.count() == counts[-1]
    assert len(corpus_pipeline.STAGES) == 5
