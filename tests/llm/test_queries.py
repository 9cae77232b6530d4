"""The registered queries: against DuckDB, on empty tables, and with null, empty, very long, tied and repeated rows."""

import duckdb
import pytest

import corpus_pipeline
from workpulse.llm.queries import ORACLE_SQL, QUERIES

from tests.llm.conftest import edge_documents

SF = "/root/testdata/sf0.001"
ALL = {**QUERIES, "pipeline": corpus_pipeline.run}


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[name](spark, SF)
    cols = sorted(got.columns)
    rows = sorted(tuple(r[c] for c in cols) for r in got.collect())
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({ORACLE_SQL[name]})").fetchall()
    assert rows == sorted(want) and rows


@pytest.mark.parametrize("name", sorted(ALL))
def test_empty_tables(spark, empty_dir, name):
    assert ALL[name](spark, empty_dir).collect() == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op11_hard_negatives", "op12_phrases"}))  # these have no row for each document
def test_odd_rows(spark, edge_dir, name):
    """A row out for each row in, whatever it holds; equal rows get equal results."""
    rows = QUERIES[name](spark, edge_dir).collect()
    docs = edge_documents()
    key = lambda x: (x is None, x or 0)
    assert sorted((r["doc_id"] for r in rows), key=key) == sorted((d[0] for d in docs), key=key)
    twins = [tuple(v for k, v in r.asDict().items() if k != "slot") for r in rows if r["doc_id"] == 6]
    assert len(twins) == 2 and twins[0] == twins[1]
