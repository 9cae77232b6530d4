"""Every registered query against its DuckDB oracle on sf0.001 (row count, columns, values)."""

import decimal

import duckdb
import pytest

from tests.conftest import SF_SMALL
from workpulse.plans import queries as Q

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(r):
    return tuple((x is None, str(x)) for x in r)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _entry():
    import __spark_entry__ as E
    return E


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    E = _entry()
    df = E.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=_key)
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    exp = sorted((tuple(_norm(r[i]) for i in idx) for r in cur.fetchall()), key=_key)
    assert len(got) == len(exp)
    assert got == exp


def test_entry_smoke(spark):
    df = _entry().entry(spark)
    assert len(df.columns) == 40 and df.count() > 0
