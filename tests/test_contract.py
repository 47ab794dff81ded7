"""Driver contract: entry(), queries() and the oracle SQL, checked on sf0.001
against DuckDB with exact values."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from tessera.plans import ORACLE_SQL, QUERIES
from tessera.sources.tables import TABLES


def test_entry_runs_with_stable_schema(spark, sf_small):
    df = E.entry(spark)
    assert df.columns == ["category", "word", "freq"]
    assert df.count() >= 0


def test_every_query_has_an_oracle():
    assert set(ORACLE_SQL) == set(QUERIES) and len(QUERIES) >= 42
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    return v if v is None or isinstance(v, (int, str, bool)) else str(v)


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_small, duck, name):
    df = E.queries()[name](spark, sf_small)
    cols = df.columns
    got = Counter(tuple(_norm(v) for v in r) for r in df.collect())
    cur = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(ocols)
    idx = [ocols.index(c) for c in cols]
    types = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
             "boolean": "BOOLEAN"}
    stypes = [types.get(f.dataType.simpleString(), f.dataType.simpleString().upper())
              for f in df.schema.fields]
    assert stypes == [str(cur.description[i][1]).upper() for i in idx]
    want = Counter(tuple(_norm(r[i]) for i in idx) for r in cur.fetchall())
    assert got == want
