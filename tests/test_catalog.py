"""Every catalog query against its SQL twin (DuckDB) on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from tessera.plans import catalog
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
def _norm(v):
    if v is None:
        return "null"
    if isinstance(v, float):
        return repr(round(v, 9))
    return repr(v)


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return con


def test_every_query_has_a_twin():
    assert set(catalog.QUERIES) == set(catalog.oracle())
    assert set(E.oracle_sql()) <= set(E.queries())


def _compare(spark, con, sf, name):
    df = E.queries()[name](spark, sf)
    got = [tuple(r) for r in df.collect()]
    res = con.sql(E.oracle_sql()[name])
    cols, exp = res.columns, res.fetchall()
    assert sorted(cols) == sorted(df.columns)
    assert len(got) == len(exp)
    assert _rows(df.columns, got) == _rows(cols, exp)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_sql(spark, duck, name):
    _compare(spark, duck, SF_SMALL, name)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["cluster", "n", "X", "Y", "Day"]
    rows = df.collect()
    assert len(rows) == 32 and all(0 < r.Day <= 7 for r in rows)
