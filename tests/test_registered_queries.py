"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from relsync.plans.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data absent")


def _norm(v):
    if v is None:
        return "null"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return str(v)


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "o_legacy_code" in df.columns and "o_orderyear" in df.columns


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [c[0] for c in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert _bag(df.columns, [tuple(r) for r in df.collect()]) == _bag(dcols, drows)
