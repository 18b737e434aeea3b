"""Every catalogue query against its DuckDB SQL on the sf0.01 tables."""

import os

import pytest

import __spark_entry__ as E
from marketflow.plans.catalog import QUERIES
from marketflow.plans.oracle import ORACLE_SQL
from tools.oracle_check import _rows, duck

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(ORACLE_SQL) == set(QUERIES)
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_DIR)
    cols = sorted(df.columns)
    sql = E.oracle_sql()[name]
    ocols = sorted(con.sql(sql).columns)
    assert cols == ocols
    got = _rows(df.select(*cols).collect())
    exp = _rows(con.sql(f"SELECT {', '.join(ocols)} FROM ({sql})").fetchall())
    assert len(got) == len(exp)
    assert got == exp


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert len(df.columns) == 19
    expected = duck(E.SMOKE_DIR).sql(ORACLE_SQL["enrich_batch"])
    assert sorted(df.columns) == sorted(expected.columns)
    assert df.count() == len(expected.fetchall()) > 0
