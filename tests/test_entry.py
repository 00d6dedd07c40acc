"""The driver contract, and every registered query against its DuckDB oracle on sf0.001."""

import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from meterline.plans import registry  # noqa: E402
from check_oracle import TABLES, digest  # noqa: E402

NAMES = sorted(registry.queries())  # the library's own; others have tests of their own


def test_entry_runs_flagship(spark):
    df = E.entry(spark)
    assert df.columns == ["ts", "account", "billingYear", "billingMonth", "quota", "total", "message"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql()) & set(E.queries())


@pytest.fixture(scope="module")
def duck(sf001):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf001}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, sf001, name):
    df = E.queries()[name](spark, sf001)
    rows = df.collect()
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)
