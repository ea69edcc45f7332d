"""Every query with SQL text must give the same rows in Spark and DuckDB."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_oracle import duck, rows_of  # noqa: E402
from conftest import SF_SMALL  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from tastemap.plans import queries as Q  # noqa: E402

ORACLE = Q.ORACLE


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(Q.QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_duckdb(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = df.columns
    got = rows_of(cols, [tuple(r) for r in df.collect()])
    res = con.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    want = rows_of(dcols, res.fetchall())
    assert sorted(cols) == sorted(dcols)
    assert len(got) == len(want)
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["user_id", "item_id", "votes", "rank"]
