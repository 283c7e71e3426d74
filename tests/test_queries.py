"""Registered queries against their SQL on the smallest tables."""

import os

import duckdb
import pytest

from fleetlens import plans

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data here")


def plain(v):
    if isinstance(v, float):
        return float(f"{v:.9g}")
    return v.isoformat() if hasattr(v, "isoformat") else v


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DATA}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(plans.ORACLES))
def test_query(spark, oracle, name):
    df = plans.QUERIES[name](spark, DATA)
    names = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr)
    cursor = oracle.execute(plans.ORACLES[name])
    at = [d[0] for d in cursor.description]
    assert sorted(at) == names
    want = sorted((tuple(plain(r[at.index(c)]) for c in names) for r in cursor.fetchall()), key=repr)
    assert got == want
