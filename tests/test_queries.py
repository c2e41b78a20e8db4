"""Every query with an SQL counterpart gives the same rows on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from threadmill.plans import queries as core

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def plain(v):
    return None if v is None or isinstance(v, float) and math.isnan(v) else str(round(v, 9)) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(core.oracle_sql()))
def test_same_rows(spark, duck, name):
    got = core.queries()[name](spark, FOLDER)
    cur = duck.execute(core.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(got.columns) == sorted(names)
    want = sorted(tuple(map(str, map(plain, r))) for r in cur.fetchall())
    assert sorted(tuple(map(str, map(plain, r))) for r in got.select(*[f"`{n}`" for n in names]).collect()) == want


@pytest.mark.parametrize("name", sorted(set(core.queries()) - set(core.oracle_sql())))
def test_runs(spark, name):
    core.queries()[name](spark, FOLDER).limit(3).collect()
