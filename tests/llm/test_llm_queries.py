"""Every query of the subpackage runs on the smallest tables; those with SQL give the same rows."""

import glob
import os

import duckdb
import pytest

pytest.importorskip("threadmill.llm")

from threadmill.llm import queries as llm  # noqa: E402

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")
COLUMNS = {
    "p1_found": ["src", "rec_id", "kind", "nth"], "p2_found": ["conv_id", "turn_no", "message_id", "role"], "p3_found": ["src", "row_id", "pair_no", "defect"],
    "p4_found": ["src", "rec_id", "category"], "p5_found": ["keep_id", "row_id"], "p8_ids": ["doc_id", "ids"], "p10_found": ["doc_id", "issue", "lang"],
}


@pytest.mark.parametrize("name", sorted(llm.queries()))
def test_runs(spark, name):
    got = llm.queries()[name](spark, FOLDER)
    assert got.columns == COLUMNS.get(name, got.columns)
    assert len(set(got.columns)) == len(got.columns)
    got.collect()


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_same_rows(spark, name):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    cur = con.execute(llm.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(map(str, cur.fetchall())) == sorted(str(tuple(r)) for r in llm.queries()[name](spark, FOLDER).select(*names).collect())
