"""Every star query gives rows, and the rows of its SQL."""

import glob
import math
import os

import duckdb
import pytest

import lexloom.plans.contract_queries  # noqa: F401  (registers further queries)
import lexloom.plans.integrity_queries  # noqa: F401  (registers further queries)
import lexloom.plans.lookup_queries  # noqa: F401  (registers further queries)
import lexloom.plans.more_queries  # noqa: F401  (registers further queries)
import lexloom.plans.package_queries  # noqa: F401  (registers further queries)
import lexloom.plans.record_queries  # noqa: F401  (registers further queries)
import lexloom.plans.rule_queries  # noqa: F401  (registers further queries)
import lexloom.plans.run_queries  # noqa: F401  (registers further queries)
from lexloom.plans.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the generated tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "\0"
    if isinstance(v, bool):
        return str(v)
    try:
        return repr(round(float(v), 6) + 0.0)
    except (TypeError, ValueError):
        return str(v)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, db, name):
    got = QUERIES[name](spark, SF)
    want = db.sql(ORACLE_SQL[name])
    names = sorted(got.columns)
    assert names == sorted(want.columns)
    left = sorted(tuple(plain(r[c]) for c in names) for r in got.collect())
    at = [want.columns.index(c) for c in names]
    right = sorted(tuple(plain(r[i]) for i in at) for r in want.fetchall())
    assert left and left == right
