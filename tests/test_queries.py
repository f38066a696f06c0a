"""Queries against their SQL on the smallest tables."""

import collections
import os

import duckdb
import pytest

from marquetry.plans import core_problems, reference
from tests.conftest import SMALL

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


def canon(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(canon, v))
    if hasattr(v, "tzinfo") and v.tzinfo:
        return v.replace(tzinfo=None)
    return v


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for f in os.listdir(SMALL):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SMALL}/{f}'")
    return c


def compare(spark, duck, query, sql):
    df = query(spark, SMALL)
    columns = sorted(df.columns)
    got = collections.Counter(tuple(canon(r[c]) for c in columns) for r in df.collect())
    cursor = duck.execute(sql)
    names = [d[0] for d in cursor.description]
    want = collections.Counter(tuple(canon(r[names.index(c)]) for c in columns) for r in cursor.fetchall())
    assert sorted(names) == columns
    assert got == want


ALL = core_problems.SQL | reference.SQL


@pytest.mark.parametrize("name", sorted(ALL))
def test_query(spark, duck, name):
    compare(spark, duck, (core_problems.QUERIES | reference.QUERIES)[name], ALL[name])


@pytest.mark.parametrize("name", sorted(set(core_problems.QUERIES | reference.QUERIES) - set(ALL)))
def test_runs(spark, name):
    assert (core_problems.QUERIES | reference.QUERIES)[name](spark, SMALL).count() > 0


def test_scan_prunes_and_pushes(spark):
    plan = core_problems.p2_found(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "description" not in plan and "PushedFilters: [IsNotNull(budget" in plan
    text = reference.QUERIES["pending_films"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in text and "WindowGroupLimit" in text
