import os
from collections import Counter

import duckdb
import pytest

from marquetry.llm.queries import QUERIES, SQL
from tests.conftest import SMALL

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
COLUMNS = {"p1_found": ["field", "term", "mark"], "p3_found": ["film_id", "tmdb_id"], "p7_found": ["rec_id_a", "rec_id_b"], "p10_found": ["doc_id", "band"]}


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    c = duckdb.connect()
    for f in os.listdir(SMALL):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SMALL}/{f}'")
    df = QUERIES[name](spark, SMALL)
    cursor = c.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert Counter(tuple(r[n] for n in names) for r in df.collect()) == Counter(cursor.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    df = QUERIES[name](spark, SMALL)
    assert df.columns == COLUMNS.get(name, df.columns)
    rows = df.collect()
    assert rows and len(rows) == len(set(rows))
