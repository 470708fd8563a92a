"""The text queries that have SQL give the rows of the SQL, over the whole small tables."""

import glob
import os
from collections import Counter

import duckdb
import pytest

from folioforge.llm import queries

BASE = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(BASE), reason="no test data")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_rows(spark, name):
    c = duckdb.connect()
    for p in glob.glob(f"{BASE}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    df = queries.QUERIES[name](spark, BASE)
    result = c.execute(queries.SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert Counter(tuple(r[n] for n in names) for r in df.collect()) == Counter(result.fetchall())
