"""Every query that has SQL gives the rows of the SQL, over the whole small tables."""

import datetime
import glob
import math
import os
from collections import Counter

import duckdb
import pytest

from folioforge.plans import registry

BASE = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(BASE), reason="no test data")


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(map(norm, v))
    return v


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for p in glob.glob(f"{BASE}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_same_rows(spark, duck, name):
    df = registry.QUERIES[name](spark, BASE)
    columns = sorted(df.columns)
    got = Counter(tuple(norm(r[c]) for c in columns) for r in df.collect())
    result = duck.execute(registry.SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == Counter(tuple(norm(r[i]) for i in at) for r in result.fetchall())


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_runs(spark, name):
    assert registry.QUERIES[name](spark, BASE).columns
    registry.QUERIES[name](spark, BASE).write.format("noop").mode("overwrite").save()
