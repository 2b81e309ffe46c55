"""Each registered query of the core against its SQL, at the smallest scale."""

import os

import duckdb
import pytest

from quillgraph.plans import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rounded(v):
    return round(v, 5) if isinstance(v, float) else v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_matches_sql(spark, con, name):
    df = registry.QUERIES[name](spark, SF)
    cursor = con.execute(registry.SQL[name])
    columns = sorted(c[0] for c in cursor.description)
    assert sorted(df.columns) == columns
    at = [next(i for i, d in enumerate(cursor.description) if d[0] == c) for c in columns]
    expected = sorted(repr([rounded(r[i]) for i in at]) for r in cursor.fetchall())
    assert sorted(repr([rounded(r[c]) for c in columns]) for r in df.collect()) == expected


@pytest.mark.parametrize("name", ["communities"])
def test_deterministic(spark, name):
    once, again = (sorted(map(repr, registry.QUERIES[name](spark, SF).collect())) for _ in range(2))
    assert once == again and once
