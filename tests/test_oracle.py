"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return c


def norm(v):
    return f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - {n for n in entry.oracle_sql() if n.startswith("op")}))
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    cols = sorted(df.columns)
    got = sorted(tuple(norm(r[c]) for c in cols) for r in df.collect())
    cur = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = sorted(tuple(norm(r[names.index(c)]) for c in cols) for r in cur.fetchall())
    assert got == want


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
