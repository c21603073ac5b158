"""Every query that SQL can express gives the rows that SQL gives."""

import duckdb
import pytest

from veilsift import queries

D = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{D}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equals_sql(spark, duck, name):
    got = queries.queries()[name](spark, D)
    cur = duck.execute(queries.oracle_sql()[name])
    names = [x[0] for x in cur.description]
    assert sorted(names) == sorted(got.columns)
    order = sorted(names)
    want = sorted(repr(tuple(r[names.index(c)] for c in order)) for r in cur.fetchall())
    assert sorted(repr(tuple(r[c] for c in order)) for r in got.collect()) == want


def test_all_registered():
    assert set(queries.oracle_sql()) <= set(queries.queries())
