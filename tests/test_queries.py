"""Every query of this package against its SQL in another engine, on the smallest driver tables."""

import os

import pytest

from snapweave.plans import queries as q

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def by_name(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(repr(tuple(r[i] for i in order)) for r in rows)


@pytest.mark.parametrize("name", sorted(q.QUERIES))
def test_query(spark, duck, name):
    df = q.QUERIES[name](spark, SF)
    got = by_name(map(tuple, df.collect()), df.columns)
    if name in q.ORACLE_SQL:
        cursor = duck.execute(q.ORACLE_SQL[name])
        columns = [d[0] for d in cursor.description]
        assert got == by_name(cursor.fetchall(), columns)


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and set(q.QUERIES) <= set(e.queries())
    assert e.entry(spark).columns == ["day", "label", "n_rows", "n_subjects"]
