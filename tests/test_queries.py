"""Every registered query against its SQL on the smallest tables."""

import pytest
from check_oracle import connect, rows_of

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, db, name):
    df = QUERIES[name](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = db.execute(ORACLES[name])
    assert got == rows_of([d[0] for d in cursor.description], cursor.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["id", "title", "body", "mime_type", "metadata", "updated_at", "readers"]


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
