"""Every registered query: equal to its SQL, or a non-failing result where SQL cannot express it."""

import pytest
from compare import connect, difference

import __spark_entry__ as registry

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLE = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    with connect(SF_DIR) as connection:
        yield connection


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, db, name):
    assert difference(QUERIES[name](spark, SF_DIR), db, ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, name):
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()


def test_every_sql_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert registry.entry(spark).count() > 0
