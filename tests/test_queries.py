"""Every registered query against its SQL, on the whole tables of the smallest scale."""

import pytest
from comparison import compare, sql_engine

from cropweave.workload import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return sql_engine(FOLDER)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    ok, note = compare(spark, con, name, FOLDER)
    assert ok, note


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns[0] == "csc_raw_id"
    assert set(entry.oracle_sql()) <= set(entry.queries())
