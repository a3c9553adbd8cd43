"""Every registered query against its SQL answer; queries without one must give rows."""

import compare
import pytest

import __spark_entry__ as entry_points

FOLDER = "/root/testdata/sf0.01"
QUERIES, ANSWERS = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return compare.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ANSWERS))
def test_same_rows_as_sql(spark, con, name):
    assert compare.differences(QUERIES[name](spark, FOLDER), con, ANSWERS[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ANSWERS)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).limit(1).count() == 1


def test_answers_belong_to_queries():
    assert set(ANSWERS) <= set(QUERIES)


def test_entry(spark):
    assert entry_points.entry(spark).count() == 84
