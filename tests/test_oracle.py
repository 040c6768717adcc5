"""Every registered query that has SQL against it, on the smallest data."""

import pytest

import __spark_entry__ as entry
from crosslex.plans.oracle import build
from crosslex.plans.queries import QUERIES
from tools.check import compare, duck

SF = "/root/testdata/sf0.001"
SQL = build()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert sorted(QUERIES) == sorted(SQL)


@pytest.mark.parametrize("key", sorted(SQL))
def test_query(spark, con, key):
    same, remark = compare(entry.queries()[key](spark, SF), con, SQL[key])
    assert same, remark


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["qid", "rank", "score", "pos", "lang", "id", "title"]
    assert df.count() > 0
