"""Every registered query against its SQL."""

import os

import pytest

import __spark_entry__ as entries
import oracle
from conftest import plan_of

# on the smallest tables nothing may be left of these
MAY_BE_EMPTY: set[str] = set()
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def con():
    return oracle.database(SF_DIR)


def test_every_query_has_sql():
    assert set(entries.QUERIES) == set(entries.ORACLES)
    assert set(entries.queries()) >= set(entries.QUERIES)


@pytest.mark.parametrize("name", sorted(entries.QUERIES))
def test_query_equals_sql(spark, con, name):
    df = entries.QUERIES[name](spark, SF_DIR)
    plan = plan_of(df)
    for node in ("CartesianProduct", "NestedLoopJoin", "Python", "MapInPandas", "ArrowEval"):
        assert node not in plan
    found = oracle.differences(df, con, entries.ORACLES[name])
    assert not [d for d in found if d != "no rows" or name not in MAY_BE_EMPTY]


def test_entry_has_rows_and_the_published_columns(spark):
    df = entries.entry(spark)
    assert df.columns[:3] == ["rpt_dt", "sales_thru_dt", "sales_mth_cat_nbr"]
    assert df.count() > 0
