"""Every query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tidemill import catalog
from tests.conftest import TESTDATA
from tests.oracle import compare, connect

pytestmark = pytest.mark.skipif(
    not os.path.isdir(f"{TESTDATA}/sf0.001"), reason="the driver's tables are not here"
)

# Eighteen fits; tests/test_als.py fits a small grid instead.
SLOW = {"als_grid"}


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_every_query_has_sql():
    assert set(catalog.oracle_sql()) == set(catalog.queries())
    assert set(catalog.queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - SLOW))
def test_query_equals_sql(spark, con, small, name):
    assert compare(entry.queries()[name](spark, small), con, entry.oracle_sql()[name]) is None


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["user_id", "item_id", "pref", "rank"]
    assert result.count() > 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, small):
    run = entry.queries()
    found = plan(run["filter_gt_and_eq"](spark, small))
    assert "GreaterThan(c_acctbal,180.0)" in found
    assert "EqualTo(c_mktsegment,MACHINERY)" in found
    assert "c_name" not in found
    assert plan(run["join_point_stats"](spark, small)).count("custkey,10)") == 2


@pytest.mark.parametrize("name", ["parse_csv_prefs", "parse_min_fields", "json_sum_by_key", "dim_movies"])
def test_parsing_stays_in_the_jvm(spark, small, name):
    assert "Python" not in plan(entry.queries()[name](spark, small))
