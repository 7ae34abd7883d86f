"""Every registered query against its SQL, and the plans of the core ones."""

import os

import pytest

import __spark_entry__ as entry
from tallyguard.plans import catalog

from .oracle import connect, differences

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    pytest.importorskip("duckdb")
    return connect(SF)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, con, name):
    assert differences(con, entry.queries()[name](spark, SF), entry.oracle_sql()[name]) == []


def test_entry(spark):
    assert entry.entry(spark).count() == 1
    assert set(catalog.ORACLES) == set(catalog.QUERIES) <= set(entry.queries())


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scoring_does_not_shuffle_rows(spark):
    text = plan(entry.queries()["score_broadcast_join"](spark, SF))
    scored = plan(entry.queries()["confidence"](spark, SF))
    assert "BroadcastNestedLoopJoin" in text and "SortMergeJoin" not in text
    assert "hashpartitioning" not in scored and "Python" not in scored


def test_fit_pushes_the_normal_filter_to_the_scan(spark):
    text = plan(entry.queries()["fit_baseline"](spark, SF))
    assert "EqualTo(event_type,view)" in text
    assert "ReadSchema: struct<ts" in text or "event_id" not in text.split("ReadSchema")[1]


def test_test_rows_are_removed_by_a_broadcast_hash_join(spark):
    text = plan(entry.queries()["train_minus_test"](spark, SF))
    assert "BroadcastHashJoin" in text and "LeftAnti" in text and "SortMergeJoin" not in text
