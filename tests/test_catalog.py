"""Every registered query against its SQL on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import entry  # noqa: E402

from taxaloom.catalog import QUERIES, SQL  # noqa: E402
from tools.compare import compare, connect  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not there")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    ok, _, note = compare(spark, con, SF_DIR, QUERIES[name], SQL.get(name))
    assert ok, note


def test_entry(spark):
    assert entry(spark).count() > 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_inputs_are_not_read_again_to_look_for_hot_keys(spark):
    assert plan_of(QUERIES["new_name_status"](spark, SF_DIR)).count("documents.parquet") == 1
    # rows are written once before they are counted
    assert "documents.parquet" not in plan_of(QUERIES["alias_status"](spark, SF_DIR))


def test_rules_on_rows_share_a_scan(spark):
    assert plan_of(QUERIES["quality_report"](spark, SF_DIR)).count("lineitem.parquet") <= 4
