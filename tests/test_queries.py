"""Every registered query against its SQL, at the smallest scale."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from larkspur.plans.registry import QUERIES  # noqa: E402
from tools.check_oracle import compare, connect  # noqa: E402

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    good, note = compare(spark, con, FOLDER, name)
    assert good, note


def test_rows_only_queries_are_few_and_known():
    assert not set(entry.oracle_sql()) - set(entry.queries())
    unchecked = set(QUERIES) - set(entry.oracle_sql())
    assert all(QUERIES[name].__module__ == "larkspur.plans.modelling" for name in unchecked)


def test_out_of_fold_query_scores_every_training_row_once(spark):
    found = entry.queries()["out_of_fold_scores"](spark, FOLDER)
    assert found.count() == found.select("row_id").distinct().count()


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
