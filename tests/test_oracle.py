"""Every registered query against its SQL, on the plain path and on the path for hot groups."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from conftest import SMALL
from oracle import compare, connect
from tidewell import workload

NAMES = sorted(workload.load())
# Queries whose plan depends on the per-task row limit.
ORDERED = [
    "box_by_month", "box_outliers", "rank_by_median", "category_codes", "describe_lineitem", "catalog_nested",
    "progress_milestones", "shuffle_docs", "char_vocab", "minibatch_assign", "row_index", "batch_mean_accuracy",
    "cross_entropy", "token_length_profile", "causal_attention", "full_attention", "causal_conv", "strided_conv",
    "temporal_block", "sequence_windows", "json_array_scan",
]


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    assert compare(spark, con, queries()[name], oracle_sql().get(name), SMALL) is None


@pytest.mark.parametrize("name", ORDERED)
def test_query_with_hot_groups(spark, con, small_tasks, name):
    assert compare(spark, con, queries()[name], oracle_sql()[name], SMALL) is None


def test_entry(spark):
    df = entry(spark)
    assert df.count() == 12
    assert df.columns[0] == "month"
