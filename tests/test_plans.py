"""Plans keep their shape when nothing is small enough to broadcast."""

import pytest

from linkwell.operators import blocking
from linkwell.plans import registry
from conftest import SMALL

QUERIES = [
    "block_exact_name", "block_token", "block_index", "block_capped", "token_cap", "candidate_coverage", "blocking_recall",
    "pair_labels", "pair_features", "group_split", "select_threshold", "match_lists",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", QUERIES)
def test_no_products_and_no_row_by_row_python(spark, no_broadcast, name):
    text = plan(registry.QUERIES[name](spark, SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in text


def test_join_without_hot_keys_is_plain(random_sides, no_broadcast):
    """One shuffle per side and no trace of the grid."""
    text = plan(blocking.block_exact_name(*random_sides))
    assert text.count("Exchange hashpartitioning") == 2 and text.count("SortMergeJoin") == 1


def test_postings_are_cut_before_their_shuffle(spark, random_sides, no_broadcast):
    text = plan(blocking.token_cap(*random_sides))
    assert text.count("WindowGroupLimit") == 2


def test_filters_and_columns_reach_the_scan(spark):
    text = registry.QUERIES["block_exact_name"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in text and "business_name" not in text and "address_norm" not in text
