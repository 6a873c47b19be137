"""Plan lint: the physical plans of the registered queries keep the
properties the design relies on at scale."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry

QUERIES = entry.queries()
# Queries that write or copy data while they are built are linted through
# their read-back plans like every other query.
NAMES = sorted(QUERIES)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_pairwise_joins_or_python(spark, sf_small, name):
    plan = _plan(QUERIES[name](spark, sf_small))
    # the training-data operators whose dealt method names Python inside tasks may run it there
    python = () if re.match(r"op\d+_|pipeline", name) else (
        "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", *python):
        assert bad not in plan, f"{name}: {bad}"


@pytest.mark.parametrize("name", ["latest_per_key", "first_per_key", "distinct_on_pg_nulls", "unify_latest",
                                  "priority_attribution", "banned_users"])
def test_top_one_per_key_is_reduced_before_the_shuffle(spark, sf_small, name):
    plan = _plan(QUERIES[name](spark, sf_small))
    assert "WindowGroupLimit" in plan, name


def test_filters_and_projection_reach_the_scan(spark, sf_small):
    plan = _plan(QUERIES["filter_predicates"](spark, sf_small))
    assert "PushedFilters: [IsNotNull(o_orderpriority)" in plan or "In(o_orderstatus" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double,o_orderpriority:string>" in plan
    plan = _plan(QUERIES["lookback_agg"](spark, sf_small))
    assert "EqualTo(event_type,purchase)" in plan and "EqualTo(event_type,error)" in plan


def test_range_join_is_an_equi_join_on_key_and_bucket(spark, sf_small):
    df = QUERIES["before_anchor"](spark, sf_small)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "__tm_bucket" in plan
    physical = _plan(df)
    assert "HashJoin" in physical or "SortMergeJoin" in physical
