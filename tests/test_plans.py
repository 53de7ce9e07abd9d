"""Shape of the physical plans that matter at scale."""

from __future__ import annotations

import re

import pytest

from contract.queries import QUERIES
from contract import fixtures as fx
from netledger.operators.dedup import latest
from netledger.operators.joins import JoinPolicy
from netledger.plans.settlement import INCRE, NORMAL, settle, summary

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def flow_chain(plan):
    """The part of the plan that carries the flow: build sides are left out."""
    keep, skip = [], None
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if skip is not None and depth > skip:
            continue
        skip = None
        if "BroadcastExchange" in line or "Subquery" in line:
            skip = depth
            continue
        keep.append(line)
    return "\n".join(keep)


@pytest.mark.parametrize("job", [NORMAL, INCRE], ids=["normal", "incre"])
def test_flow_is_exchanged_twice(spark, job):
    flow = fx.normal_flow(spark, FOLDER) if job is NORMAL else fx.incre_flow(spark, FOLDER)
    chain = flow_chain(plan_of(summary(settle(flow, fx.dimensions(spark, FOLDER), job))))
    assert len(re.findall(r"(?<!Broadcast)Exchange hashpartitioning", chain)) == 2
    # The INCRE totals do not use the groups, so that join is left out of the plan.
    assert chain.count("BroadcastHashJoin") == (5 if job is NORMAL else 4)
    assert "Python" not in chain and "NestedLoop" not in chain and "Cartesian" not in chain


def test_divided_flow_is_exchanged_once_per_key(spark):
    """Codes, merchant (groups and fees together), terminal and store, deduplication, totals."""
    flow, dims = fx.normal_flow(spark, FOLDER), fx.dimensions(spark, FOLDER)
    plan = plan_of(summary(settle(flow, dims, NORMAL, JoinPolicy(broadcast_bytes=0, rows_per_part=500))))
    assert plan.count("SortMergeJoin") == 5
    on_merchant = [line for line in plan.splitlines() if "Exchange hashpartitioning(_merchant" in line]
    assert len(on_merchant) == 3  # the flow once, each of the two sides once


def test_duplicates_are_cut_before_the_exchange(spark):
    """Those of heavy keys; here all keys count as heavy."""
    plan = plan_of(latest(fx.normal_flow(spark, FOLDER), ["id"], heap_rows=0))
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")


def test_totals_are_summed_before_the_exchange(spark):
    plan = plan_of(QUERIES["normal_settlement"](spark, FOLDER))
    assert "partial_sum" in plan


def test_scan_reads_only_used_columns(spark):
    plan = plan_of(QUERIES["normal_filter"](spark, FOLDER))
    schema = re.search(r"ReadSchema: struct<(\S*)", plan).group(1)
    assert "l_suppkey" not in schema and "l_tax" not in schema


def test_point_read_is_pushed_down(spark):
    plan = plan_of(QUERIES["point_read"](spark, FOLDER))
    assert "EqualTo(c_custkey,7)" in plan


@pytest.mark.parametrize("name", ["like_lookup", "exists_lookup", "key_delete", "first_match_lookup"])
def test_no_nested_loops(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
