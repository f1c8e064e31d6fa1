"""Plan properties the design relies on: pruning to the scan, no row-at-a-time Python, no cross joins."""
import re

import pytest

from capsight.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    df = QUERIES[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


def read_schemas(p):
    return sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", p)))


def test_projection_reaches_the_scan(spark):
    assert read_schemas(plan(spark, "c1_infer_mime")) == ["struct<doc_id:bigint>"]
    assert read_schemas(plan(spark, "h1_recent_media")) == ["struct<conv_id:bigint,turn:bigint,text:string>"]


@pytest.mark.parametrize("name", ["e3_analyze", "g1_compare_groups", "h2_recent_media_by_turn",
                                  "h4_conversation_context", "i2_analyze_incremental", "k1_kind_report"])
def test_no_cross_join_or_row_python(spark, name):
    p = plan(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in p, (name, bad)
