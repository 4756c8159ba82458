"""Bucketed catalog tables: same results, and the claims side of member joins is not shuffled."""

from __future__ import annotations

import tempfile

from conftest import rows

from claimscope.params import DEFAULT_WINDOW as W
from claimscope.plans import quality, summary
from claimscope.sources.layout import load_catalog_tables, save_bucketed


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_tables_give_same_results_without_claim_shuffle(spark, study):
    location = tempfile.mkdtemp(prefix="claimscope-layout-")
    save_bucketed(study, "claimscope_layout_test", location, buckets=4)
    t = load_catalog_tables(spark, "claimscope_layout_test")
    assert rows(summary.master_summary(t, W)) == rows(summary.master_summary(study, W))
    assert rows(quality.missing_eligibility(t)) == rows(quality.missing_eligibility(study))

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(quality.missing_eligibility(t))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # claims and spans collapse per member where the buckets lie; only the collapsed lines may move
    before = plan[: plan.index("FileScan")]
    assert "keys=[member_id" in before and plan.count("Exchange") <= 1
    assert "Exchange hashpartitioning(member_id" not in plan  # both sides bucketed by member_id
