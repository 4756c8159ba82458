"""Plan shape: what the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest

from claimscope.plans import registry

JOBS = sorted(registry.JOBS)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", JOBS)
def test_plan_hygiene(spark, smoke_tables, key):
    plan = _plan(registry.JOBS[key](spark, smoke_tables))
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in plan, f"{key} runs Python: {node}"
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan, f"{key} has a cross product: {node}"


def test_window_filters_reach_the_scan(spark, smoke_tables):
    from claimscope.plans import cohort, utilization
    from claimscope.sources.testdata import WINDOW

    for df in (cohort.rx_cohort_detail(smoke_tables, WINDOW), utilization.member_utilization(smoke_tables, WINDOW)):
        plan = _plan(df)
        assert "PushedFilters: [IsNotNull(" in plan and "GreaterThanOrEqual" in plan


def test_flagged_dimensions_are_broadcast(spark, smoke_tables):
    from claimscope.plans import adherence
    from claimscope.sources.testdata import WINDOW

    plan = _plan(adherence.clip_fills(smoke_tables, WINDOW))
    assert "BroadcastHashJoin" in plan


def test_member_filters_stay_above_aggregates(spark, smoke_tables):
    """The condition filter must not be pushed under the per-member aggregate as a semi-join."""
    from claimscope.plans import utilization
    from claimscope.sources.testdata import WINDOW

    plan = _plan(utilization.utilization_summary(smoke_tables, WINDOW))
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert not [j for j in joins if "LeftSemi" in j and "member_id" in j]
    assert "partial_sum(paid_amt" in plan


def test_cost_rank_sorts_only_distinct_values(spark, smoke_tables):
    from claimscope.plans import risk
    from claimscope.sources.testdata import WINDOW

    plan = _plan(risk.cost_buckets(smoke_tables, WINDOW, population="all"))
    # ties collapse first, ranges of the totals are ranked inside their parent range ...
    assert "HashAggregate(keys=[total_paid_amt" in plan and "hashpartitioning(_v1" in plan
    # ... and what meets in one task is counts of the few top ranges, or one total, never members
    below = [plan[m.end() : m.end() + 900] for m in re.finditer("Exchange SinglePartition", plan)]
    assert below and all("member_id" not in b.split("Exchange hashpartitioning")[0] for b in below)
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_window_is_first_in_the_diagnosis_chain(spark, smoke_tables):
    """The date filter reaches the header scan of every windowed diagnosis job; no any-date table is written."""
    from claimscope.plans import cohort, summary
    from claimscope.sources.testdata import WINDOW

    for df in (cohort.dx_cohort_detail(smoke_tables, WINDOW), cohort.window_first_event(smoke_tables, WINDOW), cohort.combined_cohort(smoke_tables, WINDOW), summary.master_summary(smoke_tables, WINDOW)):
        plan = _plan(df)
        scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "l_shipdate" in line or "o_orderdate" in line]
        assert scans and "claimscope-dx-claims" not in plan
        assert any("PushedFilters" in line and "GreaterThanOrEqual" in line for line in plan.splitlines())


def test_bloom_filter_of_in_window_claims_reaches_the_lines(spark, tmp_path):
    """With claims as tables, Spark filters the lines' scan by the ids of in-window headers."""
    from claimscope.plans import cohort
    from claimscope.sources import load_tables
    from claimscope.sources.testdata import VIEW_SQL, WINDOW, register_base_tables

    register_base_tables(spark, "/root/testdata/sf0.001")
    for name, sql in VIEW_SQL.items():
        spark.sql(sql).write.parquet(f"{tmp_path}/{name}")
    options = {
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
        "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    for k, v in options.items():
        spark.conf.set(k, v)
    try:
        t = load_tables(spark, str(tmp_path))
        df = cohort.dx_cohort_detail(t, WINDOW)
        plan = _plan(df)
        found = df.count()
    finally:
        for k in options:
            spark.conf.unset(k)
    assert "might_contain" in plan and "bloom_filter_agg" in plan
    assert found == cohort.dx_cohort_detail(load_tables(spark, str(tmp_path)), WINDOW).count()


def test_a_wide_member_changes_no_other_members_way(spark):
    """Members are routed inside the plan: the plan is the same with and without a wide member."""
    import datetime as dt

    from builders import tables

    from claimscope.plans import quality

    day = dt.date(2020, 1, 1)
    few = [{"eligibility_id": i, "member_id": 2, "cov_start_dt": day, "cov_end_dt": day} for i in range(3)]
    many = [{"eligibility_id": 100 + i, "member_id": 1, "cov_start_dt": day + dt.timedelta(days=i), "cov_end_dt": day + dt.timedelta(days=i)} for i in range(300)]
    nobody = [{"eligibility_id": 900 + i, "member_id": None, "cov_start_dt": day, "cov_end_dt": day} for i in range(300)]
    plans, counts = [], []
    for spans in (few, few + many + nobody):
        df = quality.overlapping_spans(tables(spark, eligibility_fact=spans), strict=True)
        plans.append(re.sub(r"#\d+L?|plan_id=\d+|ExistingRDD.*|LocalTableScan.*", "", _plan(df)))
        counts.append(df.count())
    assert plans[0] == plans[1] and counts == [3, 3]


def test_wide_member_spans_use_the_block_join(spark):
    """A member with more spans than the pairwise bound is never paired span by span."""
    import datetime as dt

    from builders import tables

    from claimscope.plans import quality

    base = dt.date(2015, 1, 1)
    spans = [
        {"eligibility_id": i, "member_id": 1, "cov_start_dt": base + dt.timedelta(days=10 * i), "cov_end_dt": base + dt.timedelta(days=10 * i + 14)}
        for i in range(quality.PAIRWISE_MAX_SPANS + 20)
    ]
    t = tables(spark, eligibility_fact=spans)
    df = quality.overlapping_spans(t)
    # spans that reach the pairwise join come through the anti-join with wide members
    plan = _plan(df)
    assert "_lvl" in plan and "LeftAnti" in plan and "LeftSemi" in plan
    # consecutive spans overlap by 5 days: exactly n - 1 pairs
    assert df.count() == quality.PAIRWISE_MAX_SPANS + 19
