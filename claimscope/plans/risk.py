"""Cost tiers by descending percent_rank of in-window paid totals.

Two populations, kept apart on purpose: ``condition`` ranks only members of
the any-time condition set, ``all`` ranks every member with in-window claims
(the one the member summary uses).  A member whose paid amounts are all NULL
has a NULL total, which sorts first (NULLS FIRST) and lands in 'Top 5%'.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimscope import params as P
from claimscope.functions import cost_bucket, percentile_1dp
from claimscope.operators import percent_rank_desc
from claimscope.params import Condition, Window
from claimscope.plans.utilization import member_utilization, utilization_summary
from claimscope.sources.tables import ClaimsTables


def with_cost_tier(totals: DataFrame, value: str = "total_paid_amt", **rank_options) -> DataFrame:
    """``totals`` (one row per member) plus cost_percentile, percentile (×100, 1 dp) and cost_bucket."""
    ranked = percent_rank_desc(totals, value, "cost_percentile", **rank_options)
    return ranked.withColumn("percentile", percentile_1dp("cost_percentile")).withColumn(
        "cost_bucket", cost_bucket("cost_percentile")
    )


def cost_buckets(
    t: ClaimsTables,
    w: Window = P.DEFAULT_WINDOW,
    cond: Condition = P.DIABETES,
    population: str = "condition",
    **rank_options,
) -> DataFrame:
    """member_id, measurement_year, total_paid_amt, percentile (×100, 1 dp), cost_bucket."""
    if population == "condition":
        totals = utilization_summary(t, w, cond)
    elif population == "all":
        totals = member_utilization(t, w)
    else:
        raise ValueError(f"population must be 'condition' or 'all', not {population!r}")
    ranked = with_cost_tier(totals.select("member_id", "total_paid_amt"), **rank_options)
    return ranked.select(
        "member_id",
        F.lit(w.measurement_year).alias("measurement_year"),
        "total_paid_amt",
        "percentile",
        "cost_bucket",
    )
