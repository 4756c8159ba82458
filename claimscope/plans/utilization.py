"""Utilization and spend per member in the window.

Counts are of claim headers by claim_type (not distinct visits).  The member
aggregate runs once over in-window claims (partial aggregate map-side, so a
member with a huge claim history is one row per task before the shuffle);
the condition filter is a join on the aggregated member rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimscope import params as P
from claimscope.functions import avg_rounded
from claimscope.params import Condition, Window
from claimscope.plans.cohort import checked_broadcast, condition_members
from claimscope.sources.tables import ClaimsTables


def _per_member(t: ClaimsTables, w: Window) -> DataFrame:
    claims = t.dated("medical_claim_fact", "service_from_dt", w).select("member_id", "claim_type", "paid_amt")
    return claims.groupBy("member_id").agg(
        F.count_if(F.col("claim_type") == P.CLAIM_TYPE_ER).alias("er_visits"),
        F.count_if(F.col("claim_type") == P.CLAIM_TYPE_IP).alias("ip_admits"),
        F.count_if(F.col("claim_type") == P.CLAIM_TYPE_PROF).alias("office_visits"),
        F.sum("paid_amt").alias("total_paid_amt"),
        F.count("paid_amt").alias("_paid_claims"),
    )


def member_utilization(t: ClaimsTables, w: Window = P.DEFAULT_WINDOW) -> DataFrame:
    """All members with in-window claims: visit counts and total paid."""
    return _per_member(t, w).select(
        "member_id",
        F.lit(w.measurement_year).alias("measurement_year"),
        "er_visits",
        "ip_admits",
        "office_visits",
        "total_paid_amt",
    )


def utilization_summary(t: ClaimsTables, w: Window = P.DEFAULT_WINDOW, cond: Condition = P.DIABETES) -> DataFrame:
    """Condition members (any-time flag) with in-window claims: counts, total and average paid."""
    # inner join with the (distinct) condition members keeps the filter above the aggregate
    members = condition_members(t, cond)
    per_member = _per_member(t, w).join(checked_broadcast(t, ("condition-members", cond.dx_flag, cond.rx_flag), members), "member_id")
    avg = F.when(F.col("_paid_claims") > 0, avg_rounded("total_paid_amt", "_paid_claims", 2))
    return per_member.select(
        "member_id",
        F.lit(w.measurement_year).alias("measurement_year"),
        "er_visits",
        "ip_admits",
        "office_visits",
        "total_paid_amt",
        avg.alias("avg_paid_per_claim"),
    )
