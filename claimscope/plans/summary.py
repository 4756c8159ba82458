"""Member-level master summary: cohort + demographics + coverage + PDC + utilization + cost tier + risk flag.

One row per (cohort member, eligibility span): the span join has no date
filter, so members with several spans appear once per span and members with
none drop out — the original's grain, kept as is (never de-duplicated).
Every input is keyed by member_id, so the joins share one hash partitioning.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimscope import params as P
from claimscope.functions import age_years, risk_flag
from claimscope.params import Condition, Window
from claimscope.plans.adherence import pdc
from claimscope.plans.cohort import combined_cohort
from claimscope.plans.risk import with_cost_tier
from claimscope.plans.utilization import member_utilization
from claimscope.sources.tables import ClaimsTables


def master_summary(t: ClaimsTables, w: Window = P.DEFAULT_WINDOW, cond: Condition = P.DIABETES, **rank_options) -> DataFrame:
    """The member summary, as one plan; a caller that needs it twice writes it once itself."""
    # the inner join with member_dim below already keeps only known members
    cohort = combined_cohort(t, w, cond, require_member=False).select("member_id", "index_dt", "cohort_reason")
    members = t.member_dim.select("member_id", "sex", "state", "dob")
    spans = t.eligibility_fact.select("member_id", "product_line")
    adherence = pdc(t, w, cond, by_class=False).select("member_id", "covered_days", "eligible_days", "pdc", "adherence_status")
    # one aggregate of in-window claims feeds both the visit counts and the cost tier (ranked over all claimants)
    usage = with_cost_tier(member_utilization(t, w), **rank_options).select(
        "member_id", "er_visits", "ip_admits", "office_visits", "total_paid_amt", "cost_bucket"
    )

    joined = (
        cohort.join(members, "member_id")
        .join(spans, "member_id")
        .join(adherence, "member_id", "left")
        .join(usage, "member_id", "left")
    )
    zero = F.lit(0).cast("bigint")
    pdc_or_zero = F.coalesce(F.col("pdc"), F.lit(Decimal("0")))
    return joined.select(
        "member_id",
        "sex",
        "state",
        age_years("dob", w.age_asof).cast("int").alias(f"age_{w.age_asof.year}"),
        "product_line",
        "cohort_reason",
        "index_dt",
        F.lit(w.measurement_year).alias("measurement_year"),
        F.coalesce("covered_days", zero).alias("covered_days"),
        F.coalesce("eligible_days", F.lit(P.DEFAULT_ELIGIBLE_DAYS).cast("bigint")).alias("eligible_days"),
        pdc_or_zero.alias("pdc"),
        F.coalesce("adherence_status", F.lit(P.NO_RX_DATA)).alias("adherence_status"),
        F.coalesce("er_visits", zero).alias("er_visits"),
        F.coalesce("ip_admits", zero).alias("ip_admits"),
        F.coalesce("office_visits", zero).alias("office_visits"),
        F.coalesce("total_paid_amt", F.lit(Decimal("0"))).alias("total_paid_amt"),
        F.coalesce("cost_bucket", F.lit(P.NO_CLAIMS)).alias("cost_bucket"),
        risk_flag("pdc", "cost_bucket").alias("clinical_risk_flag"),
    )


def risk_segments(master: DataFrame) -> DataFrame:
    """Members and rows per clinical_risk_flag of a master summary."""
    return master.groupBy("clinical_risk_flag").agg(
        F.count_distinct("member_id").alias("members"),
        F.count(F.lit(1)).alias("summary_rows"),
    )
