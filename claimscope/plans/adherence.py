"""Proportion of days covered (PDC).

Numerator: distinct days covered by flagged fills in the window, per member
(and therapeutic class), by interval merge — fills are never expanded into
days.  Denominator: eligible days in the window summed over coverage spans
(overlapping spans count twice, as in the original).  Members without an
eligible span drop out (inner join).  PDC = round(covered / eligible, 3) on
decimals, ADHERENT when the rounded value is >= 0.80.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimscope import params as P
from claimscope.functions import adherence_status, clipped_end, date_lit, overlap_days, ratio_rounded
from claimscope.operators import covered_days as merge_covered_days
from claimscope.operators import covered_days_exploded
from claimscope.params import Condition, Window
from claimscope.plans.cohort import flagged_ndcs
from claimscope.sources.tables import ClaimsTables


def clip_fills(t: ClaimsTables, w: Window = P.DEFAULT_WINDOW, cond: Condition = P.DIABETES, drop_invalid: bool = False) -> DataFrame:
    """Flagged in-window fills → member_id, therapeutic_class, fill_start, fill_end (cut at window end).

    A fill without days supply covers through the window's end, as in the study;
    ``drop_invalid`` leaves out those and fills of no days, which the quality check reports.
    """
    fills = t.dated("pharmacy_claim_fact", "fill_dt", w).select("member_id", "ndc", "fill_dt", "days_supply")
    if drop_invalid:
        fills = fills.where("days_supply > 0")
    return fills.join(flagged_ndcs(t, cond, with_class=True), "ndc").select(
        "member_id",
        "therapeutic_class",
        F.col("fill_dt").alias("fill_start"),
        clipped_end("fill_dt", "days_supply", w).alias("fill_end"),
    )


def covered_days(fills: DataFrame, by_class: bool = True, exploded: bool = False) -> DataFrame:
    keys = ["member_id", "therapeutic_class"] if by_class else ["member_id"]
    if exploded:
        return covered_days_exploded(fills, keys)
    # clustered by member only: the join with eligible days (on member_id) reuses the partitioning
    return merge_covered_days(fills, keys, cluster_by=["member_id"])


def eligible_days(eligibility: DataFrame, w: Window = P.DEFAULT_WINDOW) -> DataFrame:
    """Per member, eligible days in the window summed over every span overlapping it."""
    spans = eligibility.where((F.col("cov_start_dt") <= date_lit(w.end)) & (F.col("cov_end_dt") >= date_lit(w.start)))
    return spans.groupBy("member_id").agg(
        F.sum(overlap_days("cov_start_dt", "cov_end_dt", w)).cast("bigint").alias("eligible_days")
    )


def pdc(t: ClaimsTables, w: Window = P.DEFAULT_WINDOW, cond: Condition = P.DIABETES, by_class: bool = True, drop_invalid: bool = False) -> DataFrame:
    """PDC per member and therapeutic class (``by_class``) or per member (a day counts once)."""
    covered = covered_days(clip_fills(t, w, cond, drop_invalid), by_class=by_class)
    joined = covered.join(eligible_days(t.eligibility_fact, w), "member_id")
    ratio = ratio_rounded("covered_days", "eligible_days", P.PDC_DIGITS)
    keys = ["member_id", "therapeutic_class"] if by_class else ["member_id"]
    return joined.select(
        *keys,
        F.lit(w.measurement_year).alias("measurement_year"),
        "covered_days",
        "eligible_days",
        ratio.alias("pdc"),
        adherence_status(ratio).alias("adherence_status"),
    )
