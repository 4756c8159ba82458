"""Column expressions shared by the jobs (all built-in Spark functions, no UDFs)."""

from claimscope.functions.dates import age_years, clipped_end, date_lit, in_window, overlap_days
from claimscope.functions.labels import adherence_status, cost_bucket, risk_flag
from claimscope.functions.numeric import avg_rounded, percentile_1dp, ratio_rounded

__all__ = [
    "adherence_status",
    "age_years",
    "avg_rounded",
    "clipped_end",
    "cost_bucket",
    "date_lit",
    "in_window",
    "overlap_days",
    "percentile_1dp",
    "ratio_rounded",
    "risk_flag",
]
