"""Reusable DataFrame operators the jobs are built from."""

from claimscope.operators.intervals import covered_days, covered_days_exploded, islands
from claimscope.operators.joins import fits_broadcast, salted_lookup, sized_broadcast
from claimscope.operators.keys import duplicate_keys, orphan_counts, orphan_report
from claimscope.operators.materialize import materialize
from claimscope.operators.pick import first_by_priority
from claimscope.operators.rank import percent_rank_desc
from claimscope.operators.skew import hot_keys, salted_join
from claimscope.operators.sweep import outside_points, repeated

__all__ = [
    "covered_days",
    "covered_days_exploded",
    "duplicate_keys",
    "first_by_priority",
    "fits_broadcast",
    "hot_keys",
    "islands",
    "materialize",
    "orphan_counts",
    "orphan_report",
    "outside_points",
    "percent_rank_desc",
    "repeated",
    "salted_join",
    "salted_lookup",
    "sized_broadcast",
]
