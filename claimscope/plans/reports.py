"""The study's deliverables as written reports, in the original row order.

Each report is a job plus the ORDER BY of the original query.  SQL puts
NULLs last for ASC and first for DESC; Spark's defaults differ, so the
orders are spelled out.  Sorting is a distributed range sort and the writer
emits one file per range in order — no single-task funnel.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimscope import params as P
from claimscope.operators.row_number import with_row_number
from claimscope.params import Condition, Window
from claimscope.plans import adherence, cohort, quality, risk, summary, utilization
from claimscope.sources.sinks import deliver_csv, write_parquet
from claimscope.sources.tables import ClaimsTables

Builder = Callable[[ClaimsTables, Window, Condition], DataFrame]


def _asc(c: str) -> tuple[str, str]:
    return (c, "asc")


def _desc(c: str) -> tuple[str, str]:
    return (c, "desc")


def _order(spec: tuple[str, str]) -> Column:
    name, direction = spec
    return F.col(name).asc_nulls_last() if direction == "asc" else F.col(name).desc_nulls_first()


REPORTS: dict[str, tuple[Builder, list[tuple[str, str]]]] = {
    "cohort_dx": (lambda t, w, c: cohort.dx_cohort_detail(t, w, c), [_asc("member_id")]),
    "cohort_rx": (lambda t, w, c: cohort.rx_cohort_detail(t, w, c), [_asc("member_id")]),
    "cohort_results": (lambda t, w, c: cohort.combined_cohort(t, w, c), [_asc("member_id"), _asc("cohort_reason")]),
    "pdc_results": (lambda t, w, c: adherence.pdc(t, w, c, by_class=True), [_asc("member_id"), _asc("therapeutic_class")]),
    "utilization_results": (lambda t, w, c: utilization.utilization_summary(t, w, c), [_desc("total_paid_amt")]),
    "cost_buckets": (lambda t, w, c: risk.cost_buckets(t, w, c), [_desc("total_paid_amt")]),
    "dq_missing_eligibility": (lambda t, w, c: quality.missing_eligibility(t), [_asc("member_id")]),
    "dq_service_outside_eligibility": (lambda t, w, c: quality.service_outside_span(t), [_asc("member_id")]),
    "dq_nonpositive_paid": (lambda t, w, c: quality.nonpositive_paid(t), [_asc("paid_amt")]),
    "dq_duplicate_claims": (lambda t, w, c: quality.duplicate_claims(t.medical_claim_fact), []),
    "dq_invalid_days_supply": (lambda t, w, c: quality.invalid_days_supply(t), []),
    "dq_overlapping_eligibility": (lambda t, w, c: quality.overlapping_spans(t), [_asc("member_id")]),
    "dq_lines_missing_dx": (lambda t, w, c: quality.lines_missing_dx(t), [_asc("member_id")]),
    "dq_dashboard": (lambda t, w, c: quality.dq_dashboard(t), [_desc("failed_count")]),
    "master": (lambda t, w, c: summary.master_summary(t, w, c), [_desc("total_paid_amt"), _asc("pdc")]),
}


def report(name: str, t: ClaimsTables, w: Window = P.DEFAULT_WINDOW, cond: Condition = P.DIABETES) -> DataFrame:
    """One report, sorted as the original query sorts it."""
    build, order = REPORTS[name]
    df = build(t, w, cond)
    return df.orderBy(*[_order(o) for o in order]) if order else df


def numbered_report(name: str, t: ClaimsTables, w: Window = P.DEFAULT_WINDOW, cond: Condition = P.DIABETES) -> DataFrame:
    """One report with ``row_number``, its place in the original order; ties by the other columns, as they stand."""
    build, order = REPORTS[name]
    df = build(t, w, cond)
    named = {c for c, _ in order}
    return with_row_number(df, [_order(o) for o in [*order, *(_asc(c) for c in df.columns if c not in named)]])


def run_reports(
    t: ClaimsTables,
    out_dir: str,
    w: Window = P.DEFAULT_WINDOW,
    cond: Condition = P.DIABETES,
    fmt: str = "csv",
    names: Iterable[str] | None = None,
) -> list[str]:
    """Write the reports under ``out_dir/<name>``: header CSV with a manifest, or Parquet partitioned by measurement_year."""
    written = []
    for name in names or REPORTS:
        df = report(name, t, w, cond)
        path = f"{out_dir.rstrip('/')}/{name}"
        if fmt == "csv":
            deliver_csv(df, path)
        else:
            write_parquet(df, path)
        written.append(path)
    return written
