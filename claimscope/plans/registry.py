"""Named jobs over the test-table views, as registered in ``__spark_entry__``.

Each job takes ``(spark, tables)`` and returns a DataFrame; the window is the
one that fits the test data (1998).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimscope.operators.materialize import scratch_path
from claimscope.plans import adherence, cohort, constraints, quality, reports, risk, summary, utilization
from claimscope.sources.layout import save_by_year, with_years
from claimscope.sources.sinks import deliver_csv, read_delivered, write_feed
from claimscope.sources.tables import ClaimsTables, conform, load_tables, table_counts
from claimscope.sources.testdata import WINDOW, raw_claims

Job = Callable[[SparkSession, ClaimsTables], DataFrame]


def _ingest_defaults(spark: SparkSession, t: ClaimsTables) -> DataFrame:
    """Dimensions delivered without some flag columns: the declared FALSE default fills them."""
    raw = t.raw
    dx = conform(raw["diagnosis_dim"].select("icd10", "dx_desc", "is_diabetes_flag"), "diagnosis_dim")
    drugs = conform(raw["drug_dim"].select("ndc", "therapeutic_class"), "drug_dim")

    def long(df, table, key, flags):
        rows = [F.struct(F.lit(f).alias("flag_name"), F.col(f).alias("flag_value")) for f in flags]
        return df.select(F.lit(table).alias("table_name"), F.col(key).alias("code"), F.inline(F.array(*rows)))

    return long(dx, "diagnosis_dim", "icd10", ["is_diabetes_flag", "is_htn_flag", "is_hf_flag"]).unionByName(
        long(drugs, "drug_dim", "ndc", ["is_antidiabetic_flag"])
    )


def _load_tables(spark: SparkSession, t: ClaimsTables) -> DataFrame:
    """The tables written once as the text feed they would arrive in, and loaded back by the declared schema."""
    base = t.memo(("feed",), lambda: write_feed(t, scratch_path(spark, "feed")))
    return table_counts(load_tables(spark, base, "csv"))


def _yearly(spark: SparkSession, t: ClaimsTables) -> ClaimsTables:
    """The tables with claims and fills laid out by year once."""

    def save() -> str:
        base = scratch_path(spark, "by-year")
        save_by_year(t, base)
        return base

    return with_years(t, t.memo(("by-year",), save))


def _delivered(spark: SparkSession, t: ClaimsTables) -> DataFrame:
    """The PDC report delivered as CSV and read back against its manifest."""
    df = reports.report("pdc_results", t, WINDOW)

    def deliver() -> str:
        path = scratch_path(spark, "delivery")
        deliver_csv(df, path)
        return path

    return read_delivered(spark, t.memo(("delivery",), deliver), df.schema)


JOBS: dict[str, Job] = {
    # cohorts
    "cohort_dx": lambda spark, t: cohort.dx_cohort_detail(t, WINDOW),
    "cohort_rx": lambda spark, t: cohort.rx_cohort_detail(t, WINDOW),
    "cohort_combined": lambda spark, t: cohort.combined_cohort(t, WINDOW),
    "condition_members": lambda spark, t: cohort.condition_members(t),
    "window_first_event": lambda spark, t: cohort.window_first_event(t, WINDOW),
    # adherence
    "pdc_fills": lambda spark, t: adherence.clip_fills(t, WINDOW),
    "covered_days": lambda spark, t: adherence.covered_days(adherence.clip_fills(t, WINDOW)),
    "covered_days_exploded": lambda spark, t: adherence.covered_days(adherence.clip_fills(t, WINDOW), exploded=True),
    "eligible_days": lambda spark, t: adherence.eligible_days(t.eligibility_fact, WINDOW),
    "pdc_by_class": lambda spark, t: adherence.pdc(t, WINDOW, by_class=True),
    "pdc_member": lambda spark, t: adherence.pdc(t, WINDOW, by_class=False),
    # utilization and cost
    "utilization_summary": lambda spark, t: utilization.utilization_summary(t, WINDOW),
    "member_utilization": lambda spark, t: utilization.member_utilization(t, WINDOW),
    "cost_buckets": lambda spark, t: risk.cost_buckets(t, WINDOW, population="condition"),
    "cost_buckets_all": lambda spark, t: risk.cost_buckets(t, WINDOW, population="all"),
    # data quality
    "dq_missing_eligibility": lambda spark, t: quality.missing_eligibility(t),
    "dq_service_outside_eligibility": lambda spark, t: quality.service_outside_span(t),
    "dq_nonpositive_paid": lambda spark, t: quality.nonpositive_paid(t),
    "dq_duplicate_claims": lambda spark, t: quality.duplicate_claims(raw_claims(spark, t)),
    "dq_invalid_days_supply": lambda spark, t: quality.invalid_days_supply(t),
    "dq_overlapping_eligibility": lambda spark, t: quality.overlapping_spans(t),
    "dq_overlapping_eligibility_strict": lambda spark, t: quality.overlapping_spans(t, strict=True),
    "dq_lines_missing_dx": lambda spark, t: quality.lines_missing_dx(t),
    "dq_dashboard": lambda spark, t: quality.dq_dashboard(t),
    # member summary
    "master_summary": lambda spark, t: summary.master_summary(t, WINDOW),
    "risk_segments": lambda spark, t: summary.risk_segments(summary.master_summary(t, WINDOW)),
    # reports in their original order, delivery, layout by year
    "ordered_cohort_dx": lambda spark, t: reports.numbered_report("cohort_dx", t, WINDOW),
    "ordered_pdc": lambda spark, t: reports.numbered_report("pdc_results", t, WINDOW),
    "ordered_utilization": lambda spark, t: reports.numbered_report("utilization_results", t, WINDOW),
    "ordered_master": lambda spark, t: reports.numbered_report("master", t, WINDOW),
    "delivered_pdc": _delivered,
    "yearly_pdc": lambda spark, t: adherence.pdc(_yearly(spark, t), WINDOW, by_class=False),
    "yearly_utilization": lambda spark, t: utilization.member_utilization(_yearly(spark, t), WINDOW),
    # declared constraints and ingest
    "dq_primary_key": lambda spark, t: constraints.primary_key_report(t),
    "dq_foreign_key": lambda spark, t: constraints.foreign_key_report(t),
    "dq_not_null": lambda spark, t: constraints.not_null_report(t),
    "dq_conformance": lambda spark, t: constraints.conformance_report(t.raw),
    "ingest_defaults": _ingest_defaults,
    "load_tables": _load_tables,
}

FLAGSHIP = "master_summary"
