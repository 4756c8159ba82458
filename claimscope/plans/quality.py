"""Data-quality checks on claims and eligibility, and the pass/fail dashboard.

Detail reports list offending rows; the dashboard counts six of them (it
leaves out the per-span report, and its labels differ from the detail
reports' on purpose).  All checks read whole tables, and none measures them
while its plan is built.

Claims and spans meet on member_id.  Claims without coverage come from one sweep
over each member's days (``operators.sweep``).  The per-span report joins claims and spans,
members with many claims spread by frequency (``operators.skew``).  Span pairs are
found member by member: one with few spans compares them, one with many goes
through an exact block join (``operators.dyadic``); the plan itself counts spans
and sends each member its way, so a wide member changes nothing for the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimscope import params as P
from claimscope.operators import duplicate_keys, outside_points, repeated, salted_join
from claimscope.operators.dyadic import (
    day_number,
    interval_point_pairs,
    with_ancestors,
    with_prefix_cover,
    with_suffix_cover,
)
from claimscope.sources.tables import ClaimsTables

# A member with more spans than this is sent through the block join, which finds
# the same pairs without comparing all of them.
PAIRWISE_MAX_SPANS = 128


def _spans(t: ClaimsTables) -> DataFrame:
    return t.eligibility_fact.select("eligibility_id", "member_id", "cov_start_dt", "cov_end_dt")


def _uncovered_groups(t: ClaimsTables) -> DataFrame:
    """member_id, service_from_dt, claim_type and number (n_claims) of claims in no span of their member."""
    claims = t.medical_claim_fact.select("member_id", "service_from_dt", "claim_type")
    return outside_points(claims, _spans(t), "member_id", "service_from_dt", "cov_start_dt", "cov_end_dt", ["claim_type"], "n_claims")


def missing_eligibility(t: ClaimsTables) -> DataFrame:
    """Claims whose service date lies in no coverage span of their member.

    One sweep for all members; equal claims travel as one row with their
    number and come apart again at the end.
    """
    return repeated(_uncovered_groups(t), "n_claims").select(F.lit(P.CHECK_MISSING_ELIGIBILITY).alias("check_name"), "member_id", "service_from_dt", "claim_type")


def service_outside_span(t: ClaimsTables, **skew_options) -> DataFrame:
    """One row per (claim, span of its member) where the service date is outside that span.

    The original is a LEFT JOIN whose WHERE rejects the NULL span, i.e. an
    inner join; written as one so the planner need not prove it.  Claims of a
    member with a large share of them are dealt over as many tasks as the
    share asks for, the member's spans repeated in each.
    """
    claims = t.medical_claim_fact.select("claim_id", "member_id", "service_from_dt", "paid_amt")
    elig = t.eligibility_fact.select("member_id", "cov_start_dt", "cov_end_dt")
    pairs = salted_join(claims, elig, "member_id", salt_from=["claim_id", "service_from_dt", "paid_amt"], **skew_options)
    day = F.col("service_from_dt")
    outside = (day < F.col("cov_start_dt")) | (day > F.col("cov_end_dt"))
    return pairs.where(outside).select(F.lit(P.CHECK_SERVICE_OUTSIDE).alias("check_name"), "member_id", "service_from_dt", "cov_start_dt", "cov_end_dt", "paid_amt")


def nonpositive_paid(t: ClaimsTables) -> DataFrame:
    """Claims with paid_amt <= 0 (NULL amounts are not listed)."""
    return nonpositive_paid_rows(t.medical_claim_fact)


def nonpositive_paid_rows(claims: DataFrame) -> DataFrame:
    """Row-local form of :func:`nonpositive_paid` (works on a batch or a streaming DataFrame)."""
    return claims.where(F.col("paid_amt") <= 0).select(
        F.lit(P.CHECK_NONPOSITIVE_PAID).alias("check_name"),
        "claim_id",
        "member_id",
        "service_from_dt",
        "paid_amt",
        "claim_type",
    )


def duplicate_claims(claims: DataFrame) -> DataFrame:
    """claim_id values seen more than once, with their count."""
    return duplicate_keys(claims.select("claim_id"), ["claim_id"]).select(
        F.lit(P.CHECK_DUPLICATE_CLAIM).alias("check_name"), "claim_id", "occurrences"
    )


def invalid_days_supply(t: ClaimsTables) -> DataFrame:
    """Fills with days_supply <= 0 or NULL."""
    return invalid_days_supply_rows(t.pharmacy_claim_fact)


def invalid_days_supply_rows(fills: DataFrame) -> DataFrame:
    """Row-local form of :func:`invalid_days_supply` (works on a batch or a streaming DataFrame)."""
    ds = F.col("days_supply")
    return fills.where((ds <= 0) | ds.isNull()).select(
        F.lit(P.CHECK_INVALID_DAYS_SUPPLY).alias("check_name"),
        "rx_claim_id",
        "member_id",
        "fill_dt",
        "days_supply",
        "ndc",
    )


_SPAN_COLS = ("eligibility_id", "cov_start_dt", "cov_end_dt")


def _side(spans: DataFrame, p: str) -> DataFrame:
    return spans.select("member_id", *[F.col(c).alias(f"{p}_{c}") for c in _SPAN_COLS])


def _as_pair(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.select(
        "member_id",
        *[F.col(f"{a}_{c}").alias(f"a_{c}") for c in _SPAN_COLS],
        *[F.col(f"{b}_{c}").alias(f"b_{c}") for c in _SPAN_COLS],
    )


def _covering_pairs(spans: DataFrame) -> DataFrame:
    """Pairs where one span contains the other's start day: exact, via a block join (no all-pairs step).

    With x containing y's start: (a=x, b=y) when x has the lower id; otherwise,
    when x starts strictly earlier, (a=y, b=x) — y has the lower id and runs
    from after x's start, so a.end >= b.start holds once y's own end is checked.
    """
    hits = interval_point_pairs(_side(spans, "x"), _side(spans, "y"), "member_id", "x_cov_start_dt", "x_cov_end_dt", "y_cov_start_dt")
    x_id, y_id = F.col("x_eligibility_id"), F.col("y_eligibility_id")
    lower_x = _as_pair(hits.where(x_id < y_id), "x", "y")
    lower_y = _as_pair(
        hits.where((y_id < x_id) & (F.col("x_cov_start_dt") < F.col("y_cov_start_dt")) & (F.col("y_cov_end_dt") >= F.col("x_cov_start_dt"))),
        "y",
        "x",
    )
    return lower_x.unionByName(lower_y)


def _exists_by_day(spans: DataFrame, probe_day: Column, with_probe_cover, table_day: Column, agg, keep) -> DataFrame:
    """(member_id, eligibility_id) of spans for which the member's spans whose day falls in the probe's
    range have an aggregated id passing ``keep`` — a dominance test by block join, no pairs."""
    ids = spans.select("member_id", "eligibility_id", table_day.alias("_d"), probe_day.alias("_p"))
    table = (
        with_ancestors(ids.where(F.col("_d").isNotNull()), F.col("_d"))
        .groupBy("member_id", "_lvl", "_block")
        .agg(agg("eligibility_id").alias("_id"))
    )
    probes = with_probe_cover(ids.where(F.col("_p").isNotNull()), F.col("_p")).select("member_id", "eligibility_id", "_lvl", "_block")
    found = probes.join(table, ["member_id", "_lvl", "_block"]).groupBy("member_id", "eligibility_id").agg(agg("_id").alias("_id"))
    return found.where(keep(F.col("_id"), F.col("eligibility_id"))).select("member_id", "eligibility_id")


def _inverted_pairs(spans: DataFrame) -> DataFrame:
    """One-sided pairs where b ends before a starts although b has the higher id.

    Only spans that take part in such a pair are joined: a needs a higher id
    ending before its start (prefix max of ids over end days), b needs a lower
    id starting after its end (suffix min over start days).  Ordered data has
    none, so nothing is paired at all.
    """
    start, end = day_number("cov_start_dt"), day_number("cov_end_dt")
    as_a = _exists_by_day(spans, start - 1, with_prefix_cover, end, F.max, lambda found, own: found > own)
    as_b = _exists_by_day(spans.where(F.col("cov_start_dt").isNotNull()), end + 1, with_suffix_cover, start, F.min, lambda found, own: found < own)
    a = _side(spans.join(as_a, ["member_id", "eligibility_id"], "left_semi"), "a")
    b = _side(spans.join(as_b, ["member_id", "eligibility_id"], "left_semi"), "b")
    cond = (
        (F.col("a_eligibility_id") < F.col("b_eligibility_id"))
        & (F.col("b_cov_end_dt") < F.col("a_cov_start_dt"))
        & (F.col("b_cov_start_dt") < F.col("a_cov_start_dt"))
        & (F.col("a_cov_end_dt") >= F.col("b_cov_start_dt"))
    )
    return _as_pair(a.join(b, "member_id").where(cond), "a", "b")


def _null_bound_pairs(spans: DataFrame) -> DataFrame:
    """Pairs the one-sided test still flags when a bound is NULL (NOT NULL violations, so few rows):
    a without a start (only a.end is read), or b without an end starting before a."""
    a_ids, b_ids = F.col("a_eligibility_id"), F.col("b_eligibility_id")
    reach = F.col("a_cov_end_dt") >= F.col("b_cov_start_dt")
    no_start = _side(spans.where(F.col("cov_start_dt").isNull() & F.col("cov_end_dt").isNotNull()), "a").join(
        _side(spans, "b"), "member_id"
    ).where((a_ids < b_ids) & reach)
    no_end = _side(spans.where(F.col("cov_start_dt").isNotNull()), "a").join(
        _side(spans.where(F.col("cov_end_dt").isNull() & F.col("cov_start_dt").isNotNull()), "b"), "member_id"
    ).where((a_ids < b_ids) & reach & (F.col("a_cov_start_dt") > F.col("b_cov_start_dt")))
    return _as_pair(no_start, "a", "b").unionByName(_as_pair(no_end, "a", "b"))


def _pairwise(spans: DataFrame, strict: bool) -> DataFrame:
    """The test as written: self-join on member_id with the id / date comparison as residual.

    Only for members of few spans, so each member's comparisons are bounded.
    """
    cond = (F.col("a_eligibility_id") < F.col("b_eligibility_id")) & (F.col("a_cov_end_dt") >= F.col("b_cov_start_dt"))
    if strict:
        cond = cond & (F.col("b_cov_end_dt") >= F.col("a_cov_start_dt"))
    return _as_pair(_side(spans, "a").join(_side(spans, "b"), "member_id").where(cond), "a", "b")


def _span_pairs(t: ClaimsTables, strict: bool, pairwise_max: int = PAIRWISE_MAX_SPANS) -> DataFrame:
    """Span pairs of one member with a.id < b.id and a.end >= b.start (and b.end >= a.start if strict).

    Spans are counted per member in the plan.  Members of at most
    ``pairwise_max`` spans compare theirs; of the others every qualifying pair
    either has one span containing the other's start day (exact block join) or — in
    the one-sided test only — has b lying wholly before a, or a NULL bound.
    Spans without a member pair with nothing and are left out first.
    """
    spans = _spans(t).where(F.col("member_id").isNotNull())
    wide_members = spans.groupBy("member_id").agg(F.count(F.lit(1)).alias("_spans")).where(F.col("_spans") > pairwise_max).select("member_id")
    narrow = spans.join(wide_members, "member_id", "left_anti")
    wide = spans.join(wide_members, "member_id", "left_semi")
    covering = _covering_pairs(wide)
    if strict:
        return _pairwise(narrow, strict).unionByName(covering.where(F.col("b_cov_end_dt") >= F.col("a_cov_start_dt")))
    return _pairwise(narrow, strict).unionByName(covering).unionByName(_inverted_pairs(wide)).unionByName(_null_bound_pairs(wide))


def overlapping_spans(t: ClaimsTables, strict: bool = False, pairwise_max: int = PAIRWISE_MAX_SPANS) -> DataFrame:
    """Span pairs (lower id a, higher id b) of one member with a.end >= b.start.

    The original test is one-sided: it also flags a higher-id span lying
    wholly before the lower-id one.  ``strict=True`` also requires
    b.end >= a.start, i.e. a true overlap.
    """
    return _span_pairs(t, strict, pairwise_max).select(
        F.lit(P.CHECK_OVERLAPPING_ELIGIBILITY).alias("check_name"),
        "member_id",
        F.col("a_cov_start_dt").alias("span1_start"),
        F.col("a_cov_end_dt").alias("span1_end"),
        F.col("b_cov_start_dt").alias("span2_start"),
        F.col("b_cov_end_dt").alias("span2_end"),
    )


def _lines_without_dx(t: ClaimsTables) -> DataFrame:
    lines = t.medical_claim_line_fact.select("claim_line_id", "claim_id", "cpt_hcpcs")
    return lines.join(t.medical_claim_line_dx_bridge.select("claim_line_id"), "claim_line_id", "left_anti")


def lines_missing_dx(t: ClaimsTables) -> DataFrame:
    """Claim lines with no diagnosis row, with their claim header (orphan lines drop out)."""
    headers = t.medical_claim_fact.select("claim_id", "member_id", "service_from_dt")
    return _lines_without_dx(t).join(headers, "claim_id").select(
        F.lit(P.CHECK_LINE_MISSING_DX).alias("check_name"),
        "claim_line_id",
        "claim_id",
        "member_id",
        "service_from_dt",
        "cpt_hcpcs",
    )


def _count(label: str, df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("failed_count")).select(F.lit(label).alias("check_name"), "failed_count")


def dq_dashboard(t: ClaimsTables) -> DataFrame:
    """Six global counts → check_name, failed_count, status (PASS when 0)."""
    claims = t.medical_claim_fact
    parts = [
        _uncovered_groups(t).agg(F.coalesce(F.sum("n_claims"), F.lit(0)).cast("bigint").alias("failed_count")).select(F.lit(P.DASH_MISSING_ELIGIBILITY).alias("check_name"), "failed_count"),
        _count(P.DASH_NEGATIVE_PAID, claims.where(F.col("paid_amt") <= 0)),
        _count(P.DASH_DUPLICATE_CLAIMS, duplicate_keys(claims.select("claim_id"), ["claim_id"])),
        _count(P.DASH_INVALID_DAYS_SUPPLY, invalid_days_supply(t)),
        _count(P.DASH_OVERLAPPING_ELIGIBILITY, _span_pairs(t, strict=False)),
        _count(P.DASH_LINES_MISSING_DX, _lines_without_dx(t)),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    status = F.when(F.col("failed_count") == 0, P.PASS).otherwise(P.FAIL)
    return out.select("check_name", "failed_count", status.alias("status"))
