"""Condition cohorts from diagnoses and drug fills.

In a window, the diagnosis side starts from the claim headers, whose date filter
is pushed into the scan: the undated lines meet in-window headers first, and
only their lines meet the flagged rows of the bridge.  The headers' filter is
selective, so Spark can send a Bloom filter of in-window claim ids down to the
scan of the lines (``spark.sql.optimizer.runtime.bloomFilter.*`` set its sizes).
At any date there is nothing to start from but the flagged codes (a small,
size-checked broadcast): bridge and lines are reduced to key sets, then headers.
Member attributes are joined after the per-member aggregate, i.e. to one row per member.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimscope import params as P
from claimscope.functions import age_years
from claimscope.operators import first_by_priority, fits_broadcast, sized_broadcast
from claimscope.params import Condition, Window as MWindow
from claimscope.sources.tables import ClaimsTables


def checked_broadcast(t: ClaimsTables, key: tuple, df: DataFrame) -> DataFrame:
    """Broadcast ``df`` if its row count (measured once per table set) is under the limit."""
    return sized_broadcast(df, small=t.memo(("fits-broadcast", *key), lambda: fits_broadcast(df)))


def flagged_dx_codes(t: ClaimsTables, cond: Condition = P.DIABETES) -> DataFrame:
    codes = t.diagnosis_dim.where(F.col(cond.dx_flag)).select("icd10")
    return checked_broadcast(t, ("dx-codes", cond.dx_flag), codes)


def flagged_ndcs(t: ClaimsTables, cond: Condition = P.DIABETES, with_class: bool = False) -> DataFrame:
    cols = ["ndc", "therapeutic_class"] if with_class else ["ndc"]
    drugs = t.drug_dim.where(F.col(cond.rx_flag)).select(*cols)
    return checked_broadcast(t, ("ndcs", cond.rx_flag, with_class), drugs)


def flagged_lines(t: ClaimsTables, cond: Condition = P.DIABETES) -> DataFrame:
    """claim_line_id of every flagged diagnosis row (a line may repeat)."""
    return t.medical_claim_line_dx_bridge.join(flagged_dx_codes(t, cond), "icd10", "left_semi").select("claim_line_id")


def dx_claims(t: ClaimsTables, cond: Condition = P.DIABETES, w: MWindow | None = None) -> DataFrame:
    """(member_id, service_from_dt) of claims with a flagged diagnosis, at any date or in the window.

    In the window a claim comes once per flagged line; callers take minima or
    distinct days, so it is not made distinct here.
    """
    lines = t.medical_claim_line_fact.select("claim_id", "claim_line_id")
    if w is not None:
        headers = t.dated("medical_claim_fact", "service_from_dt", w).select("claim_id", "member_id", "service_from_dt")
        in_time = lines.join(headers, "claim_id")
        return in_time.join(flagged_lines(t, cond), "claim_line_id", "left_semi").select("member_id", "service_from_dt")
    # distinct on the join key: partial aggregate map-side, and the exchange it
    # creates is the one the next join needs
    flagged = lines.join(flagged_lines(t, cond).distinct(), "claim_line_id", "left_semi").select("claim_id").distinct()
    headers = t.medical_claim_fact.select("claim_id", "member_id", "service_from_dt")
    return headers.join(flagged, "claim_id", "left_semi").select("member_id", "service_from_dt")


def rx_fills(t: ClaimsTables, cond: Condition = P.DIABETES, w: MWindow | None = None) -> DataFrame:
    fills = t.pharmacy_claim_fact if w is None else t.dated("pharmacy_claim_fact", "fill_dt", w)
    return fills.select("member_id", "ndc", "fill_dt").join(flagged_ndcs(t, cond), "ndc", "left_semi").select("member_id", "fill_dt")


def _first_dates(events: DataFrame, date_col: str, out: str) -> DataFrame:
    return events.groupBy("member_id").agg(F.min(date_col).alias(out))


def member_keys(t: ClaimsTables) -> DataFrame:
    """Distinct member_id of member_dim.

    Filtering by an *inner* join with distinct keys (not a semi-join) keeps
    the filter above per-member aggregates: Catalyst pushes semi-joins below
    an aggregate, which would shuffle raw claim rows instead of partial
    aggregates.  The distinct's exchange is the one the join needs anyway.
    """
    return t.member_dim.select("member_id").distinct()


def _with_member(first: DataFrame, t: ClaimsTables) -> DataFrame:
    """Members' attributes; callers end with a distinct, since nothing keeps a
    member from being delivered twice."""
    members = t.member_dim.select("member_id", "sex", "state", "dob")
    return first.join(members, "member_id")


def dx_cohort_detail(t: ClaimsTables, w: MWindow = P.DEFAULT_WINDOW, cond: Condition = P.DIABETES) -> DataFrame:
    """Members with a flagged diagnosis on an in-window claim: first such service date, 'DX'."""
    first = _first_dates(dx_claims(t, cond, w), "service_from_dt", "first_dm_claim_dt")
    return _with_member(first, t).select(
        "member_id",
        "sex",
        "state",
        age_years("dob", w.age_asof).alias(f"age_{w.age_asof.year}"),
        "first_dm_claim_dt",
        F.lit(P.COHORT_REASON_DX).alias("cohort_reason"),
    ).distinct()


def rx_cohort_detail(t: ClaimsTables, w: MWindow = P.DEFAULT_WINDOW, cond: Condition = P.DIABETES) -> DataFrame:
    """Members with a flagged fill in window: first fill date, 'RX'."""
    first = _first_dates(rx_fills(t, cond, w), "fill_dt", "first_rx_fill_dt")
    return _with_member(first, t).select(
        "member_id",
        "sex",
        "state",
        age_years("dob", w.age_asof).alias(f"age_{w.age_asof.year}"),
        "first_rx_fill_dt",
        F.lit(P.COHORT_REASON_RX).alias("cohort_reason"),
    ).distinct()


def combined_cohort(
    t: ClaimsTables, w: MWindow = P.DEFAULT_WINDOW, cond: Condition = P.DIABETES, require_member: bool = True
) -> DataFrame:
    """One row per member qualifying by DX or RX; DX wins and keeps its own first date.

    ``require_member=False`` skips the member_dim filter for callers that
    inner-join member_dim right after (the member summary), saving a shuffle.
    """
    dx = _first_dates(dx_claims(t, cond, w), "service_from_dt", "index_dt").withColumn("cohort_reason", F.lit(P.COHORT_REASON_DX))
    rx = _first_dates(rx_fills(t, cond, w), "fill_dt", "index_dt").withColumn("cohort_reason", F.lit(P.COHORT_REASON_RX))
    picked = first_by_priority(dx.unionByName(rx), "member_id", ["cohort_reason"], ["index_dt"])
    if require_member:
        picked = picked.join(member_keys(t), "member_id")
    return picked.select("member_id", "index_dt", "cohort_reason", F.lit(w.measurement_year).alias("measurement_year"))


def condition_members(t: ClaimsTables, cond: Condition = P.DIABETES) -> DataFrame:
    """Members with a flagged diagnosis or fill at any time (no date filter).

    The diagnosis side requires a member_dim row; the fill side does not.
    Built once per table set and shared.
    """

    def build() -> DataFrame:
        dx = dx_claims(t, cond).select("member_id").distinct().join(member_keys(t), "member_id")
        rx = rx_fills(t, cond).select("member_id").distinct()
        return dx.unionByName(rx).distinct()

    return t.shared(("condition-members", cond.dx_flag, cond.rx_flag), build)


def window_first_event(t: ClaimsTables, w: MWindow = P.DEFAULT_WINDOW, cond: Condition = P.DIABETES) -> DataFrame:
    """The DX cohort in its window-function form: min() over (partition by member), then DISTINCT.

    Rows are first reduced to distinct (member, service date) pairs, so a
    member's window partition holds at most one row per day of the window.
    """
    days = dx_claims(t, cond, w).select("member_id", "service_from_dt").distinct()
    per_member = Window.partitionBy("member_id")
    first = days.select("member_id", F.min("service_from_dt").over(per_member).alias("first_dm_claim_dt")).distinct()
    return _with_member(first, t).select(
        "member_id",
        "sex",
        "state",
        age_years("dob", w.age_asof).alias(f"age_{w.age_asof.year}"),
        "first_dm_claim_dt",
        F.lit(P.COHORT_REASON_DX).alias("cohort_reason"),
    ).distinct()
