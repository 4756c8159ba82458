"""Semantics the study data never exercises (nulls, inverted fills, ties, leap days, fan-out…)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from builders import basic_dims, d, tables
from conftest import rows
from pyspark.sql import functions as F

from claimscope import params as P
from claimscope.functions import age_years
from claimscope.params import Window
from claimscope.plans import adherence, cohort, quality, risk, summary, utilization
from claimscope.sources import apply_defaults, conform

W = P.DEFAULT_WINDOW
SPAN = {"eligibility_id": 1, "member_id": 1, "cov_start_dt": d("2023-01-01"), "cov_end_dt": d("2023-12-31")}


def _fill(i, member, ndc, fill_dt, days):
    return {"rx_claim_id": i, "member_id": member, "ndc": ndc, "fill_dt": d(fill_dt), "days_supply": days}


def test_null_days_supply_covers_to_window_end(spark):  # N1
    t = tables(spark, **basic_dims(), eligibility_fact=[SPAN], pharmacy_claim_fact=[_fill(1, 1, "00000000001", "2023-12-01", None)])
    assert rows(adherence.pdc(t, W), "member_id", "covered_days") == [(1, 31)]


def test_nonpositive_days_supply_covers_nothing(spark):  # N2
    fills = [_fill(1, 1, "00000000001", "2023-03-01", 0), _fill(2, 2, "00000000001", "2023-03-01", -5), _fill(3, 2, "00000000001", "2023-04-01", 10)]
    spans = [SPAN, dict(SPAN, eligibility_id=2, member_id=2)]
    t = tables(spark, **basic_dims(), eligibility_fact=spans, pharmacy_claim_fact=fills)
    assert rows(adherence.pdc(t, W), "member_id", "covered_days") == [(2, 10)]


def test_null_total_sorts_first(spark):  # N3
    claims = [
        {"claim_id": 1, "member_id": 1, "claim_type": "PROF", "service_from_dt": d("2023-02-01"), "paid_amt": None},
    ] + [
        {"claim_id": 10 + i, "member_id": 10 + i, "claim_type": "PROF", "service_from_dt": d("2023-02-01"), "paid_amt": Decimal(100 + i)}
        for i in range(20)
    ]
    t = tables(spark, medical_claim_fact=claims)
    got = {r["member_id"]: (r["percentile"], r["cost_bucket"]) for r in risk.cost_buckets(t, W, population="all").collect()}
    assert got[1] == (Decimal("0.0"), "Top 5%")
    assert got[29] == (Decimal("5.0"), "Top 5%")  # highest total: rank 2 of 21
    assert got[10] == (Decimal("100.0"), "Bottom 50%")


def test_leap_day_age(spark):  # N4
    df = spark.createDataFrame([(d("2000-02-29"),)], "dob date")
    got = df.select(
        age_years("dob", dt.date(2023, 2, 28)).alias("a"),
        age_years("dob", dt.date(2023, 3, 1)).alias("b"),
        age_years("dob", dt.date(2024, 2, 29)).alias("c"),
    ).first()
    assert (got["a"], got["b"], got["c"]) == (22, 23, 24)


def test_average_rounds_once(spark):  # N5
    # 9,999 claims of 0.01 and 10,001 of 0.00: mean 0.0049995 -> 0.00 (avg() at scale 6 would say 0.01)
    n_claims = 20000
    claims = (
        spark.range(n_claims)
        .select(
            (F.col("id") + 1).alias("claim_id"),
            F.lit(1).cast("bigint").alias("member_id"),
            F.lit("PROF").alias("claim_type"),
            F.lit(d("2023-05-01")).alias("service_from_dt"),
            F.when(F.col("id") < 9999, F.lit(Decimal("0.01"))).otherwise(F.lit(Decimal("0.00"))).cast("decimal(12,2)").alias("paid_amt"),
        )
    )
    t = tables(spark, **basic_dims(), pharmacy_claim_fact=[_fill(1, 1, "00000000001", "2022-01-01", 30)])
    t = t.replace(medical_claim_fact=conform(claims, "medical_claim_fact"))
    got = utilization.utilization_summary(t, W).first()
    assert got["avg_paid_per_claim"] == Decimal("0.00")
    naive = claims.agg(F.round(F.avg("paid_amt"), 2).alias("x")).first()["x"]
    assert naive == Decimal("0.01")


def test_threshold_on_rounded_pdc(spark):  # N6
    w = Window(dt.date(2020, 1, 1), dt.date(2020, 1, 1) + dt.timedelta(days=1999))
    span = dict(SPAN, cov_start_dt=w.start, cov_end_dt=w.end)
    t = tables(spark, **basic_dims(), eligibility_fact=[span], pharmacy_claim_fact=[_fill(1, 1, "00000000001", "2020-01-01", 1599)])
    r = adherence.pdc(t, w).first()
    assert (r["covered_days"], r["eligible_days"], r["pdc"], r["adherence_status"]) == (1599, 2000, Decimal("0.800"), "ADHERENT")


def test_pdc_above_one_is_kept(spark):  # N7
    span = dict(SPAN, cov_start_dt=d("2023-07-01"), cov_end_dt=d("2023-07-31"))
    t = tables(spark, **basic_dims(), eligibility_fact=[span], pharmacy_claim_fact=[_fill(1, 1, "00000000001", "2023-06-01", 62)])
    # fill_dt 06-01 is in the window; 62 days cover 06-01..08-01 (62) vs 31 eligible
    assert rows(adherence.pdc(t, W), "covered_days", "eligible_days", "pdc") == [(62, 31, Decimal("2.000"))]


def test_fill_before_window_never_carries_over(spark):  # N8
    fills = [_fill(1, 1, "00000000001", "2022-12-15", 90), _fill(2, 1, "00000000001", "2023-03-01", 10)]
    t = tables(spark, **basic_dims(), eligibility_fact=[SPAN], pharmacy_claim_fact=fills)
    assert rows(adherence.pdc(t, W), "covered_days") == [(10,)]


def test_overlapping_spans_double_count_eligibility(spark):
    spans = [SPAN, dict(SPAN, eligibility_id=2, cov_start_dt=d("2023-12-01"), cov_end_dt=d("2024-03-31"))]
    t = tables(spark, eligibility_fact=spans)
    assert rows(adherence.eligible_days(t.eligibility_fact, W)) == [(1, 365 + 31)]


def test_by_class_and_member_grain(spark):
    fills = [_fill(1, 1, "00000000001", "2023-01-01", 10), _fill(2, 1, "00000000002", "2023-01-06", 10)]
    t = tables(spark, **basic_dims(), eligibility_fact=[SPAN], pharmacy_claim_fact=fills)
    assert rows(adherence.pdc(t, W, by_class=True), "therapeutic_class", "covered_days") == [("Antidiabetic", 10), ("Insulin", 10)]
    assert rows(adherence.pdc(t, W, by_class=False), "covered_days") == [(15,)]


def _dx_claim(claim_id, member, date, paid=Decimal("100.00"), ctype="PROF"):
    return {"claim_id": claim_id, "member_id": member, "claim_type": ctype, "service_from_dt": d(date), "paid_amt": paid}


def _study_like(spark, extra_spans=()):
    members = [{"member_id": m, "dob": d("1960-01-01"), "sex": "F", "state": "TX "} for m in (1, 2, 3)]
    claims = [_dx_claim(1, 1, "2023-03-01", Decimal("9000.00"), "IP"), _dx_claim(2, 2, "2023-04-01"), _dx_claim(3, 3, "2023-05-01")]
    lines = [{"claim_line_id": 100 + c, "claim_id": c} for c in (1, 2, 3)]
    bridge = [{"claim_line_id": 100 + c, "dx_seq": 1, "icd10": "E11.9"} for c in (1, 2, 3)]
    spans = [dict(SPAN, eligibility_id=m, member_id=m, product_line="Medicare") for m in (1, 2, 3)] + list(extra_spans)
    fills = [_fill(1, 2, "00000000001", "2023-01-01", 365), _fill(2, 3, "00000000001", "2023-01-01", 30), _fill(3, 4, "00000000001", "2023-02-01", 30)]
    return tables(
        spark,
        **basic_dims(),
        member_dim=members,
        medical_claim_fact=claims,
        medical_claim_line_fact=lines,
        medical_claim_line_dx_bridge=bridge,
        eligibility_fact=spans,
        pharmacy_claim_fact=fills,
    )


def test_no_rx_data_member_is_flagged(spark):  # N11, N12-like ties
    t = _study_like(spark)
    got = {r["member_id"]: r for r in summary.master_summary(t, W).collect()}
    assert got[1]["adherence_status"] == "NO RX DATA" and got[1]["pdc"] == Decimal("0")
    assert got[1]["cost_bucket"] == "Top 5%" and got[1]["clinical_risk_flag"] == P.RISK_HIGH
    assert got[2]["adherence_status"] == "ADHERENT" and got[2]["clinical_risk_flag"] == P.RISK_STABLE
    assert got[3]["clinical_risk_flag"] == P.RISK_MODERATE
    assert got[1]["state"] == "TX"  # CHAR padding trimmed on ingest


def test_master_fans_out_over_spans(spark):
    extra = [dict(SPAN, eligibility_id=9, member_id=1, cov_start_dt=d("2021-01-01"), cov_end_dt=d("2021-12-31"), product_line="Commercial")]
    t = _study_like(spark, extra)
    lines = rows(summary.master_summary(t, W), "member_id", "product_line")
    assert lines == [(1, "Commercial"), (1, "Medicare"), (2, "Medicare"), (3, "Medicare")]


def test_orphan_fill_counts_for_condition_members_only(spark):  # D9 vs D2
    t = _study_like(spark)
    assert 4 in {r["member_id"] for r in cohort.condition_members(t).collect()}
    assert 4 not in {r["member_id"] for r in cohort.rx_cohort_detail(t, W).collect()}


def test_dx_wins_with_its_own_date(spark):
    t = _study_like(spark)
    got = {r["member_id"]: (r["cohort_reason"], r["index_dt"]) for r in cohort.combined_cohort(t, W).collect()}
    assert got[2] == ("DX", d("2023-04-01"))  # RX fill on 01-01 is earlier but DX wins


def test_overlap_check_one_sided_vs_strict(spark):
    spans = [
        dict(SPAN, eligibility_id=1, cov_start_dt=d("2023-06-01"), cov_end_dt=d("2023-12-31")),
        dict(SPAN, eligibility_id=2, cov_start_dt=d("2023-01-01"), cov_end_dt=d("2023-03-31")),  # wholly before, higher id
        dict(SPAN, eligibility_id=3, cov_start_dt=d("2023-12-01"), cov_end_dt=d("2024-02-28")),  # true overlap with 1
    ]
    t = tables(spark, eligibility_fact=spans)
    # one-sided: (1,2) is flagged although span 2 lies wholly before span 1; (2,3) is not (03-31 < 12-01)
    one_sided = rows(quality.overlapping_spans(t), "span1_start", "span2_start")
    assert one_sided == [(d("2023-06-01"), d("2023-01-01")), (d("2023-06-01"), d("2023-12-01"))]
    strict = rows(quality.overlapping_spans(t, strict=True), "span1_start", "span2_start")
    assert strict == [(d("2023-06-01"), d("2023-12-01"))]


def test_service_outside_lists_each_uncovering_span(spark):
    spans = [SPAN, dict(SPAN, eligibility_id=2, cov_start_dt=d("2024-01-01"), cov_end_dt=d("2024-12-31"))]
    t = tables(spark, eligibility_fact=spans, medical_claim_fact=[_dx_claim(1, 1, "2023-05-01")])
    assert quality.missing_eligibility(t).count() == 0
    assert rows(quality.service_outside_span(t), "cov_start_dt") == [(d("2024-01-01"),)]


def test_nonpositive_paid_skips_null(spark):
    claims = [_dx_claim(1, 1, "2023-05-01", None), _dx_claim(2, 1, "2023-05-01", Decimal("0")), _dx_claim(3, 1, "2023-05-01", Decimal("-1"))]
    t = tables(spark, medical_claim_fact=claims)
    assert rows(quality.nonpositive_paid(t), "claim_id") == [(2,), (3,)]


def test_defaults_fill_only_absent_columns(spark):
    df = spark.createDataFrame([("E11.9", None)], "icd10 string, is_diabetes_flag boolean")
    out = apply_defaults(df, "diagnosis_dim").first()
    assert out["is_diabetes_flag"] is None  # explicit NULL stays NULL
    assert out["is_htn_flag"] is False and out["is_hf_flag"] is False
    with_ts = apply_defaults(spark.createDataFrame([(1,)], "eligibility_id long"), "eligibility_fact")
    assert with_ts.first()["load_dt"] is not None


def test_inverted_span_fails_like_sql(spark):  # N9: eligible_days = 0 is a division by zero
    span = dict(SPAN, cov_start_dt=d("2023-05-02"), cov_end_dt=d("2023-05-01"))
    t = tables(spark, **basic_dims(), eligibility_fact=[span], pharmacy_claim_fact=[_fill(1, 1, "00000000001", "2023-03-01", 10)])
    with pytest.raises(Exception):
        adherence.pdc(t, W).collect()


def test_missing_eligibility_paths_agree(spark):
    """The sweep, an anti-join with BETWEEN and brute force give the same claims."""
    import random

    rnd = random.Random(3)
    spans, claims = [], []
    for m in range(4):
        for i in range(30):
            s = d("2022-01-01") + dt.timedelta(days=rnd.randint(0, 700))
            e = s + dt.timedelta(days=rnd.choice([-2, 0, 10, 60, 200]))
            spans.append({"eligibility_id": m * 100 + i, "member_id": m, "cov_start_dt": s, "cov_end_dt": e})
        for c in range(60):
            day = d("2021-12-01") + dt.timedelta(days=rnd.randint(0, 800))
            claims.append({"claim_id": m * 1000 + c, "member_id": m, "claim_type": "PROF", "service_from_dt": day})
    claims.append({"claim_id": 9999, "member_id": None, "claim_type": "ER", "service_from_dt": d("2022-05-01")})
    claims.append({"claim_id": 9998, "member_id": 1, "claim_type": "ER", "service_from_dt": None})
    t = tables(spark, eligibility_fact=spans, medical_claim_fact=claims)
    swept = [tuple(r) for r in quality.missing_eligibility(t).collect()]
    c_df, e_df = t.medical_claim_fact.alias("c"), t.eligibility_fact.alias("e")
    inside = (F.col("c.member_id") == F.col("e.member_id")) & F.col("c.service_from_dt").between(F.col("e.cov_start_dt"), F.col("e.cov_end_dt"))
    joined = [(quality.P.CHECK_MISSING_ELIGIBILITY, *r) for r in c_df.join(e_df, inside, "left_anti").select("member_id", "service_from_dt", "claim_type").collect()]
    key = lambda r: repr(r)
    assert sorted(swept, key=key) == sorted(joined, key=key)
    brute = []
    for c in claims:
        ok = any(
            sp["member_id"] == c["member_id"] and c["service_from_dt"] is not None and sp["cov_start_dt"] <= c["service_from_dt"] <= sp["cov_end_dt"]
            for sp in spans
        )
        if not ok:
            brute.append(("Missing Eligibility", c["member_id"], c["service_from_dt"], c["claim_type"]))
    assert sorted(swept, key=key) == sorted(brute, key=key)


def test_rx_only_member_without_claims(spark):
    """RX-only cohort member with no in-window medical claims: 'RX' reason, 'No Claims' tier, zero counts."""
    members = [{"member_id": m, "dob": d("1960-01-01"), "sex": "F", "state": "TX"} for m in (1, 2, 3, 5)]
    spans = [dict(SPAN, eligibility_id=m, member_id=m, product_line="Medicare") for m in (1, 2, 3, 5)]
    fills = [_fill(1, 2, "00000000001", "2023-01-01", 365), _fill(2, 3, "00000000001", "2023-01-01", 30), _fill(9, 5, "00000000002", "2023-03-01", 300)]
    t = tables(
        spark,
        **basic_dims(),
        member_dim=members,
        medical_claim_fact=[_dx_claim(1, 1, "2023-03-01", Decimal("9000.00"), "IP"), _dx_claim(2, 2, "2023-04-01"), _dx_claim(3, 3, "2023-05-01")],
        medical_claim_line_fact=[{"claim_line_id": 100 + c, "claim_id": c} for c in (1, 2, 3)],
        medical_claim_line_dx_bridge=[{"claim_line_id": 100 + c, "dx_seq": 1, "icd10": "E11.9"} for c in (1, 2, 3)],
        eligibility_fact=spans,
        pharmacy_claim_fact=fills,
    )
    got = {r["member_id"]: r for r in summary.master_summary(t, W).collect()}
    r = got[5]
    assert (r["cohort_reason"], r["index_dt"]) == ("RX", d("2023-03-01"))
    assert (r["er_visits"], r["ip_admits"], r["office_visits"], r["total_paid_amt"]) == (0, 0, 0, Decimal("0"))
    assert r["cost_bucket"] == "No Claims"
    assert (r["covered_days"], r["pdc"], r["adherence_status"]) == (300, Decimal("0.822"), "ADHERENT")
    assert r["clinical_risk_flag"] == P.RISK_STABLE


def test_claims_of_a_hot_member_are_spread(spark):
    """A member with a third of the claims is dealt over several tasks, with the same rows."""
    spans = [{"eligibility_id": m, "member_id": m, "cov_start_dt": d("2022-01-01"), "cov_end_dt": d("2022-06-30")} for m in range(200)]
    spans += [{"eligibility_id": 1000, "member_id": 7, "cov_start_dt": d("2022-09-01"), "cov_end_dt": d("2022-12-31")}]
    claims = [{"claim_id": i, "member_id": 7 if i % 3 == 0 else i % 200, "service_from_dt": d("2022-08-01")} for i in range(1500)]
    t = tables(spark, eligibility_fact=spans, medical_claim_fact=claims)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = quality.service_outside_span(t)
        per_task = [r["count"] for r in out.where("member_id = 7").groupBy(F.spark_partition_id().alias("p")).count().collect()]
        want = [(c["member_id"], sp["cov_start_dt"]) for c in claims for sp in spans if sp["member_id"] == c["member_id"]]
        assert sorted((r["member_id"], r["cov_start_dt"]) for r in out.collect()) == sorted(want)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(per_task) > 1 and max(per_task) < 0.7 * sum(per_task)
