"""Cases that once gave wrong answers."""

from __future__ import annotations

import os

import pytest
from builders import basic_dims, d, tables
from conftest import rows

from claimscope import params as P
from claimscope.functions import age_years
from claimscope.plans import cohort
from claimscope.streaming import start_row_checks


def test_repeated_member_row_gives_one_cohort_row(spark):
    member = {"member_id": 1, "dob": d("1980-05-01"), "sex": "F", "state": "MA"}
    t = tables(
        spark,
        **basic_dims(),
        member_dim=[member, member],
        medical_claim_fact=[{"claim_id": 1, "member_id": 1, "service_from_dt": d("2023-02-01")}],
        medical_claim_line_fact=[{"claim_line_id": 1, "claim_id": 1}],
        medical_claim_line_dx_bridge=[{"claim_line_id": 1, "icd10": "E11.9"}],
        pharmacy_claim_fact=[{"rx_claim_id": 1, "member_id": 1, "ndc": "00000000001", "fill_dt": d("2023-03-01"), "days_supply": 30}],
    )
    for job in (cohort.dx_cohort_detail, cohort.rx_cohort_detail, cohort.window_first_event):
        assert job(t, P.DEFAULT_WINDOW).count() == 1


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo", "Asia/Tehran"])
def test_age_does_not_depend_on_the_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        cases = [("1985-11-02", "2005-11-02", 20), ("1986-10-25", "2004-10-25", 18), ("2000-02-29", "2023-02-28", 22), ("2000-02-29", "2023-03-01", 23), ("2000-02-29", "2024-02-29", 24), ("2030-01-01", "2029-12-31", 0)]
        for dob, asof, age in cases:
            df = spark.createDataFrame([(d(dob),)], "dob date")
            assert rows(df.select(age_years("dob", d(asof)).alias("age"))) == [(age,)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_stream_goes_on_in_a_later_application(spark, study, tmp_path):
    source, sink, checkpoint = (str(tmp_path / x) for x in ("source", "sink", "checkpoint"))
    fills = study.pharmacy_claim_fact
    ids = rows(fills, "rx_claim_id")[:2]
    for k, (row_id,) in enumerate(ids):
        bad = fills.where(f"rx_claim_id = {row_id}").withColumn("days_supply", fills["days_supply"] * 0)
        bad.write.mode("append").parquet(source)
        again = spark.newSession()  # knows nothing of the first run but the folder
        start_row_checks(again, "pharmacy_claim_fact", source, sink, checkpoint).awaitTermination(120)
        assert rows(spark.read.parquet(sink), "rx_claim_id") == ids[: k + 1]
    with pytest.raises(TypeError):
        start_row_checks(spark, "pharmacy_claim_fact", source, os.path.join(str(tmp_path), "other"))
