"""Total row numbers, CSV deliveries with a manifest, and the layout by year."""

from __future__ import annotations

import datetime as dt
import glob
import os
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from claimscope.operators.row_number import with_row_number
from claimscope.params import DEFAULT_WINDOW as W
from claimscope.params import Window
from claimscope.plans import adherence, cohort, reports, summary, utilization
from claimscope.sources.layout import save_by_year, with_years
from claimscope.sources.sinks import deliver_csv, read_delivered


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_row_numbers_are_those_of_one_sorted_list(spark):
    rng = random.Random(5)
    data = [(i, rng.choice([None, 0.0, 0.0, float(rng.randrange(40))]), rng.choice("abc")) for i in range(3000)]
    df = spark.createDataFrame(data, "id long, total double, name string").repartition(7)
    order = [F.col("total").desc_nulls_first(), F.col("name").asc_nulls_last(), F.col("id").asc()]
    got = {r["id"]: r["row_number"] for r in with_row_number(df, order).collect()}
    want = sorted(data, key=lambda r: (r[1] is not None, -(r[1] or 0.0), r[2], r[0]))
    assert got == {r[0]: n for n, r in enumerate(want, 1)}


def test_row_numbers_of_nothing_and_of_equal_rows(spark):
    df = spark.createDataFrame([], "id long")
    assert with_row_number(df, [F.col("id")]).collect() == []
    same = spark.range(500).select(F.lit(1).alias("id"))
    assert sorted(r["row_number"] for r in with_row_number(same, [F.col("id")]).collect()) == list(range(1, 501))


def test_rows_are_numbered_within_ranges(spark, study):
    plan = _plan(reports.numbered_report("master", study))
    numbering = [line for line in plan.splitlines() if "row_number()" in line and "Window [" in line]
    assert numbering and all("], [_range#" in line for line in numbering)


def test_numbered_report_follows_the_written_order(study):
    numbered = reports.numbered_report("master", study).orderBy("row_number").collect()
    written = reports.report("master", study).collect()
    assert [r["row_number"] for r in numbered] == list(range(1, len(written) + 1))
    assert [(r["total_paid_amt"], r["pdc"]) for r in numbered] == [(r["total_paid_amt"], r["pdc"]) for r in written]


ODD = [(1, "a,b", 1.5, dt.date(2023, 1, 2)), (2, 'say "x"', None, None), (3, "two\nlines", 0.0, dt.date(1900, 1, 1)), (4, "é ü 漢", 2.0, None), (5, None, None, None), (6, "", 1.0, None)]
ODD_SCHEMA = "id long, name string, x double, day date"


def test_delivery_reads_back_what_was_written(spark, tmp_path):
    df = spark.createDataFrame(ODD, ODD_SCHEMA).repartition(3)
    path = str(tmp_path / "out")
    deliver_csv(df, path)
    assert sorted(map(tuple, read_delivered(spark, path, df.schema).collect()), key=lambda r: r[0]) == [(*r[:1], r[1] or None, *r[2:]) for r in ODD]
    listed = spark.read.json(path + "/_manifest").collect()
    assert sum(r["rows"] for r in listed) == len(ODD)
    assert {r["file"] for r in listed} == {os.path.basename(f) for f in glob.glob(path + "/part-*.csv")}


def test_delivery_of_no_rows(spark, tmp_path):
    path = str(tmp_path / "out")
    empty = spark.createDataFrame([], ODD_SCHEMA)
    deliver_csv(empty, path)
    assert read_delivered(spark, path, empty.schema).collect() == []


@pytest.mark.parametrize("damage", ["change", "drop", "add", "unlisted"])
def test_damaged_delivery_is_refused(spark, tmp_path, damage):
    path = str(tmp_path / "out")
    df = spark.range(100).repartition(2)
    deliver_csv(df, path)
    part = sorted(glob.glob(path + "/part-*.csv"))[0]
    text = open(part).read()
    # the writer's checksum beside the file would be asked first
    crc = os.path.join(path, "." + os.path.basename(part) + ".crc")
    if os.path.exists(crc):
        os.unlink(crc)
    if damage == "change":
        digit = text.rstrip("\n")[-1]
        open(part, "w").write(text.rstrip("\n")[:-1] + str((int(digit) + 1) % 10) + "\n")
    elif damage == "drop":
        os.unlink(part)
    elif damage == "add":
        open(path + "/part-99999-more.csv", "w").write(text)
    else:
        os.unlink(path + "/_manifest/_SUCCESS")
    with pytest.raises(ValueError, match="manifest"):
        read_delivered(spark, path, df.schema)


def _listed(df) -> set[int]:
    """How many folders each scan of a yearly table lists."""
    seen = set()
    leaves = df._jdf.queryExecution().sparkPlan().collectLeaves()
    for i in range(leaves.size()):
        scan = leaves.apply(i)
        if scan.getClass().getSimpleName() == "FileSourceScanExec" and "data_year" in scan.toString():
            seen.add(scan.selectedPartitions().partitionCount())
    return seen


def test_year_layout_lists_one_folder_for_one_year(spark, smoke_tables, tmp_path):
    save_by_year(smoke_tables, str(tmp_path), files=3)
    t = with_years(smoke_tables, str(tmp_path))
    w = Window.year(1998)
    years = glob.glob(str(tmp_path / "medical_claim_fact" / "data_year=*"))
    assert len(years) > 5
    assert all(len(glob.glob(y + "/*.parquet")) <= 3 for y in years)
    for df in (utilization.member_utilization(t, w), adherence.clip_fills(t, w), cohort.dx_claims(t, w=w)):
        assert _listed(df) == {1}
    assert _listed(t.dated("medical_claim_fact", "service_from_dt", Window("1996-07-01", "1997-06-30"))) == {2}
    assert rows(utilization.member_utilization(t, w)) == rows(utilization.member_utilization(smoke_tables, w))
    assert rows(cohort.condition_members(t)) == rows(cohort.condition_members(smoke_tables))


def test_year_layout_keeps_rows_without_a_day_and_the_jobs_results(spark, study, tmp_path):
    undated = study.medical_claim_fact.limit(1).withColumn("service_from_dt", F.lit(None).cast("date")).withColumn("claim_id", F.lit(-1).cast("int"))
    whole = study.replace(medical_claim_fact=study.medical_claim_fact.unionByName(undated))
    save_by_year(whole, str(tmp_path))
    t = with_years(whole, str(tmp_path))
    assert rows(t.medical_claim_fact.select("claim_id")) == rows(whole.medical_claim_fact.select("claim_id"))
    assert t.medical_claim_fact.schema == whole.medical_claim_fact.schema
    assert rows(summary.master_summary(t, W)) == rows(summary.master_summary(study, W))
    # a table put in place of a yearly one is read itself
    none = t.replace(medical_claim_fact=t.medical_claim_fact.limit(0))
    assert utilization.member_utilization(none, W).count() == 0


def test_year_layout_of_empty_tables(study, tmp_path):
    empty = study.replace(medical_claim_fact=study.medical_claim_fact.limit(0), pharmacy_claim_fact=study.pharmacy_claim_fact.limit(0))
    save_by_year(empty, str(tmp_path))
    t = with_years(empty, str(tmp_path))
    assert utilization.member_utilization(t, W).count() == 0 and adherence.pdc(t, W).count() == 0


def test_fills_without_days_can_be_left_out(spark, study):
    fill = study.pharmacy_claim_fact.join(study.drug_dim.where("is_antidiabetic_flag").select("ndc"), "ndc", "left_semi").where("year(fill_dt) = 2023").limit(1)
    fill = fill.withColumn("member_id", F.lit(999).cast("int"))
    cases = [fill.withColumn("days_supply", F.lit(n).cast("int")) for n in (None, 0, 30)]
    t = study.replace(pharmacy_claim_fact=cases[0].unionByName(cases[1]).unionByName(cases[2]))
    assert adherence.clip_fills(t, W).count() == 3
    kept = adherence.clip_fills(t, W, drop_invalid=True).collect()
    assert [(r["fill_end"] - r["fill_start"]).days for r in kept] in ([29], [(W.end - kept[0]["fill_start"]).days])
    # the one without days lasts to the end of the window unless left out
    whole = adherence.covered_days(adherence.clip_fills(t, W), by_class=False).first()["covered_days"]
    assert whole == (W.end - kept[0]["fill_start"]).days + 1
