"""Row-level checks on a file stream give the batch result, and resume without duplicates."""

from __future__ import annotations

import os
import shutil
import tempfile

from conftest import STUDY_DIR, rows

from claimscope.plans import quality
from claimscope.streaming import start_row_checks


def test_stream_matches_batch_and_resumes(spark, study):
    src = tempfile.mkdtemp(prefix="claimscope-stream-src-")
    out = tempfile.mkdtemp(prefix="claimscope-stream-out-")
    ckpt = tempfile.mkdtemp(prefix="claimscope-stream-ckpt-")
    # fills arrive as Parquet files; make some invalid rows
    fills = study.pharmacy_claim_fact
    bad = fills.where("rx_claim_id % 7 = 0").withColumn("days_supply", fills["days_supply"] * 0)
    fills.where("rx_claim_id % 7 <> 0").unionByName(bad).write.mode("overwrite").parquet(os.path.join(src, "in1"))

    q = start_row_checks(spark, "pharmacy_claim_fact", os.path.join(src, "in1"), out, checkpoint=ckpt)
    q.awaitTermination(120)
    got = spark.read.parquet(out)
    want = quality.invalid_days_supply_rows(study.pharmacy_claim_fact.where("rx_claim_id % 7 <> 0").unionByName(bad))
    assert rows(got, "rx_claim_id") == rows(want, "rx_claim_id")
    assert got.count() > 0

    # a second run with no new files emits nothing new
    q2 = start_row_checks(spark, "pharmacy_claim_fact", os.path.join(src, "in1"), out, checkpoint=ckpt)
    q2.awaitTermination(120)
    assert spark.read.parquet(out).count() == got.count()


def test_csv_stream_of_claims(spark):
    out = tempfile.mkdtemp(prefix="claimscope-stream-out-")
    ckpt = tempfile.mkdtemp(prefix="claimscope-stream-ckpt-")
    src = tempfile.mkdtemp(prefix="claimscope-stream-src-")
    shutil.copy(os.path.join(STUDY_DIR, "medical_claim_fact.csv"), os.path.join(src, "claims.csv"))
    q = start_row_checks(spark, "medical_claim_fact", src, out, fmt="csv", checkpoint=ckpt)
    q.awaitTermination(120)
    assert spark.read.parquet(out).count() == 0  # the study has no paid amount <= 0


def test_csv_stream_flags_new_bad_claims(spark):
    out = tempfile.mkdtemp(prefix="claimscope-stream-out-")
    ckpt = tempfile.mkdtemp(prefix="claimscope-stream-ckpt-")
    src = tempfile.mkdtemp(prefix="claimscope-stream-src-")
    with open(os.path.join(STUDY_DIR, "medical_claim_fact.csv"), encoding="utf-8") as f:
        header, first = f.readline(), f.readline()
    cols = header.strip().split(",")
    bad = first.strip().split(",")
    bad[cols.index("claim_id")] = "99001"
    bad[cols.index("paid_amt")] = "-5.00"
    with open(os.path.join(src, "late.csv"), "w", encoding="utf-8") as f:
        f.write(header + first + ",".join(bad) + "\n")
    q = start_row_checks(spark, "medical_claim_fact", src, out, fmt="csv", checkpoint=ckpt)
    q.awaitTermination(120)
    got = spark.read.parquet(out).collect()
    assert [(r["claim_id"], str(r["paid_amt"])) for r in got] == [(99001, "-5.00")]
