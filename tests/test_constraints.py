"""Declared-constraint reports on tiny tables with known violations."""

from __future__ import annotations

from decimal import Decimal

from builders import d, tables

from claimscope.plans import constraints


def _t(spark):
    return tables(
        spark,
        member_dim=[{"member_id": 1}, {"member_id": 1}, {"member_id": None}, {"member_id": 2}],
        eligibility_fact=[
            {"eligibility_id": 1, "member_id": 1, "cov_start_dt": d("2023-01-01"), "cov_end_dt": d("2023-12-31")},
            {"eligibility_id": 2, "member_id": 9, "cov_start_dt": None, "cov_end_dt": d("2023-12-31")},
            {"eligibility_id": 3, "member_id": None, "cov_start_dt": d("2023-01-01"), "cov_end_dt": None},
        ],
        medical_claim_line_dx_bridge=[
            {"claim_line_id": 1, "dx_seq": 1, "icd10": "E11.9"},
            {"claim_line_id": 1, "dx_seq": 1, "icd10": "I10"},
            {"claim_line_id": 1, "dx_seq": None, "icd10": "I10"},
        ],
    )


def test_primary_keys(spark):
    got = {r["table_name"]: r for r in constraints.primary_key_report(_t(spark)).collect()}
    m = got["member_dim"]
    assert (m["row_count"], m["null_key_rows"], m["duplicate_keys"], m["duplicate_key_rows"]) == (4, 1, 1, 2)
    b = got["medical_claim_line_dx_bridge"]
    assert (b["key_columns"], b["null_key_rows"], b["duplicate_keys"]) == ("claim_line_id,dx_seq", 1, 1)
    assert got["drug_dim"]["row_count"] == 0


def test_foreign_keys(spark):
    got = {(r["table_name"], r["column_name"]): r for r in constraints.foreign_key_report(_t(spark)).collect()}
    e = got[("eligibility_fact", "member_id")]
    assert (e["orphan_rows"], e["orphan_keys"]) == (1, 1)  # member 9; the NULL FK is allowed
    assert got[("medical_claim_line_dx_bridge", "icd10")]["orphan_rows"] == 3
    assert len(got) == 9


def test_not_null(spark):
    got = {(r["table_name"], r["column_name"]): r["null_rows"] for r in constraints.not_null_report(_t(spark)).collect()}
    assert got == {
        ("eligibility_fact", "cov_start_dt"): 1,
        ("eligibility_fact", "cov_end_dt"): 1,
        ("pharmacy_claim_fact", "fill_dt"): 0,
    }


def test_conformance_reads_raw_values(spark):
    raw = {
        "member_dim": spark.createDataFrame(
            [(1, "TX  ", "ABCD"), (2, "Texas", "12")], "member_id long, state string, zip3 string"
        ),
        "medical_claim_fact": spark.createDataFrame(
            [(1, Decimal("123456789012.00"), 5), (2, Decimal("10.005"), 6)], "claim_id long, paid_amt decimal(20,3), load_batch_id long"
        ),
    }
    got = {(r["table_name"], r["column_name"], r["rule"]): r["violations"] for r in constraints.conformance_report(raw).collect()}
    assert got[("member_dim", "state", "CHAR(2)")] == 1  # padding is trimmed, 'Texas' is too long
    assert got[("member_dim", "zip3", "CHAR(3)")] == 1
    assert got[("medical_claim_fact", "paid_amt", "NUMERIC(12,2)")] == 1  # 10.005 rounds, 1.2e11 overflows
    assert got[("medical_claim_fact", "load_batch_id", "INT")] == 0


def test_each_child_is_scanned_once_for_all_references(spark, smoke_tables):
    """Claims refer to members and to providers: one unpivoted pass over the claims, the same counts as one by one."""
    from claimscope.operators import orphan_counts
    from claimscope.plans.constraints import foreign_key_report
    from claimscope.schema import TABLES

    found = {(r["table_name"], r["column_name"]): (r["orphan_rows"], r["orphan_keys"]) for r in foreign_key_report(smoke_tables).collect()}
    for name, table in TABLES.items():
        for col, ref, key in table.foreign_keys:
            assert found[name, col] == tuple(orphan_counts(smoke_tables[name].select(col), col, smoke_tables[ref], key).first())
    assert len(found) == 9

    child = spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (None, "b"), (3, "b")], "x long, y string")
    from claimscope.operators import orphan_report

    parents = {"x": (spark.createDataFrame([(1,), (1,)], "k long"), "k"), "y": (spark.createDataFrame([("a",), ("b",)], "k string"), "k")}
    report = orphan_report(child, parents)
    assert sorted(tuple(r) for r in report.collect()) == [("x", 2, 2), ("y", 0, 0)]
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 1
