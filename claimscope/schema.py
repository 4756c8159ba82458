"""Declared schema of the ten claims tables.

Each column carries its Spark type plus the declared SQL shape (CHAR/VARCHAR
length, NUMERIC precision) so the conformance report can check it.  Keys,
foreign keys and NOT NULL columns are declared here; Spark enforces none of
them, so :mod:`claimscope.plans.constraints` reports violations instead.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Col:
    name: str
    dtype: T.DataType
    char: int | None = None  # CHAR(n): blank padded, trimmed on ingest
    varchar: int | None = None  # VARCHAR(n)
    not_null: bool = False
    default: object = None  # value used when the column is absent on ingest
    default_now: bool = False  # TIMESTAMP DEFAULT NOW()

    @property
    def max_length(self) -> int | None:
        return self.char or self.varchar


@dataclass(frozen=True)
class Table:
    name: str
    cols: tuple[Col, ...]
    key: tuple[str, ...]
    foreign_keys: tuple[tuple[str, str, str], ...] = field(default=())  # (col, ref_table, ref_col)

    @property
    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.dtype, True) for c in self.cols])

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.cols]

    def col(self, name: str) -> Col:
        for c in self.cols:
            if c.name == name:
                return c
        raise KeyError(f"{self.name}.{name}")


BIGINT, INT, DATE = T.LongType(), T.IntegerType(), T.DateType()
TS, BOOL, STR = T.TimestampNTZType(), T.BooleanType(), T.StringType()
MONEY = T.DecimalType(12, 2)


def _char(name, n, **kw):
    return Col(name, STR, char=n, **kw)


def _vchar(name, n, **kw):
    return Col(name, STR, varchar=n, **kw)


MEMBER_DIM = Table(
    "member_dim",
    (
        Col("member_id", BIGINT),
        Col("dob", DATE),
        _char("sex", 1),
        _char("zip3", 3),
        _char("state", 2),
        Col("death_dt", DATE),
        _vchar("source_system", 50),
    ),
    key=("member_id",),
)

ELIGIBILITY_FACT = Table(
    "eligibility_fact",
    (
        Col("eligibility_id", BIGINT),
        Col("member_id", BIGINT),
        Col("cov_start_dt", DATE, not_null=True),
        Col("cov_end_dt", DATE, not_null=True),
        _vchar("product_line", 30),
        _vchar("plan_type", 10),
        Col("load_batch_id", INT),
        Col("load_dt", TS, default_now=True),
    ),
    key=("eligibility_id",),
    foreign_keys=(("member_id", "member_dim", "member_id"),),
)

PROVIDER_DIM = Table(
    "provider_dim",
    (
        Col("provider_id", BIGINT),
        _char("npi", 10),
        _vchar("provider_name", 100),
        _vchar("specialty", 100),
        _char("state", 2),
    ),
    key=("provider_id",),
)

DIAGNOSIS_DIM = Table(
    "diagnosis_dim",
    (
        _vchar("icd10", 10),
        _vchar("dx_desc", 200),
        Col("is_diabetes_flag", BOOL, default=False),
        Col("is_htn_flag", BOOL, default=False),
        Col("is_hf_flag", BOOL, default=False),
    ),
    key=("icd10",),
)

PROCEDURE_DIM = Table(
    "procedure_dim",
    (
        _vchar("cpt_hcpcs", 10),
        _vchar("proc_desc", 200),
        _vchar("proc_category", 50),
    ),
    key=("cpt_hcpcs",),
)

DRUG_DIM = Table(
    "drug_dim",
    (
        _char("ndc", 11),
        _vchar("generic_name", 100),
        _vchar("brand_name", 100),
        _vchar("gpi", 20),
        _vchar("therapeutic_class", 50),
        Col("is_antidiabetic_flag", BOOL, default=False),
    ),
    key=("ndc",),
)

MEDICAL_CLAIM_FACT = Table(
    "medical_claim_fact",
    (
        Col("claim_id", BIGINT),
        Col("member_id", BIGINT),
        Col("provider_id", BIGINT),
        _vchar("claim_type", 10),
        Col("admit_dt", DATE),
        Col("discharge_dt", DATE),
        Col("service_from_dt", DATE),
        Col("service_to_dt", DATE),
        Col("paid_amt", MONEY),
        Col("allowed_amt", MONEY),
        Col("billed_amt", MONEY),
        _char("place_of_service", 2),
        _vchar("source_system", 50),
        Col("load_batch_id", INT),
        Col("load_dt", TS, default_now=True),
    ),
    key=("claim_id",),
    foreign_keys=(
        ("member_id", "member_dim", "member_id"),
        ("provider_id", "provider_dim", "provider_id"),
    ),
)

MEDICAL_CLAIM_LINE_FACT = Table(
    "medical_claim_line_fact",
    (
        Col("claim_line_id", BIGINT),
        Col("claim_id", BIGINT),
        Col("line_num", INT),
        _vchar("cpt_hcpcs", 10),
        _vchar("rev_code", 10),
        Col("units", T.DecimalType(8, 2)),
        Col("paid_amt", MONEY),
        Col("allowed_amt", MONEY),
    ),
    key=("claim_line_id",),
    foreign_keys=(
        ("claim_id", "medical_claim_fact", "claim_id"),
        ("cpt_hcpcs", "procedure_dim", "cpt_hcpcs"),
    ),
)

MEDICAL_CLAIM_LINE_DX_BRIDGE = Table(
    "medical_claim_line_dx_bridge",
    (
        Col("claim_line_id", BIGINT),
        Col("dx_seq", INT),
        _vchar("icd10", 10),
    ),
    key=("claim_line_id", "dx_seq"),
    foreign_keys=(
        ("claim_line_id", "medical_claim_line_fact", "claim_line_id"),
        ("icd10", "diagnosis_dim", "icd10"),
    ),
)

PHARMACY_CLAIM_FACT = Table(
    "pharmacy_claim_fact",
    (
        Col("rx_claim_id", BIGINT),
        Col("member_id", BIGINT),
        _char("ndc", 11),
        Col("fill_dt", DATE, not_null=True),
        Col("days_supply", INT),
        Col("quantity", T.DecimalType(10, 3)),
        Col("paid_amt", MONEY),
        Col("allowed_amt", MONEY),
        Col("pharmacy_id", BIGINT),
        _vchar("source_system", 50),
        Col("load_batch_id", INT),
        Col("load_dt", TS, default_now=True),
    ),
    key=("rx_claim_id",),
    foreign_keys=(
        ("member_id", "member_dim", "member_id"),
        ("ndc", "drug_dim", "ndc"),
    ),
)

# Names, types, keys and defaults of the study's tables.
TABLES: dict[str, Table] = {
    t.name: t
    for t in (
        MEMBER_DIM,
        ELIGIBILITY_FACT,
        PROVIDER_DIM,
        DIAGNOSIS_DIM,
        PROCEDURE_DIM,
        DRUG_DIM,
        MEDICAL_CLAIM_FACT,
        MEDICAL_CLAIM_LINE_FACT,
        MEDICAL_CLAIM_LINE_DX_BRIDGE,
        PHARMACY_CLAIM_FACT,
    )
}
TABLE_NAMES = tuple(TABLES)
