"""Independent SQL for every registered job, for DuckDB.

Each string starts with the claims views of :mod:`claimscope.sources.testdata`
as CTEs and states the job from its definition, in other terms than the Spark
plans compute it: condition events as one tagged list behind key subsets,
covered days as a running depth of openings and closings, eligible days by
counting calendar days, ranks by counting greater totals, the dashboard from
its own detail reports, the member summary from one row of facts per member.

Labels, cutoffs and defaults come from :mod:`claimscope.params`.  Types
compared: money and ratios DOUBLE, counts and years BIGINT, dates DATE.
Half-up rounding is done on integers (DuckDB's decimal / integer is DOUBLE).
"""

from __future__ import annotations

from pyspark.sql import types as T

from claimscope import params as P
from claimscope.schema import TABLE_NAMES, TABLES
from claimscope.sources.testdata import VIEW_COLUMNS, WINDOW, oracle_ctes

FROM_DAY, TO_DAY = f"DATE '{WINDOW.start}'", f"DATE '{WINDOW.end}'"
YEAR = f"{WINDOW.measurement_year}::BIGINT AS measurement_year"

ORACLE: dict[str, str] = {}


def _sql(body: str, *parts: dict[str, str]) -> str:
    return oracle_ctes({name: text for part in parts for name, text in part.items()}) + body


def _window(day: str) -> str:
    return f"{day} >= {FROM_DAY} AND {day} <= {TO_DAY}"


def _first_match(cases: list[tuple[str, str]], otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN {test} THEN '{label}'" for test, label in cases) + f" ELSE '{otherwise}' END"


# ---- condition events and cohorts ---------------------------------------------

# Every sign of the condition as (member, day, kind); ids are narrowed one table at a time.
EVENTS = {
    "event": f"""
    SELECT member_id, service_from_dt AS happened, '{P.COHORT_REASON_DX}' AS kind
    FROM medical_claim_fact
    WHERE claim_id IN (
        SELECT claim_id FROM medical_claim_line_fact WHERE claim_line_id IN (
            SELECT claim_line_id FROM medical_claim_line_dx_bridge WHERE icd10 IN (
                SELECT icd10 FROM diagnosis_dim WHERE is_diabetes_flag)))
    UNION ALL
    SELECT member_id, fill_dt, '{P.COHORT_REASON_RX}'
    FROM pharmacy_claim_fact
    WHERE ndc IN (SELECT ndc FROM drug_dim WHERE is_antidiabetic_flag)""",
    "known_event": f"SELECT e.* FROM event e SEMI JOIN member_dim USING (member_id) WHERE {_window('happened')}",
}

# One aggregate over all events of a member; a diagnosis outranks a fill, whenever it was.
COHORT = {
    **EVENTS,
    "first_event": f"""
    SELECT member_id,
        MIN(happened) FILTER (kind = '{P.COHORT_REASON_DX}') AS first_dx,
        MIN(happened) FILTER (kind = '{P.COHORT_REASON_RX}') AS first_rx
    FROM known_event GROUP BY member_id""",
    "cohort": f"""
    SELECT member_id, COALESCE(first_dx, first_rx) AS index_dt,
        IF(first_dx IS NULL, '{P.COHORT_REASON_RX}', '{P.COHORT_REASON_DX}') AS cohort_reason
    FROM first_event""",
}

AGE_NAME = f"age_{WINDOW.age_asof.year}"
_AGE_DAY = 100 * WINDOW.age_asof.month + WINDOW.age_asof.day
# calendar years apart, less one where the birthday is still to come
AGE = f"""({WINDOW.age_asof.year} - YEAR(dob) - (100 * MONTH(dob) + DAY(dob) > {_AGE_DAY})::INT)::BIGINT"""


def _detail(first: str, name: str, reason: str) -> str:
    return _sql(
        f"""SELECT member_id, sex, state, {AGE} AS {AGE_NAME}, {first} AS {name}, '{reason}' AS cohort_reason
    FROM first_event JOIN member_dim USING (member_id) WHERE {first} IS NOT NULL""",
        COHORT,
    )


ORACLE["cohort_dx"] = ORACLE["window_first_event"] = _detail("first_dx", "first_dm_claim_dt", P.COHORT_REASON_DX)
ORACLE["cohort_rx"] = _detail("first_rx", "first_rx_fill_dt", P.COHORT_REASON_RX)
ORACLE["cohort_combined"] = _sql(f"SELECT *, {YEAR} FROM cohort", COHORT)

# any day; a diagnosis counts for members of the dimension only
CONDITION = {
    **EVENTS,
    "with_condition": f"""
    SELECT member_id FROM event
    WHERE kind = '{P.COHORT_REASON_RX}' OR member_id IN (SELECT member_id FROM member_dim)
    GROUP BY member_id""",
}
ORACLE["condition_members"] = _sql("FROM with_condition", CONDITION)

# ---- adherence ----------------------------------------------------------------

FILLS = {
    # a fill without days lasts to the window's end, as does one that would go beyond
    "fill": f"""
    SELECT member_id, therapeutic_class, fill_dt AS fill_start,
        COALESCE(CASE WHEN date_diff('day', fill_dt, {TO_DAY}) >= days_supply - 1 THEN fill_dt + (days_supply - 1) END, {TO_DAY}) AS fill_end
    FROM drug_dim JOIN pharmacy_claim_fact USING (ndc)
    WHERE is_antidiabetic_flag AND {_window("fill_dt")}"""
}


def _coverage(keys: str) -> dict[str, str]:
    """Days on which at least one fill is open: +1 where one begins, -1 after its last day, summed in order."""
    return {
        **FILLS,
        "turn": f"""
    SELECT {keys}, turn_day, SUM(step) AS step
    FROM (SELECT {keys}, UNNEST([fill_start, fill_end + 1]) AS turn_day, UNNEST([1, -1]) AS step FROM fill WHERE fill_end >= fill_start)
    GROUP BY {keys}, turn_day""",
        "depth": f"""
    SELECT {keys}, turn_day, SUM(step) OVER along AS open_fills, LEAD(turn_day) OVER along AS next_day
    FROM turn WINDOW along AS (PARTITION BY {keys} ORDER BY turn_day)""",
        "covered": f"""
    SELECT {keys}, SUM(date_diff('day', turn_day, next_day))::BIGINT AS covered_days
    FROM depth WHERE open_fills > 0 GROUP BY {keys}""",
    }


# a day that two spans cover counts twice
ELIGIBLE = {
    "calendar": f"SELECT UNNEST(range({FROM_DAY}, {TO_DAY} + 1, INTERVAL 1 DAY))::DATE AS day",
    "eligible": """
    SELECT member_id, COUNT(*) AS eligible_days
    FROM eligibility_fact JOIN calendar ON day >= cov_start_dt AND day <= cov_end_dt
    GROUP BY member_id""",
}


def _pdc(keys: str) -> dict[str, str]:
    # thousandths of the ratio, halves up, as an integer
    limit = int(float(P.PDC_ADHERENT_THRESHOLD) * 10**P.PDC_DIGITS)
    return {
        **_coverage(keys),
        **ELIGIBLE,
        "thousandths": f"""
    SELECT {keys}, covered_days, eligible_days,
        (2 * {10**P.PDC_DIGITS} * covered_days + eligible_days) // (2 * eligible_days) AS k
    FROM covered JOIN eligible USING (member_id)""",
        "pdc": f"""
    SELECT {keys}, {YEAR}, covered_days, eligible_days, k::DOUBLE / {10**P.PDC_DIGITS} AS pdc,
        IF(k < {limit}, '{P.NON_ADHERENT}', '{P.ADHERENT}') AS adherence_status
    FROM thousandths""",
    }


BY_CLASS = "member_id, therapeutic_class"
ORACLE["pdc_fills"] = _sql("FROM fill", FILLS)
ORACLE["covered_days"] = ORACLE["covered_days_exploded"] = _sql("FROM covered", _coverage(BY_CLASS))
ORACLE["eligible_days"] = _sql("FROM eligible", ELIGIBLE)
ORACLE["pdc_by_class"] = _sql("FROM pdc", _pdc(BY_CLASS))
ORACLE["pdc_member"] = _sql("FROM pdc", _pdc("member_id"))

# ---- utilization and cost -----------------------------------------------------

_VISITS = {"er_visits": P.CLAIM_TYPE_ER, "ip_admits": P.CLAIM_TYPE_IP, "office_visits": P.CLAIM_TYPE_PROF}
USAGE = {
    "usage": f"""
    SELECT member_id, {", ".join(f"SUM((claim_type IS NOT DISTINCT FROM '{kind}')::INT)::BIGINT AS {name}" for name, kind in _VISITS.items())},
        SUM(paid_amt) AS paid, COUNT(paid_amt) AS paid_claims
    FROM medical_claim_fact WHERE {_window("service_from_dt")} GROUP BY member_id"""
}
USAGE_COLUMNS = f"member_id, {YEAR}, {', '.join(_VISITS)}, paid::DOUBLE AS total_paid_amt"

ORACLE["member_utilization"] = _sql(f"SELECT {USAGE_COLUMNS} FROM usage", USAGE)
# the average from whole cents, halves up (no negative amounts here)
ORACLE["utilization_summary"] = _sql(
    f"""SELECT {USAGE_COLUMNS},
        IF(paid_claims = 0, NULL, ((200 * paid)::BIGINT + paid_claims) // (2 * paid_claims) / 100.0::DOUBLE) AS avg_paid_per_claim
    FROM usage SEMI JOIN with_condition USING (member_id)""",
    USAGE,
    CONDITION,
)


def _tiers(population: str) -> dict[str, str]:
    """Each member's share of the others with a greater total (no total is greatest), and its tier."""
    cutoffs = [(f"share <= {at}", label) for at, label in P.COST_BUCKET_CUTOFFS]
    return {
        "payer": f"SELECT member_id, paid, paid IS NULL AS unknown FROM {population}",
        "step": "SELECT unknown, paid, COUNT(*) AS payers FROM payer GROUP BY unknown, paid",
        "above": """
    SELECT unknown, paid, SUM(payers) OVER (ORDER BY unknown DESC, paid DESC) - payers AS greater, SUM(payers) OVER () AS everyone
    FROM step""",
        "tier": f"""
    SELECT member_id, p.paid, greater::DOUBLE / GREATEST(everyone - 1, 1)::DOUBLE AS share, {_first_match(cutoffs, P.BOTTOM_50)} AS cost_bucket
    FROM payer p JOIN above a ON a.paid IS NOT DISTINCT FROM p.paid""",
    }


_COSTS = f"SELECT member_id, {YEAR}, paid::DOUBLE AS total_paid_amt, ROUND((share * 100)::DECIMAL(18,10), 1)::DOUBLE AS percentile, cost_bucket FROM tier"
ORACLE["cost_buckets"] = _sql(_COSTS, USAGE, CONDITION, _tiers("usage SEMI JOIN with_condition USING (member_id)"))
ORACLE["cost_buckets_all"] = _sql(_COSTS, USAGE, _tiers("usage"))

# ---- data quality -------------------------------------------------------------

# gap: days from the end of a span to the start of one with a greater id (negative or 0: they overlap or touch)
QUALITY = {
    "insured_claim": """
    SELECT DISTINCT claim_id FROM medical_claim_fact JOIN eligibility_fact USING (member_id)
    WHERE service_from_dt - cov_start_dt >= 0 AND cov_end_dt - service_from_dt >= 0""",
    "uninsured": "SELECT * FROM medical_claim_fact ANTI JOIN insured_claim USING (claim_id)",
    "span_pair": """
    SELECT one.member_id, one.cov_start_dt AS span1_start, one.cov_end_dt AS span1_end,
        two.cov_start_dt AS span2_start, two.cov_end_dt AS span2_end, two.cov_start_dt - one.cov_end_dt AS gap
    FROM eligibility_fact one, eligibility_fact two
    WHERE two.member_id = one.member_id AND two.eligibility_id > one.eligibility_id""",
    "bare_line": "SELECT * FROM medical_claim_line_fact ANTI JOIN medical_claim_line_dx_bridge USING (claim_line_id)",
    "unsupplied": "SELECT * FROM pharmacy_claim_fact WHERE COALESCE(days_supply, 0) < 1",
    "unpaid": "SELECT * FROM medical_claim_fact WHERE SIGN(paid_amt) < 1",
}


def _check(label: str, columns: str, source: str) -> str:
    return _sql(f"SELECT '{label}' AS check_name, {columns} FROM {source}", QUALITY)


_SPANS = "member_id, span1_start, span1_end, span2_start, span2_end"
ORACLE["dq_missing_eligibility"] = _check(P.CHECK_MISSING_ELIGIBILITY, "member_id, service_from_dt, claim_type", "uninsured")
ORACLE["dq_service_outside_eligibility"] = _check(
    P.CHECK_SERVICE_OUTSIDE,
    "member_id, service_from_dt, cov_start_dt, cov_end_dt, paid_amt::DOUBLE AS paid_amt",
    "medical_claim_fact JOIN eligibility_fact USING (member_id) WHERE GREATEST(cov_start_dt - service_from_dt, service_from_dt - cov_end_dt) > 0",
)
ORACLE["dq_nonpositive_paid"] = _check(P.CHECK_NONPOSITIVE_PAID, "claim_id, member_id, service_from_dt, paid_amt::DOUBLE AS paid_amt, claim_type", "unpaid")
ORACLE["dq_duplicate_claims"] = _check(
    P.CHECK_DUPLICATE_CLAIM, "*", "(SELECT claim_id, COUNT(*) AS occurrences FROM medical_claim_raw GROUP BY claim_id) WHERE occurrences >= 2"
)
ORACLE["dq_invalid_days_supply"] = _check(P.CHECK_INVALID_DAYS_SUPPLY, "rx_claim_id, member_id, fill_dt, days_supply::BIGINT AS days_supply, ndc", "unsupplied")
ORACLE["dq_overlapping_eligibility"] = _check(P.CHECK_OVERLAPPING_ELIGIBILITY, _SPANS, "span_pair WHERE gap <= 0")
ORACLE["dq_overlapping_eligibility_strict"] = _check(
    P.CHECK_OVERLAPPING_ELIGIBILITY, _SPANS, "span_pair WHERE GREATEST(span1_start, span2_start) <= LEAST(span1_end, span2_end)"
)
ORACLE["dq_lines_missing_dx"] = _check(
    P.CHECK_LINE_MISSING_DX, "claim_line_id, claim_id, member_id, service_from_dt, cpt_hcpcs", "bare_line JOIN medical_claim_fact USING (claim_id)"
)

_FAILED = {
    P.DASH_MISSING_ELIGIBILITY: "uninsured",
    P.DASH_NEGATIVE_PAID: "unpaid",
    P.DASH_DUPLICATE_CLAIMS: "(SELECT claim_id, COUNT(*) AS n FROM medical_claim_fact GROUP BY claim_id) WHERE n >= 2",
    P.DASH_INVALID_DAYS_SUPPLY: "unsupplied",
    P.DASH_OVERLAPPING_ELIGIBILITY: "span_pair WHERE gap <= 0",
    P.DASH_LINES_MISSING_DX: "bare_line",
}
ORACLE["dq_dashboard"] = _sql(
    f"""SELECT check_name, failed_count::BIGINT AS failed_count, IF(failed_count > 0, '{P.FAIL}', '{P.PASS}') AS status
    FROM (VALUES {", ".join(f"('{label}', (SELECT COUNT(*) FROM {source}))" for label, source in _FAILED.items())}) AS d(check_name, failed_count)""",
    QUALITY,
)

# ---- member summary -----------------------------------------------------------

_COSTLY = ", ".join(f"'{b}'" for b in P.HIGH_COST_BUCKETS)
MASTER = {
    **COHORT,
    **_pdc("member_id"),
    **USAGE,
    **_tiers("usage"),
    # all that is known of a member in one row, from whichever sources know it
    "fact": """
    SELECT member_id, MAX(covered_days) AS covered_days, MAX(eligible_days) AS eligible_days, MAX(pdc) AS pdc, MAX(adherence_status) AS adherence_status,
        MAX(er_visits) AS er_visits, MAX(ip_admits) AS ip_admits, MAX(office_visits) AS office_visits, MAX(paid) AS paid, MAX(cost_bucket) AS cost_bucket
    FROM (FROM pdc UNION ALL BY NAME FROM usage UNION ALL BY NAME SELECT member_id, cost_bucket FROM tier)
    GROUP BY member_id""",
    "risk": f"""
    FROM (VALUES (TRUE, TRUE, '{P.RISK_HIGH}'), (TRUE, FALSE, '{P.RISK_MODERATE}'), (FALSE, TRUE, '{P.RISK_HIGH_COST}'), (FALSE, FALSE, '{P.RISK_STABLE}'))
    AS r(short, costly, clinical_risk_flag)""",
    "card": f"""
    SELECT c.*, COALESCE(covered_days, 0) AS covered_days, COALESCE(eligible_days, {P.DEFAULT_ELIGIBLE_DAYS}) AS eligible_days,
        COALESCE(pdc, 0) AS pdc, COALESCE(adherence_status, '{P.NO_RX_DATA}') AS adherence_status,
        {", ".join(f"COALESCE({name}, 0) AS {name}" for name in _VISITS)},
        COALESCE(paid, 0)::DOUBLE AS total_paid_amt, COALESCE(cost_bucket, '{P.NO_CLAIMS}') AS cost_bucket,
        COALESCE(pdc, 0) < {P.PDC_ADHERENT_THRESHOLD} AS short, COALESCE(cost_bucket IN ({_COSTLY}), FALSE) AS costly
    FROM cohort c LEFT JOIN fact USING (member_id)""",
    # a row for every eligibility span of the member
    "master": f"""
    SELECT card.* EXCLUDE (short, costly), sex, state, {AGE} AS {AGE_NAME}, product_line, {YEAR}, clinical_risk_flag
    FROM eligibility_fact JOIN card USING (member_id) JOIN member_dim USING (member_id) JOIN risk USING (short, costly)""",
}
ORACLE["master_summary"] = _sql("FROM master", MASTER)
ORACLE["risk_segments"] = _sql(
    "SELECT clinical_risk_flag, COUNT(DISTINCT member_id) AS members, COUNT(*) AS summary_rows FROM master GROUP BY clinical_risk_flag", MASTER
)

# ---- reports in order, delivery, layout by year -------------------------------


def _ordered(key: str, order: str) -> str:
    return f"SELECT *, ROW_NUMBER() OVER (ORDER BY {order}) AS row_number FROM ({ORACLE[key]})"


ORACLE["ordered_cohort_dx"] = _ordered("cohort_dx", "member_id")
ORACLE["ordered_pdc"] = _ordered("pdc_by_class", "member_id, therapeutic_class")
ORACLE["ordered_utilization"] = _ordered("utilization_summary", "total_paid_amt DESC NULLS FIRST, member_id")
ORACLE["ordered_master"] = _ordered("master_summary", "total_paid_amt DESC NULLS FIRST, pdc NULLS LAST, member_id, product_line")
ORACLE["delivered_pdc"] = ORACLE["pdc_by_class"]
ORACLE["yearly_pdc"] = ORACLE["pdc_member"]
ORACLE["yearly_utilization"] = ORACLE["member_utilization"]

# ---- declared constraints and ingest -------------------------------------------------


def _primary_key_sql() -> str:
    parts = []
    for name in TABLE_NAMES:
        key = TABLES[name].key
        cols = ", ".join(key)
        null = " OR ".join(f"{k} IS NULL" for k in key)
        not_null = " AND ".join(f"{k} IS NOT NULL" for k in key)
        dups = f"SELECT COUNT(*) AS n FROM {name} WHERE {not_null} GROUP BY {cols} HAVING COUNT(*) > 1"
        parts.append(
            f"""SELECT '{name}' AS table_name, '{",".join(key)}' AS key_columns,
            CAST(COUNT(*) AS BIGINT) AS row_count,
            CAST(COUNT(*) FILTER (WHERE {null}) AS BIGINT) AS null_key_rows,
            (SELECT CAST(COUNT(*) AS BIGINT) FROM ({dups})) AS duplicate_keys,
            (SELECT CAST(COALESCE(SUM(n), 0) AS BIGINT) FROM ({dups})) AS duplicate_key_rows
        FROM {name}"""
        )
    return _sql("\n    UNION ALL\n    ".join(parts))


def _foreign_key_sql() -> str:
    parts = []
    for name in TABLE_NAMES:
        for col, ref_table, ref_col in TABLES[name].foreign_keys:
            parts.append(
                f"""SELECT '{name}' AS table_name, '{col}' AS column_name, '{ref_table}' AS ref_table,
            '{ref_col}' AS ref_column,
            CAST(COUNT(*) AS BIGINT) AS orphan_rows, CAST(COUNT(DISTINCT c.{col}) AS BIGINT) AS orphan_keys
        FROM {name} c
        WHERE c.{col} IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM {ref_table} p WHERE p.{ref_col} = c.{col})"""
            )
    return _sql("\n    UNION ALL\n    ".join(parts))


def _not_null_sql() -> str:
    parts = []
    for name in TABLE_NAMES:
        for c in TABLES[name].cols:
            if c.not_null:
                parts.append(
                    f"""SELECT '{name}' AS table_name, '{c.name}' AS column_name,
            CAST(COUNT(*) FILTER (WHERE {c.name} IS NULL) AS BIGINT) AS null_rows FROM {name}"""
                )
    return _sql("\n    UNION ALL\n    ".join(parts))


def _conformance_sql() -> str:
    parts = []
    for name in TABLE_NAMES:
        present = VIEW_COLUMNS[name]
        for c in TABLES[name].cols:
            if c.name not in present:
                continue
            if c.max_length:
                text = f"RTRIM(CAST({c.name} AS VARCHAR))" if c.char else f"CAST({c.name} AS VARCHAR)"
                rule = f"{'CHAR' if c.char else 'VARCHAR'}({c.max_length})"
                bad = f"LENGTH({text}) > {c.max_length}"
            elif isinstance(c.dtype, T.DecimalType):
                rule = f"NUMERIC({c.dtype.precision},{c.dtype.scale})"
                bad = f"{c.name} IS NOT NULL AND TRY_CAST({c.name} AS DECIMAL({c.dtype.precision},{c.dtype.scale})) IS NULL"
            elif isinstance(c.dtype, T.IntegerType):
                rule = "INT"
                bad = f"{c.name} IS NOT NULL AND TRY_CAST({c.name} AS INTEGER) IS NULL"
            else:
                continue
            parts.append(
                f"""SELECT '{name}' AS table_name, '{c.name}' AS column_name, '{rule}' AS rule,
            CAST(COUNT(*) FILTER (WHERE {bad}) AS BIGINT) AS violations FROM {name}"""
            )
    return _sql("\n    UNION ALL\n    ".join(parts))


ORACLE["dq_primary_key"] = _primary_key_sql()
ORACLE["dq_foreign_key"] = _foreign_key_sql()
ORACLE["dq_not_null"] = _not_null_sql()
ORACLE["dq_conformance"] = _conformance_sql()

ORACLE["ingest_defaults"] = _sql(
    """SELECT 'diagnosis_dim' AS table_name, icd10 AS code, 'is_diabetes_flag' AS flag_name, is_diabetes_flag AS flag_value
        FROM diagnosis_dim
    UNION ALL SELECT 'diagnosis_dim', icd10, 'is_htn_flag', FALSE FROM diagnosis_dim
    UNION ALL SELECT 'diagnosis_dim', icd10, 'is_hf_flag', FALSE FROM diagnosis_dim
    UNION ALL SELECT 'drug_dim', ndc, 'is_antidiabetic_flag', FALSE FROM drug_dim"""
)

ORACLE["load_tables"] = _sql(
    "\n    UNION ALL\n    ".join(f"SELECT '{n}' AS table_name, CAST(COUNT(*) AS BIGINT) AS row_count FROM {n}" for n in TABLE_NAMES)
)
