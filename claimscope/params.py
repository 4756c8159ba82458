"""Parameters of the claims jobs: measurement window, condition flags, cutoffs, labels.

Every job takes a :class:`Window` (inclusive start/end dates) and, where it
matters, a :class:`Condition` naming the boolean flag columns on the diagnosis
and drug dimensions.  Defaults reproduce the original diabetes / 2023 study.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

# ---------------------------------------------------------------------------
# These must equal the original study's values for identical
# results (labels, thresholds, claim types, default denominators).
# ---------------------------------------------------------------------------
COHORT_REASON_DX = "DX"
COHORT_REASON_RX = "RX"

PDC_DIGITS = 3
PDC_ADHERENT_THRESHOLD = "0.80"
ADHERENT = "ADHERENT"
NON_ADHERENT = "NON-ADHERENT"
NO_RX_DATA = "NO RX DATA"

CLAIM_TYPE_ER = "ER"
CLAIM_TYPE_IP = "IP"
CLAIM_TYPE_PROF = "PROF"

# (upper bound on percent_rank, label); first match wins, else BOTTOM_50
COST_BUCKET_CUTOFFS = ((0.05, "Top 5%"), (0.20, "5-20%"), (0.50, "20-50%"))
BOTTOM_50 = "Bottom 50%"
NO_CLAIMS = "No Claims"
HIGH_COST_BUCKETS = ("Top 5%", "5-20%")

DEFAULT_ELIGIBLE_DAYS = 365

RISK_HIGH = "HIGH RISK — Intervene Now"
RISK_MODERATE = "MODERATE RISK — Adherence Gap"
RISK_HIGH_COST = "HIGH COST — Review Utilization"
RISK_STABLE = "STABLE"

# Check names of the detail reports and of the dashboard (they differ on purpose).
CHECK_MISSING_ELIGIBILITY = "Missing Eligibility"
CHECK_SERVICE_OUTSIDE = "Service Outside Eligibility"
CHECK_NONPOSITIVE_PAID = "Negative or Zero Paid Amount"
CHECK_DUPLICATE_CLAIM = "Duplicate Claim ID"
CHECK_INVALID_DAYS_SUPPLY = "Invalid Days Supply"
CHECK_OVERLAPPING_ELIGIBILITY = "Overlapping Eligibility"
CHECK_LINE_MISSING_DX = "Claim Line Missing Diagnosis"

DASH_MISSING_ELIGIBILITY = "Missing Eligibility"
DASH_NEGATIVE_PAID = "Negative Paid Amount"
DASH_DUPLICATE_CLAIMS = "Duplicate Claim IDs"
DASH_INVALID_DAYS_SUPPLY = "Invalid Days Supply"
DASH_OVERLAPPING_ELIGIBILITY = "Overlapping Eligibility"
DASH_LINES_MISSING_DX = "Claim Lines Missing Dx"
PASS = "PASS"
FAIL = "FAIL"


def _as_date(value) -> _dt.date:
    if isinstance(value, _dt.date):
        return value
    return _dt.date.fromisoformat(str(value))


@dataclass(frozen=True)
class Window:
    """Inclusive measurement window; ages are taken as of ``asof`` (default: end)."""

    start: _dt.date
    end: _dt.date
    asof: _dt.date | None = None

    def __post_init__(self):
        object.__setattr__(self, "start", _as_date(self.start))
        object.__setattr__(self, "end", _as_date(self.end))
        if self.asof is not None:
            object.__setattr__(self, "asof", _as_date(self.asof))
        if self.end < self.start:
            raise ValueError(f"window end {self.end} before start {self.start}")

    @classmethod
    def year(cls, year: int) -> "Window":
        return cls(_dt.date(year, 1, 1), _dt.date(year, 12, 31))

    @property
    def age_asof(self) -> _dt.date:
        return self.asof or self.end

    @property
    def measurement_year(self) -> int:
        return self.end.year

    @property
    def days(self) -> int:
        return (self.end - self.start).days + 1


@dataclass(frozen=True)
class Condition:
    """Flag columns that select the condition on diagnosis_dim and drug_dim."""

    dx_flag: str = "is_diabetes_flag"
    rx_flag: str = "is_antidiabetic_flag"


DEFAULT_WINDOW = Window.year(2023)
DIABETES = Condition()
