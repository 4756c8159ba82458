"""Label CASE chains (first match wins)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimscope import params as P


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def adherence_status(pdc: str | Column) -> Column:
    """ADHERENT when the *rounded* PDC reaches the threshold (0.7995 → 0.800 → ADHERENT)."""
    return F.when(_c(pdc) >= F.lit(Decimal(P.PDC_ADHERENT_THRESHOLD)), P.ADHERENT).otherwise(P.NON_ADHERENT)


def cost_bucket(pr: str | Column) -> Column:
    """Bucket of a descending percent_rank; ties share a rank and so a bucket."""
    p = _c(pr)
    expr = None
    for upper, label in P.COST_BUCKET_CUTOFFS:
        expr = F.when(p <= upper, label) if expr is None else expr.when(p <= upper, label)
    return expr.otherwise(P.BOTTOM_50)


def risk_flag(pdc: str | Column, bucket: str | Column) -> Column:
    """Clinical risk label from the (defaulted) PDC and cost bucket."""
    low_pdc = F.coalesce(_c(pdc), F.lit(Decimal("0"))) < F.lit(Decimal(P.PDC_ADHERENT_THRESHOLD))
    high_cost = F.coalesce(_c(bucket), F.lit("")).isin(*P.HIGH_COST_BUCKETS)
    return (
        F.when(low_pdc & high_cost, P.RISK_HIGH)
        .when(low_pdc, P.RISK_MODERATE)
        .when(high_cost, P.RISK_HIGH_COST)
        .otherwise(P.RISK_STABLE)
    )
