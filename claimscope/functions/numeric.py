"""Exact decimal arithmetic with half-away-from-zero rounding.

Spark's ``round`` on DECIMAL is HALF_UP (away from zero), the same as SQL
NUMERIC rounding; ``bround`` (banker's) is never used.  Ratios are computed on
decimals, never on doubles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WHOLE = "decimal(20,0)"


def ratio_rounded(num: str | Column, den: str | Column, digits: int) -> Column:
    """round(num / den, digits) on exact decimals (den = 0 fails under ANSI, like SQL)."""
    n = F.col(num) if isinstance(num, str) else num
    d = F.col(den) if isinstance(den, str) else den
    return F.round(n.cast(_WHOLE) / d.cast(_WHOLE), digits)


def avg_rounded(total: str | Column, n: str | Column, digits: int = 2) -> Column:
    """AVG(x) rounded from SUM(x) and COUNT(x): one rounding, not Spark avg's scale-6 pre-rounding."""
    t = F.col(total) if isinstance(total, str) else total
    c = F.col(n) if isinstance(n, str) else n
    return F.round(t / c.cast(_WHOLE), digits)


def percentile_1dp(pr: str | Column) -> Column:
    """percent_rank × 100 as a 1-decimal NUMERIC: cast the double to decimal, then round."""
    p = F.col(pr) if isinstance(pr, str) else pr
    return F.round((p * F.lit(100.0)).cast("decimal(18,10)"), 1)
