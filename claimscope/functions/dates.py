"""Date expressions.  Everything stays on DATE (no timestamps, no session zone)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimscope.params import Window


def date_lit(d: _dt.date) -> Column:
    return F.lit(d).cast("date")


def in_window(col: str | Column, w: Window) -> Column:
    """Inclusive BETWEEN on a bare column so Parquet row-group filters apply."""
    c = F.col(col) if isinstance(col, str) else col
    return c.between(date_lit(w.start), date_lit(w.end))


def age_years(dob: str | Column, asof: _dt.date) -> Column:
    """Completed years between ``dob`` and ``asof`` (a 29 Feb birthday completes on 1 Mar).

    Calendar parts only: a timestamp difference would depend on the session
    zone (a birth date whose midnight a zone skips loses a year), and
    ``months_between/12`` would round leap-day birthdays up.  A birth date
    after ``asof`` counts back the same way, toward zero.
    """
    d = F.col(dob) if isinstance(dob, str) else dob
    day = F.month(d) * 100 + F.dayofmonth(d)
    asof_day = asof.month * 100 + asof.day
    years = F.lit(asof.year) - F.year(d)
    completed = years - F.when(day > asof_day, 1).otherwise(0)
    to_come = years + F.when(day < asof_day, 1).otherwise(0)
    return F.when(d <= date_lit(asof), completed).otherwise(to_come).cast("bigint")


def clipped_end(fill_dt: str, days_supply: str, w: Window) -> Column:
    """Last covered day of a fill, cut at the window end.

    ``least`` skips NULL, so a fill with NULL days_supply covers through the
    window end; days_supply <= 0 gives an end before the start (no days).
    """
    return F.least(F.date_add(F.col(fill_dt), F.col(days_supply) - 1), date_lit(w.end))


def overlap_days(start: str, end: str, w: Window) -> Column:
    """Days of [start, end] inside the window, for spans already known to overlap it."""
    return F.datediff(F.least(F.col(end), date_lit(w.end)), F.greatest(F.col(start), date_lit(w.start))) + 1
