"""Distinct covered days of date intervals, per key group.

``covered_days`` is the production form: an interval merge that never
expands intervals into days.

1. Spans with end < start (or a NULL bound) cover nothing and are dropped; a
   group left with no span is absent from the result, as with day expansion.
2. ``groupBy(keys, start).max(end)``: of all spans starting on one day only the
   longest matters.  This aggregate runs map-side first, so a hot key (one
   member with a third of all fills) is collapsed before the shuffle, and
   after it a group holds at most one row per distinct start day — bounded by
   the window length, never by the number of fills.
3. Per group, ordered by start: ``prev`` = max end of all earlier rows; the
   span adds ``end - max(start, prev + 1) + 1`` new days (or none).
4. Sum per group.  The window and the sum share one hash partitioning.

``covered_days_exploded`` is the literal form (one row per covered day, then a
count) over merged islands, so every covered day is made once; it is kept as a
cross-check.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _valid(spans: DataFrame, start: str, end: str) -> DataFrame:
    return spans.where(F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(start) <= F.col(end)))


def covered_days(
    spans: DataFrame,
    keys: Sequence[str],
    start: str = "fill_start",
    end: str = "fill_end",
    out: str = "covered_days",
    cluster_by: Sequence[str] | None = None,
) -> DataFrame:
    """Distinct covered days per ``keys`` group.

    ``cluster_by`` (a prefix of ``keys``, e.g. member_id) hashes the collapsed
    spans by fewer columns, so a following join on those columns needs no
    further shuffle; it is applied after the per-start collapse, so the rows
    moved stay bounded by the window length per group.
    """
    keys = list(keys)
    longest = _valid(spans, start, end).groupBy(*keys, start).agg(F.max(end).alias(end))
    if cluster_by:
        longest = longest.repartition(*cluster_by)
    earlier = Window.partitionBy(*keys).orderBy(start).rowsBetween(Window.unboundedPreceding, -1)
    prev_end = F.max(end).over(earlier)
    first_new = F.greatest(F.col(start), F.date_add(prev_end, 1))  # greatest skips the NULL of row 1
    new_days = F.greatest(F.lit(0), F.datediff(F.col(end), first_new) + 1)
    return (
        longest.select(*keys, new_days.alias("_new_days"))
        .groupBy(*keys)
        .agg(F.sum("_new_days").cast("bigint").alias(out))
    )


def islands(
    spans: DataFrame,
    keys: Sequence[str],
    start: str = "fill_start",
    end: str = "fill_end",
) -> DataFrame:
    """(keys, start, end) of the maximal runs of covered days: gaps and islands.

    Ordered by start, a span opens an island when it begins more than a day
    after everything before it has ended; a running count of openings numbers the
    islands.  Both windows and the last aggregate share one hash partitioning, and
    a group holds at most one span per start day, as in :func:`covered_days`.
    """
    keys = list(keys)
    longest = _valid(spans, start, end).groupBy(*keys, start).agg(F.max(end).alias(end)).repartition(*keys)
    line = Window.partitionBy(*keys).orderBy(start)
    before = F.max(end).over(line.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.col(start) <= F.date_add(before, 1), 0).otherwise(1)
    numbered = longest.withColumn("_opens", opens).withColumn("_island", F.sum("_opens").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    runs = numbered.groupBy(*keys, "_island").agg(F.min(start).alias(start), F.max(end).alias(end))
    return runs.drop("_island")


def covered_days_exploded(
    spans: DataFrame,
    keys: Sequence[str],
    start: str = "fill_start",
    end: str = "fill_end",
    out: str = "covered_days",
) -> DataFrame:
    keys = list(keys)
    # islands of one group do not touch, so no day comes twice and none needs to be made distinct
    days = islands(spans, keys, start, end).select(*keys, F.explode(F.sequence(F.col(start), F.col(end))).alias("_day"))
    return days.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))
