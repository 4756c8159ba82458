"""Points in no interval of their key, by one sweep over the days.

Interval starts and points of a key form one ordered line; a running
``max(end)`` over the starts so far tells whether any interval still reaches the
point.  No point meets an interval, so a key's work is the length of its line,
whatever overlaps.

Before the sweep both sides collapse, in each task first: intervals to the longest of
each (key, start), points to one row per (key, point columns) with a count.
So a line is bounded by the days (times the values of the point columns),
not by the rows of a key, and a key with a third of all rows is like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Copies that one step of ``repeated`` makes of a row.
STEP = 1024


def outside_points(points: DataFrame, intervals: DataFrame, key: str, at: str, start: str, end: str, also: Sequence[str] = (), count: str = "n_rows") -> DataFrame:
    """(key, at, also…, count) of the points that lie in no interval [start, end] of their key.

    A point without a key or a day lies in none; an interval without a bound,
    or that ends before it starts, holds nothing.
    """
    grouped = points.groupBy(key, at, *also).agg(F.count(F.lit(1)).alias(count))
    reach = intervals.where(F.col(key).isNotNull() & (F.col(start) <= F.col(end))).groupBy(key, start).agg(F.max(end).alias("_end"))
    line = grouped.withColumn("_end", F.lit(None).cast(intervals.schema[end].dataType)).unionByName(
        reach.withColumnRenamed(start, at).withColumn(count, F.lit(0).cast("bigint")), allowMissingColumns=True
    )
    # on one day a start comes before the points, which it covers
    so_far = Window.partitionBy(key).orderBy(F.col(at).asc_nulls_first(), F.col(count).asc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = line.withColumn("_reach", F.max("_end").over(so_far))
    covered = F.coalesce(F.col("_reach") >= F.col(at), F.lit(False))
    return swept.where((F.col(count) > 0) & ~covered).select(key, at, *also, count)


def repeated(df: DataFrame, count: str) -> DataFrame:
    """Every row ``count`` times (the column is dropped), in two steps, so no array grows with a row's copies."""
    steps = df.withColumn("_step", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(count) - 1) / STEP).cast("bigint"))))
    left = F.least(F.lit(STEP).cast("bigint"), F.col(count) - F.col("_step") * STEP)
    return steps.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), left))).drop("_step", "_copy", count)
