"""Exact ``percent_rank() over (order by value desc nulls first)`` as one plan of bounded steps.

A window with ORDER BY and no PARTITION BY sends every row to one task.  Here
the order is cut into ranges by the value itself, coarse to fine:

1. ``groupBy(value).count()`` collapses ties, in each task first, so a value
   shared by a third of all rows is one row from here on.
2. A value's range is ``floor(value / 10**digits)`` of its last place, that
   range's range the same again, up to the type's precision.  Counts per range
   are a histogram that merges over tasks; each level is summed from the one below.
3. Going down, a range's offset is its parent's plus the rows in greater ranges of
   the same parent: a window over at most ``10**digits`` rows.  Only the top
   level, as many ranges as its few leading digits can have, is one task's work.
4. On the finest level the offset is ``rank - 1``, and
   ``percent_rank = (rank - 1) / (n - 1)`` (0 when n = 1).
5. Join back on the value, NULL-safe, values with many ties spread by
   frequency (``skew.salted_join``).

Ranges depend on a value alone, never on a sample or on what else is there, so a recomputed
task makes the same ranges; nothing is measured or written while the plan is built.
"""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimscope.operators.skew import SHARE, salted_join

#: Decimal places that one level takes: a window holds at most 10**DIGITS rows.
DIGITS = 6
#: Leading places that a floating value's ranges are made for; larger ones share the top level.
FLOAT_PLACES, FLOAT_SCALE = 24, 2


def _places(kind: T.DataType) -> tuple[int, int]:
    """(places, those after the point) of a type."""
    if isinstance(kind, T.DecimalType):
        return kind.precision, kind.scale
    if isinstance(kind, T.IntegralType):
        return 19, 0
    if isinstance(kind, T.FractionalType):
        return FLOAT_PLACES, FLOAT_SCALE
    raise TypeError(f"cannot rank {kind.simpleString()}")


def _range_of(value: Column, kind: T.DataType, places: int) -> Column:
    """floor(value / 10**places), in the value's own order (negative: down, NULL: NULL)."""
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        return F.floor(value.cast("double") / F.lit(10.0**places)).cast("double")
    return F.floor(value / F.lit(Decimal(1).scaleb(places))).cast("decimal(38,0)")


def rank_offsets(counts: DataFrame, value: str, n: str = "_n", digits: int = DIGITS) -> DataFrame:
    """(value, n, _before, _total) for one row per value: rows of greater values (NULL is greatest), and all rows."""
    kind = counts.schema[value].dataType
    places, scale = _places(kind)
    levels = [counts.select(F.col(value).alias("_v0"), F.col(n).alias("_n0"))]
    while len(levels) * digits < places:
        k = len(levels)
        below = f"_v{k - 1}"
        up = _range_of(F.col(below), kind, digits - scale if k == 1 else digits)
        levels[-1] = levels[-1].withColumn(f"_v{k}", up)
        levels.append(levels[-1].groupBy(f"_v{k}").agg(F.sum(f"_n{k - 1}").alias(f"_n{k}")))

    def greater(k: int, *inside: str) -> Column:
        window = Window.partitionBy(*inside).orderBy(F.col(f"_v{k}").desc_nulls_first())
        return F.coalesce(F.sum(f"_n{k}").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("bigint"))

    top = len(levels) - 1
    ranked = levels[top].select(F.col(f"_v{top}").alias("_up"), greater(top).alias("_before"), F.sum(f"_n{top}").over(Window.partitionBy()).alias("_total"))
    if not top:
        ranked = levels[0].select(F.col("_v0").alias("_up"), "_n0", greater(0).alias("_before"), F.sum("_n0").over(Window.partitionBy()).alias("_total"))
    for k in range(top - 1, -1, -1):
        here = levels[k].withColumn("_inside", greater(k, f"_v{k + 1}"))
        both = here.join(ranked, here[f"_v{k + 1}"].eqNullSafe(ranked["_up"]))
        ranked = both.select(F.col(f"_v{k}").alias("_up"), *(["_n0"] if not k else []), (F.col("_before") + F.col("_inside")).alias("_before"), "_total")
    return ranked.select(F.col("_up").alias(value), F.col("_n0").alias(n), "_before", "_total")


def percent_rank_desc(
    df: DataFrame,
    value: str,
    out: str = "cost_percentile",
    row_key: tuple[str, ...] = ("member_id",),
    digits: int = DIGITS,
    share: int = SHARE,
) -> DataFrame:
    """``df`` plus ``out`` = percent_rank of ``value`` descending, NULLs first (ties share a rank)."""
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    offsets = rank_offsets(counts, value, digits=digits)
    pct = F.col("_before").cast("double") / F.greatest(F.col("_total") - 1, F.lit(1)).cast("double")
    lookup = offsets.select(value, pct.alias(out))
    return salted_join(df, lookup, value, salt_from=row_key, counts=counts, share=share, null_safe=True).select(*df.columns, out)


def levels_of(kind: T.DataType, digits: int = DIGITS) -> int:
    """How many levels a type's values are ranked in."""
    return max(1, math.ceil(_places(kind)[0] / digits))
