"""Interval–point joins by dyadic decomposition of the day axis.

Days are numbered ``unix_date(d) + OFFSET`` (positive for every DATE) and
grouped into aligned blocks: at level ``k`` block ``j`` holds days
``[j·2^k, (j+1)·2^k)``.

* a day belongs to exactly one block per level: its ancestors;
* an interval ``[s, e]`` is the disjoint union of the maximal blocks inside
  it, at most two per level: its cover.

So "interval I contains day x" becomes an equi-join of I's cover with x's
ancestors on (key, level, block), with exactly one match per (I, x) pair and
none otherwise.  The join emits only true pairs, never all pairs of a group,
and a busy key is spread over its (level, block) sub-keys.  Prefix and suffix
covers (``[0, x]``, ``[x, TOP]``) give dominance aggregates the same way.

Blocks are produced by exploding the levels and computing bounds with plain
column arithmetic (whole-stage codegen), one row per emitted block with
columns ``_lvl`` and ``_block``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OFFSET = 1 << 22  # 0001-01-01 is unix day -719162; 9999-12-31 is 2932896
LEVELS = 24  # block levels run 0..LEVELS; 2^24 > 9999-12-31 + OFFSET
TOP = (1 << LEVELS) - 1


def day_number(d: str | Column) -> Column:
    c = F.col(d) if isinstance(d, str) else d
    return F.unix_date(c).cast("long") + F.lit(OFFSET)


def _levels(df: DataFrame, top: int) -> DataFrame:
    return df.withColumn("_lvl", F.explode(F.sequence(F.lit(0), F.lit(top))))


def _size(k: Column) -> Column:
    """2^k as a long (division by it is exact in double for day numbers < 2^53)."""
    return F.pow(F.lit(2), k).cast("long")


def with_ancestors(df: DataFrame, x: Column, top: int = LEVELS) -> DataFrame:
    """One row per level 0..top with ``_lvl`` and ``_block`` = the block holding day ``x``."""
    out = _levels(df, top)
    return out.withColumn("_block", F.floor(x / _size(F.col("_lvl"))).cast("long"))


def with_cover(df: DataFrame, s: Column, e: Column) -> DataFrame:
    """One row per maximal aligned block inside ``[s, e]`` (none when e < s or a bound is NULL)."""
    out = _levels(df.where(s.isNotNull() & e.isNotNull() & (e >= s)), LEVELS)
    size = _size(F.col("_lvl"))
    r = e + 1
    out = out.select(
        "*",
        F.floor((s + size - 1) / size).cast("long").alias("_lo"),  # first block at level k inside [s, r)
        F.floor(r / size).cast("long").alias("_hi"),  # one past the last
        (F.floor((s + 2 * size - 1) / (2 * size)) * 2).cast("long").alias("_up_lo"),  # blocks covered a level up
        (F.floor(r / (2 * size)) * 2).cast("long").alias("_up_hi"),
    )
    lo, hi = F.col("_lo"), F.col("_hi")

    def inside_up(j: Column) -> Column:
        return (j >= F.col("_up_lo")) & (j < F.col("_up_hi"))

    pick = F.array(
        F.when((lo < hi) & ~inside_up(lo), lo),
        F.when((hi - 1 > lo) & ~inside_up(hi - 1), hi - 1),
    )
    out = out.select("*", F.explode(pick).alias("_block")).where(F.col("_block").isNotNull())
    return out.drop("_lo", "_hi", "_up_lo", "_up_hi")


def with_prefix_cover(df: DataFrame, x: Column) -> DataFrame:
    """Blocks covering ``[0, x]``."""
    return with_cover(df, F.lit(0).cast("long"), x)


def with_suffix_cover(df: DataFrame, x: Column) -> DataFrame:
    """Blocks covering ``[x, TOP]``."""
    return with_cover(df, x, F.lit(TOP).cast("long"))


def interval_point_pairs(
    intervals: DataFrame, points: DataFrame, key: str, start: str, end: str, at: str
) -> DataFrame:
    """All (interval row, point row) pairs with equal ``key`` and ``start <= at <= end`` (DATE columns).

    Exactly one block matches per true pair, so nothing else is emitted.
    Apart from ``key``, the two inputs must not share column names.
    """
    iv = with_cover(intervals, day_number(start), day_number(end))
    pt = with_ancestors(points.where(F.col(at).isNotNull()), day_number(at))
    return iv.join(pt, [key, "_lvl", "_block"]).drop("_lvl", "_block")
