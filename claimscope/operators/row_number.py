"""Total row numbers: ``row_number() over (order by ...)`` without one task that holds all rows.

1. Rows go to ranges of the order (``repartitionByRange``), each with its range's
   number, and are written once: range bounds are sampled, so a task that is run
   again after a loss must not cut anew.
2. Rows are counted per range; a range begins after the rows of all ranges before it.
   There are as many ranges as shuffle partitions, whatever the rows.
3. Inside a range rows are numbered by a window over that range.

Rows that are equal in every order column share a range and are numbered in any
order among themselves; add a key to the order where one such group is large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimscope.operators.materialize import materialize


def with_row_number(df: DataFrame, order: list[Column], out: str = "row_number") -> DataFrame:
    """``df`` plus ``out``, from 1, by ``order`` (columns with their NULL order spelled out).  Empty: empty."""
    ranged = materialize(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")
    starts = counts.select("_range", before.alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    numbered = ranged.withColumn("_inside", inside).join(F.broadcast(starts), "_range")
    return numbered.select(*df.columns, (F.col("_before") + F.col("_inside")).alias(out))
