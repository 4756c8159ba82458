"""Key checks: duplicates, orphan foreign keys.

All are aggregates with a map-side partial step, so a hot key value is one
row per task before any shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_col: str = "occurrences") -> DataFrame:
    """Key values seen more than once (GROUP BY key HAVING count(*) > 1)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col)).where(F.col(count_col) > 1)


def orphan_report(child: DataFrame, parents: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per foreign key of ``child``: fk_column, orphan_rows, orphan_keys (0 where none).

    ``parents``: fk column -> (parent table, its key column).  The child is read
    once: its references are unpivoted to (fk_column, value) and counted, in each
    task first; one anti-join on both against the parents' keys leaves the orphans.
    Values are compared as text, so keys of different types share the plan.
    """
    names = list(parents)
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("fk_column"), F.col(c).cast("string").alias("_value")) for c in names]))
    counted = child.select(pairs.alias("_ref")).select("_ref.*").where(F.col("_value").isNotNull()).groupBy("fk_column", "_value").agg(F.count(F.lit(1)).alias("_rows"))
    keys = [parent.select(F.lit(c).alias("fk_column"), F.col(pk).cast("string").alias("_value")) for c, (parent, pk) in parents.items()]
    known = keys[0]
    for more in keys[1:]:
        known = known.unionByName(more)
    orphans = counted.join(known, ["fk_column", "_value"], "left_anti")
    found = orphans.groupBy("fk_column").agg(F.sum("_rows").cast("bigint").alias("orphan_rows"), F.count(F.lit(1)).alias("orphan_keys"))
    # a column without orphans has a row too
    zero = F.lit(0).cast("bigint")
    each = F.array(*[F.struct(F.lit(c).alias("fk_column"), zero.alias("orphan_rows"), zero.alias("orphan_keys")) for c in names])
    none = child.sparkSession.range(1).select(F.inline(each))
    return found.unionByName(none).groupBy("fk_column").agg(F.sum("orphan_rows").alias("orphan_rows"), F.sum("orphan_keys").alias("orphan_keys"))


def orphan_counts(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Rows of ``child`` whose non-NULL ``fk`` has no ``parent.pk``: one row (orphan_rows, orphan_keys).

    Counts per FK value first (partial aggregate collapses hot values), then
    anti-joins the distinct values against the parent keys.
    """
    per_value = child.where(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("_rows"))
    parent_keys = parent.select(F.col(pk).alias(fk))
    orphans = per_value.join(parent_keys, fk, "left_anti")
    return orphans.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint").alias("orphan_rows"),
        F.count(F.lit(1)).alias("orphan_keys"),
    )
