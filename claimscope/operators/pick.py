"""``DISTINCT ON (key) … ORDER BY key, priority`` as one aggregate.

``min(struct(priority…, payload…))`` per key picks the row that sorts first
on the priority columns; it is a plain hash aggregate (partial map-side, then
final), so no sort of the whole input and no window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_by_priority(df: DataFrame, key: str | Sequence[str], priority: Sequence[str], payload: Sequence[str]) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    fields = list(priority) + [c for c in payload if c not in priority]
    picked = df.groupBy(*keys).agg(F.min(F.struct(*fields)).alias("_pick"))
    return picked.select(*keys, *[F.col(f"_pick.{f}").alias(f) for f in fields])
