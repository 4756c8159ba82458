"""Join helpers: broadcast only behind a size check; salt hot keys of lookups.

``sized_broadcast`` counts the (already filtered and projected) side and hints
a broadcast only when the count is under ``max_rows``; above it the planner
keeps a shuffle join (and AQE may still convert it at runtime from measured
sizes).  ``salted_lookup`` joins a many-row fact side to a side with unique
keys when that side is too big to broadcast: the fact side gets a salt from a
hash of its own row key (deterministic under task retry), the lookup side is
replicated once per salt, so one hot key is spread over ``salts`` tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A few million narrow rows (codes, flags, one value per distinct key) is
# well under executor memory; above this the side is shuffled instead.
BROADCAST_MAX_ROWS = 2_000_000


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> bool:
    """True if ``df`` has at most ``max_rows`` rows.

    A plain count: every task sends one number.  A limit before it would send
    up to ``max_rows`` rows of every task to a single one.
    """
    return df.count() <= max_rows


def sized_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, small: bool | None = None) -> DataFrame:
    """``broadcast(df)`` if it has at most ``max_rows`` rows, else ``df`` unchanged.

    ``small`` passes a size decision already measured for the same data.
    """
    if small is None:
        small = fits_broadcast(df, max_rows)
    return F.broadcast(df) if small else df


def salted_lookup(
    facts: DataFrame,
    lookup: DataFrame,
    on: str,
    salt_from: Sequence[str],
    salts: int = 32,
    null_safe: bool = True,
) -> DataFrame:
    """Inner join ``facts`` to ``lookup`` (unique on ``on``) with the key spread over ``salts`` tasks."""
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in salt_from]), F.lit(salts)).cast("int")
    left = facts.withColumn("_salt", salt)
    right = lookup.withColumnRenamed(on, "_lk").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    key: Column = left[on].eqNullSafe(right["_lk"]) if null_safe else (left[on] == right["_lk"])
    joined = left.join(right, key & (left["_salt"] == right["_salt"]), "inner")
    return joined.drop("_lk").drop(left["_salt"]).drop(right["_salt"])
