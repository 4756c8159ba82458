"""Joins whose hot keys are spread over tasks, by measured frequency.

``hot_keys`` counts the fact rows of every key (a partial aggregate per task,
then one row per key) and keeps the keys that hold more than one row in
``share``: there are fewer than ``share`` of them whatever the data, so the
list may always be broadcast.  Each gets salts in proportion to its part of
the rows.  ``salted_join`` gives a hot key's fact rows one of its salts and repeats the
other side's rows of that key once per salt; rows of all other keys keep salt 0 and
are joined as they are.

Counts are exact and the whole decision is part of the plan: nothing runs when
it is built, and a recomputed task makes the same decision again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is hot when it holds more than one in SHARE of the rows (so fewer than SHARE keys are).
SHARE = 200
#: Salts that a key with all the rows would get.
SPREAD = 1024


def hot_keys(counts: DataFrame, key: str, n: str = "_n", share: int = SHARE, spread: int = SPREAD) -> DataFrame:
    """(key, _salts) of the hot keys of ``counts`` (one row per key, ``n`` rows each)."""
    total = counts.agg(F.sum(n)).scalar()
    salts = F.ceil(F.col(n) * F.lit(spread) / total).cast("int")
    return counts.where(F.col(n) * F.lit(share) > total).select(F.col(key).alias("_hot"), salts.alias("_salts"))


def salted_join(
    facts: DataFrame,
    other: DataFrame,
    on: str,
    salt_from: Sequence[str],
    counts: DataFrame | None = None,
    share: int = SHARE,
    spread: int = SPREAD,
    null_safe: bool = False,
) -> DataFrame:
    """Inner join of ``facts`` and ``other`` on ``on`` (kept once), hot keys spread over tasks.

    ``salt_from``: columns of ``facts`` that tell the rows of one key apart.
    ``counts`` (key, _n) may be passed where it is at hand.  ``null_safe``
    lets NULL meet NULL; else rows without a key drop out before any shuffle.
    """
    if not null_safe:
        facts, other = facts.where(F.col(on).isNotNull()), other.where(F.col(on).isNotNull())
    if counts is None:
        counts = facts.groupBy(on).agg(F.count(F.lit(1)).alias("_n"))
    hot = hot_keys(counts, on, share=share, spread=spread)

    def with_salts(df: DataFrame) -> DataFrame:
        side = F.broadcast(hot)
        return df.join(side, df[on].eqNullSafe(side["_hot"]), "left").withColumn("_salts", F.coalesce("_salts", F.lit(1))).drop("_hot")

    salt = F.pmod(F.xxhash64(*salt_from), F.col("_salts").cast("bigint")).cast("int")
    left = with_salts(facts).withColumn("_salt", salt).drop("_salts")
    right = with_salts(other).withColumn("_other_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).drop("_salts").withColumnRenamed(on, "_other_key")
    key: Column = F.col(on).eqNullSafe(F.col("_other_key")) if null_safe else F.col(on) == F.col("_other_key")
    return left.join(right, key & (F.col("_salt") == F.col("_other_salt"))).drop("_other_key", "_salt", "_other_salt")
