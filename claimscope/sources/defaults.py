"""Declared column defaults applied on ingest.

A SQL column default fires when the column is omitted from the insert, not
when the value is an explicit NULL.  So defaults are added only for columns
missing from the input DataFrame; present NULLs stay NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimscope.schema import TABLES, Table


def apply_defaults(df: DataFrame, table: Table | str, now: bool = True) -> DataFrame:
    """Add declared defaults (flags FALSE, load_dt = current_timestamp) for absent columns."""
    table = TABLES[table] if isinstance(table, str) else table
    present = set(df.columns)
    for c in table.cols:
        if c.name in present:
            continue
        if c.default is not None:
            df = df.withColumn(c.name, F.lit(c.default).cast(c.dtype))
        elif c.default_now and now:
            df = df.withColumn(c.name, F.localtimestamp().cast(c.dtype))
    return df
