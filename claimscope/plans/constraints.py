"""Declared constraints as reports: keys, foreign keys, NOT NULL, declared sizes.

A database rejects violating rows on insert; Spark stores whatever arrives, so
these jobs count the violations instead.  Each report is a union of one small
aggregate per table or per constraint; each aggregate has a map-side partial
step, so no key value (however frequent) is ever gathered into one task.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimscope.operators import orphan_report
from claimscope.schema import TABLE_NAMES, TABLES
from claimscope.sources.tables import ClaimsTables


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def primary_key_report(t: ClaimsTables) -> DataFrame:
    """Per table: rows, rows with a NULL key column, key values seen more than once, rows carrying them.

    One group-by on the key (NULL keys form their own groups), then one
    aggregate over the groups.
    """
    parts = []
    for name in TABLE_NAMES:
        table = TABLES[name]
        any_null = None
        for k in table.key:
            any_null = F.col(k).isNull() if any_null is None else (any_null | F.col(k).isNull())
        per_key = t[name].groupBy(*table.key).agg(F.count(F.lit(1)).alias("_n")).withColumn("_null", any_null)
        dup = ~F.col("_null") & (F.col("_n") > 1)
        parts.append(
            per_key.agg(
                F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("row_count"),
                F.coalesce(F.sum(F.when(F.col("_null"), F.col("_n"))), F.lit(0)).cast("bigint").alias("null_key_rows"),
                F.count_if(dup).alias("duplicate_keys"),
                F.coalesce(F.sum(F.when(dup, F.col("_n"))), F.lit(0)).cast("bigint").alias("duplicate_key_rows"),
            ).select(
                F.lit(name).alias("table_name"),
                F.lit(",".join(table.key)).alias("key_columns"),
                "row_count",
                "null_key_rows",
                "duplicate_keys",
                "duplicate_key_rows",
            )
        )
    return _union(parts)


def foreign_key_report(t: ClaimsTables) -> DataFrame:
    """Per declared reference: child rows (non-NULL FK) and distinct FK values without a parent row.

    Each child table is read once, whatever the number of its references.
    """
    parts = []
    for name in TABLE_NAMES:
        references = TABLES[name].foreign_keys
        if not references:
            continue
        child = t[name].select(*[col for col, _, _ in references])
        counts = orphan_report(child, {col: (t[table], key) for col, table, key in references})
        target = F.create_map(*[x for col, table, key in references for x in (F.lit(col), F.struct(F.lit(table).alias("ref_table"), F.lit(key).alias("ref_column")))])
        of = target[F.col("fk_column")]
        parts.append(counts.select(F.lit(name).alias("table_name"), F.col("fk_column").alias("column_name"), of["ref_table"].alias("ref_table"), of["ref_column"].alias("ref_column"), "orphan_rows", "orphan_keys"))
    return _union(parts)


def not_null_report(t: ClaimsTables) -> DataFrame:
    """Per NOT NULL column: rows where it is NULL."""
    parts = []
    for name in TABLE_NAMES:
        cols = [c.name for c in TABLES[name].cols if c.not_null]
        if not cols:
            continue
        agg = t[name].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        rows = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_rows")) for c in cols]
        parts.append(agg.select(F.lit(name).alias("table_name"), F.inline(F.array(*rows))))
    return _union(parts)


def _violations(df: DataFrame, table_name: str) -> list[tuple[str, str, object]]:
    """(column, rule, violation-count expression) for one raw table."""
    table = TABLES[table_name]
    present = set(df.columns)
    rules = []
    for c in table.cols:
        if c.name not in present:
            continue
        raw = F.col(c.name)
        if c.max_length:
            text = F.rtrim(raw.cast("string")) if c.char else raw.cast("string")
            kind = "CHAR" if c.char else "VARCHAR"
            rules.append((c.name, f"{kind}({c.max_length})", F.count_if(F.length(text) > c.max_length)))
        elif isinstance(c.dtype, (T.DecimalType, T.IntegerType)):
            target = c.dtype.simpleString()
            fits = F.expr(f"try_cast(`{c.name}` as {target})").isNotNull()
            label = f"NUMERIC({c.dtype.precision},{c.dtype.scale})" if isinstance(c.dtype, T.DecimalType) else "INT"
            rules.append((c.name, label, F.count_if(raw.isNotNull() & ~fits)))
    return rules


def conformance_report(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Rows breaking declared CHAR/VARCHAR lengths or NUMERIC/INT ranges, from the tables as delivered.

    ``raw`` holds the tables before they are cast to the declared schema (a
    cast would fail on overflow).  One aggregate pass per table.
    """
    parts = []
    for name in TABLE_NAMES:
        if name not in raw:
            continue
        rules = _violations(raw[name], name)
        if not rules:
            continue
        agg = raw[name].agg(*[expr.alias(f"_r{i}") for i, (_, _, expr) in enumerate(rules)])
        rows = [
            F.struct(F.lit(col).alias("column_name"), F.lit(rule).alias("rule"), F.col(f"_r{i}").alias("violations"))
            for i, (col, rule, _) in enumerate(rules)
        ]
        # one aggregate pass per table, unpivoted to one row per rule
        parts.append(agg.select(F.lit(name).alias("table_name"), F.inline(F.array(*rows))))
    return _union(parts)
