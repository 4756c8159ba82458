"""Text feeds (CSV with a header, JSON lines) read by the declared schema.

Nothing is inferred: a line is parsed into the declared columns as text and
then cast, so a feed is read once.  A line that cannot be parsed, or that holds
a value its column's type cannot take, is not loaded and does not stop the
load; it is kept with the reason (:func:`rejected`).

A declared default fires for a column that a record omits, not for an explicit
null: for CSV the header tells, for JSON the keys of each record.
"""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimscope.schema import Table

CORRUPT = "_corrupt_record"
UNPARSABLE = "unparsable"
TEXT_FORMATS = ("csv", "json")


def _strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])


def text_records(spark: SparkSession, path: str, table: Table, fmt: str) -> DataFrame:
    """One row per line: ``_record`` (the line), ``_given`` (array of the columns it
    gives), ``_text`` (the columns as text) and whether the line parsed (``_parsed``)."""
    lines = spark.read.text(path)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    if fmt == "csv":
        # the header is one line of the first file; every file repeats it
        first = lines.take(1)
        head = first[0]["value"] if first else ""
        names = next(csv.reader([head])) if head else []
        ddl = ", ".join(f"`{n}` STRING" for n in [*names, CORRUPT])
        parsed = F.from_csv("value", ddl, options)
        given: Column = F.array(*[F.lit(n) for n in names]) if names else F.array().cast("array<string>")
        lines = lines.where((F.col("value") != head) & (F.trim("value") != ""))
    elif fmt == "json":
        parsed = F.from_json("value", _strings(table.names), options)
        given = F.coalesce(F.json_object_keys("value"), F.array().cast("array<string>"))
        lines = lines.where(F.trim("value") != "")
    else:
        raise ValueError(f"not a text format: {fmt}")
    # generated, not projected: a filter on the columns is then not pushed below, where it would parse a line once per column
    rows = lines.select(F.col("value").alias("_record"), given.alias("_given"), F.explode(F.array(parsed)).alias("_text"))
    good = F.col("_text").isNotNull() & F.col(f"_text.{CORRUPT}").isNull()
    return rows.withColumn("_parsed", good)


def _value(table: Table, name: str, present: bool) -> tuple[Column, Column]:
    """(typed value, whether the text cannot be cast) of a column of a parsed record."""
    column = table.col(name)
    if not present:
        given_text, typed = F.lit(None).cast("string"), F.lit(None).cast(column.dtype)
    else:
        given_text = F.col("_text").getField(name)
        typed = given_text.try_cast(column.dtype)
    bad = given_text.isNotNull() & typed.isNull()
    if column.char:
        typed = F.rtrim(typed)
    default = F.lit(column.default).cast(column.dtype) if column.default is not None else F.localtimestamp().cast(column.dtype) if column.default_now else None
    if default is not None:
        typed = F.when(F.array_contains("_given", name), typed).otherwise(default)
    return typed, bad


def _typed(records: DataFrame, table: Table) -> tuple[dict[str, Column], Column]:
    """Typed columns, and the reason why a record is not loaded (NULL: it is)."""
    present = set(records.schema["_text"].dataType.names)
    values = {n: _value(table, n, n in present) for n in table.names}
    failing = F.array_compact(F.array(*[F.when(bad, F.lit(n)) for n, (_, bad) in values.items()]))
    reason = F.when(~F.col("_parsed"), F.lit(UNPARSABLE)).when(F.size(failing) > 0, F.array_join(failing, ","))
    return {n: v for n, (v, _) in values.items()}, reason


def loaded(records: DataFrame, table: Table) -> DataFrame:
    """The records that fit the declared schema, typed."""
    values, reason = _typed(records, table)
    return records.where(reason.isNull()).select(*[v.alias(n) for n, v in values.items()])


def as_delivered(records: DataFrame, table: Table) -> DataFrame:
    """The declared columns as text, of every line that parsed (for conformance rules)."""
    present = [n for n in table.names if n in set(records.schema["_text"].dataType.names)]
    return records.where("_parsed").select(*[F.col("_text").getField(n).alias(n) for n in present])


def rejected(records: DataFrame, table: Table) -> DataFrame:
    """table_name, reason (``unparsable`` or the columns that cannot be cast), record."""
    _, reason = _typed(records, table)
    return records.select(F.lit(table.name).alias("table_name"), reason.alias("reason"), F.col("_record").alias("record")).where(F.col("reason").isNotNull())
