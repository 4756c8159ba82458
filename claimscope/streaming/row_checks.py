"""Row-level checks over a file stream of claim headers or pharmacy fills.

``start_row_checks`` reads new files of one table with its declared schema,
applies the row-local check, and appends the offending rows as Parquet.
Progress is kept in the checkpoint folder that the caller names, one for each
source and sink: a later application that names it again goes on where this
one stopped, and neither loses nor repeats rows.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from claimscope.plans.quality import invalid_days_supply_rows, nonpositive_paid_rows
from claimscope.schema import TABLES
from claimscope.sources.tables import conform

CHECKS = {
    "medical_claim_fact": nonpositive_paid_rows,
    "pharmacy_claim_fact": invalid_days_supply_rows,
}


def start_row_checks(
    spark: SparkSession,
    table: str,
    source: str,
    sink: str,
    checkpoint: str,
    fmt: str = "parquet",
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the row-level check of ``table`` over files arriving in ``source``; rows go to ``sink``.

    ``available_now=True`` processes what is there in bounded micro-batches and
    stops (scheduled runs); ``False`` keeps running with the default trigger.
    """
    if table not in CHECKS:
        raise ValueError(f"no row-level check for {table}; choose from {sorted(CHECKS)}")
    declared = TABLES[table]
    reader = spark.readStream.format(fmt)
    if fmt == "csv":
        # all columns as text, like the batch reader; conform casts them
        reader = reader.option("header", True).schema(
            ", ".join(f"`{c.name}` string" for c in declared.cols if c.name != "load_dt")
        )
    else:
        reader = reader.schema(declared.struct)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = CHECKS[table](conform(reader.load(source), declared))
    writer = rows.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
