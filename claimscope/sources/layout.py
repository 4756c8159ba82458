"""Physical layouts: bucketed catalog tables, and claims and fills by year.

Buckets: co-located joins on member_id and claim_line_id.

The jobs join and aggregate member-keyed tables on member_id, and lines with
the diagnosis bridge on claim_line_id.  Saved with the same bucket count on
those keys, the scans already carry that hash partitioning, so Spark plans
these joins and aggregates without shuffling the large side.  Dimensions are
written unbucketed.  ``conform`` keeps the key column untouched, so the
bucketing survives into the jobs.

Years: claims and fills in one folder per year of their day.  A window job asks
for its rows through ``ClaimsTables.dated``, which adds the years of the window as a
partition filter, so folders of other years are not even listed; jobs over all
days read all folders.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimscope.schema import TABLE_NAMES, TABLES
from claimscope.sources.tables import YEAR_COLUMN, ClaimsTables, conform

# bucket column per table (tables not listed are written unbucketed)
BUCKET_KEYS = {
    "member_dim": "member_id",
    "eligibility_fact": "member_id",
    "medical_claim_fact": "member_id",
    "pharmacy_claim_fact": "member_id",
    "medical_claim_line_fact": "claim_line_id",
    "medical_claim_line_dx_bridge": "claim_line_id",
}


def save_bucketed(t: ClaimsTables, database: str, location: str, buckets: int = 512) -> list[str]:
    """Save the ten tables as Parquet catalog tables in ``database``, files under ``location``."""
    spark = t.medical_claim_fact.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{location.rstrip('/')}/_db'")
    names = []
    for name in TABLE_NAMES:
        writer = t[name].write.mode("overwrite").format("parquet").option("path", f"{location.rstrip('/')}/{name}")
        key = BUCKET_KEYS.get(name)
        if key:
            writer = writer.bucketBy(buckets, key).sortBy(key)
        full = f"`{database}`.`{name}`"
        writer.saveAsTable(full)
        names.append(full)
    return names


def load_catalog_tables(spark: SparkSession, database: str) -> ClaimsTables:
    """The ten tables from catalog ``database``, conformed to the declared schema."""
    raw = {name: spark.table(f"`{database}`.`{name}`") for name in TABLE_NAMES}
    return ClaimsTables({name: conform(df, name) for name, df in raw.items()}, raw)


# day whose year names the folder
YEAR_KEYS = {
    "medical_claim_fact": "service_from_dt",
    "pharmacy_claim_fact": "fill_dt",
}


def save_by_year(t: ClaimsTables, base: str, files: int = 64) -> list[str]:
    """Claims and fills as Parquet below ``base``, a folder per year, rows without a day in one of their own.

    A year's rows are dealt by primary key over at most ``files`` tasks, one file each, so
    neither a busy year nor a busy member is one task, and the number of files does not grow with tasks.
    """
    paths = []
    for name, day in YEAR_KEYS.items():
        path = f"{base.rstrip('/')}/{name}"
        dealt = F.pmod(F.xxhash64(*TABLES[name].key), F.lit(files))
        rows = t[name].withColumn(YEAR_COLUMN, F.year(day))
        rows.repartition(YEAR_COLUMN, dealt).write.mode("overwrite").partitionBy(YEAR_COLUMN).parquet(path)
        paths.append(path)
    return paths


def with_years(t: ClaimsTables, base: str) -> ClaimsTables:
    """``t`` with claims and fills read from the folders that ``save_by_year`` wrote; its other tables as they are."""
    spark = t.medical_claim_fact.sparkSession
    yearly = {}
    for name in YEAR_KEYS:
        fields = [T.StructField(c.name, c.dtype) for c in TABLES[name].cols]
        schema = T.StructType([*fields, T.StructField(YEAR_COLUMN, T.IntegerType())])
        yearly[name] = spark.read.schema(schema).parquet(f"{base.rstrip('/')}/{name}")
    return t.by_year(**yearly)
