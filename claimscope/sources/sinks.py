"""Writers for job results.

Results go out as CSV with a header (the original deliverable) or as Parquet
partitioned by ``measurement_year`` so yearly reruns replace one partition.

``deliver_csv`` commits a manifest after the files: rows, bytes and a digest of
the lines of each.  ``read_delivered`` refuses a folder without one, or whose files
differ from it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write ``df`` as header CSV files under ``path`` (one file per task, no single-task funnel)."""
    df.write.mode(mode).option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)


MANIFEST = "_manifest"  # readers of the folder pass over names that begin with an underscore
_MANIFEST_SCHEMA = "file string, rows long, bytes long, digest string"


def _read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    reader = spark.read.schema(schema).option("header", True).option("multiLine", True).option("mode", "FAILFAST")
    return reader.option("dateFormat", "yyyy-MM-dd").csv(path)


def _file_figures(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One row for each file below ``path``: its records, bytes, and the sum of its lines' hashes (any order of lines)."""
    name = F.col("_metadata.file_name").alias("file")
    digest = F.sum(F.xxhash64("value").cast("decimal(38,0)")).cast("string")
    lines = spark.read.text(path).groupBy(name).agg(F.max("_metadata.file_size").alias("bytes"), digest.alias("digest"))
    records = _read_csv(spark, path, schema).groupBy(name).agg(F.count(F.lit(1)).alias("rows"))
    return lines.join(records, "file", "left").select("file", F.coalesce("rows", F.lit(0)).alias("rows"), "bytes", "digest")


def deliver_csv(df: DataFrame, path: str) -> None:
    """``write_csv``, then the manifest; a delivery that fails half-way has none."""
    spark = df.sparkSession
    write_csv(df, path)
    # a row per written file, whatever the rows: small enough for one task
    _file_figures(spark, path, df.schema).coalesce(1).write.json(f"{path.rstrip('/')}/{MANIFEST}")


def read_delivered(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of a delivery, once every file has the rows, bytes and digest of the manifest; else ValueError.

    An empty text comes back as NULL: the CSV files have one form for both.
    """
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{MANIFEST}/_SUCCESS")
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        raise ValueError(f"{path} has no committed manifest")
    listed = spark.read.schema(_MANIFEST_SCHEMA).json(f"{path.rstrip('/')}/{MANIFEST}")
    there = _file_figures(spark, path, schema)
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"t.{c}")) for c in ("rows", "bytes", "digest")]
    both = listed.alias("l").join(there.alias("t"), F.col("l.file") == F.col("t.file"), "full")
    wrong = both.where(~(same[0] & same[1] & same[2])).select(F.coalesce("l.file", "t.file").alias("file")).take(10)
    if wrong:
        raise ValueError(f"{path} differs from its manifest: {', '.join(sorted(r.file for r in wrong))}")
    return _read_csv(spark, path, schema)


def write_feed(tables: Mapping[str, DataFrame], base: str) -> str:
    """Write every table as header CSV below ``base``, as a text feed would deliver it; returns ``base``."""
    for name in tables:
        write_csv(tables[name], f"{base.rstrip('/')}/{name}")
    return base


def write_parquet(df: DataFrame, path: str, partition_by: str | None = "measurement_year", mode: str = "overwrite") -> None:
    """Write Parquet; partitions by ``partition_by`` when the column exists.

    Dynamic partition overwrite replaces only the years present in ``df``.
    """
    writer = df.write.mode(mode)
    if partition_by and partition_by in df.columns:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(partition_by)
    writer.parquet(path)


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Presentation cast used when comparing against engines that return DOUBLE."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            cols.append(F.col(f.name).cast("bigint").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
