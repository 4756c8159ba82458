"""Cut lineage by writing a table to the session's checkpoint folder.

Used where a result is needed twice (a size check, then the plan itself) or
must not change if recomputed after an executor loss.  The table goes to
``spark.checkpoint.dir`` — a shared folder on a cluster — never to a
machine-local temporary folder, and is read back as a plain Parquet scan.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from claimscope.session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder below the checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/claimscope-{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and return the read-back DataFrame."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)
