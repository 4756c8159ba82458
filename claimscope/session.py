"""Session helpers: a local session for tests/bench and the checkpoint folder.

Library code never creates its own session; it only reads settings of the
session it is handed.  ``spark.checkpoint.dir`` is taken from the session as
the cluster configures it; a local one is set only where it is unset (tests,
bench runs on one machine).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "claimscope") -> SparkSession:
    """Session for tests and the local bench; UI off, AQE on."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CLAIMSCOPE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="claimscope-warehouse-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.

    Taken from the SparkContext or ``spark.checkpoint.dir``.  Only a local
    master (tests, bench on one machine) may fall back to a scratch folder;
    on a cluster an unset folder is an error, since a machine-local folder
    would not survive the loss of that machine.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a shared folder (HDFS, S3, ...) for this cluster")
        configured = tempfile.mkdtemp(prefix="claimscope-ckpt-")
    sc.setCheckpointDir(configured)
    return configured
