"""Checkpoint folder handling and table materialization."""

from __future__ import annotations

from claimscope.operators import materialize
from claimscope.session import ensure_checkpoint_dir


def test_checkpoint_dir_is_taken_from_the_session(spark):
    first = ensure_checkpoint_dir(spark)
    assert first and ensure_checkpoint_dir(spark) == first  # set once, then reused


def test_materialize_writes_under_checkpoint_dir(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    out = materialize(df, "unit")
    assert out.count() == 100
    files = out.inputFiles()
    base = ensure_checkpoint_dir(spark).replace("file:", "")
    assert files and all(base in f for f in files)
