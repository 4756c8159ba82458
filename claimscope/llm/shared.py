"""Helpers shared by the operators: intermediate tables, row batches, blobs."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimscope.session import ensure_checkpoint_dir

#: Stands for a null id where ids are compared as numbers: after all others.
NULL_ID = np.iinfo(np.int64).max


def partitions(spark: SparkSession) -> int:
    """The session's shuffle width, which a deployment sizes to its data."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the checkpoint folder that all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


_RECORD: list[list[tuple[str, str]]] = []


@contextmanager
def recorded() -> Iterator[list[tuple[str, str]]]:
    """(name, path) of the tables that are stored meanwhile."""
    _RECORD.append([])
    try:
        yield _RECORD[-1]
    finally:
        _RECORD.pop()


def dropped(spark: SparkSession, made: list[tuple[str, str]], keep: tuple[str, ...] = ()) -> list[tuple[str, str]]:
    """Delete stored tables that nothing will read again, but for names to keep; those kept."""
    for name, path in made:
        if name not in keep:
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    return [x for x in made if x[0] in keep]


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` once to the shared folder and read it back."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    for made in _RECORD:
        made.append((name, path))
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of ``rows`` rows at most for jobs run meanwhile, where a row is wide; then the session's own again."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def rows_of(batches: Iterator[pa.RecordBatch], limit: int, text: str = "text", most: int = 1 << 16) -> Iterator[pa.Table]:
    """Regroup Arrow batches so that a table holds about ``limit`` bytes of
    text and ``most`` rows at most, or one row; a text is never cut."""
    held, size, count = [], 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        lengths = np.asarray(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            ends = np.cumsum(lengths[at:])
            take = max(int(np.searchsorted(ends, limit - size, side="right")), 0 if held else 1)
            take = min(take, most - count)
            if take:
                held.append(batch.slice(at, take))
                size += int(ends[take - 1])
                count += take
                at += take
            if at < batch.num_rows or size >= limit or count >= most:
                yield pa.Table.from_batches(held)
                held, size, count = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def ascending(values: np.ndarray) -> bytes:
    """Blob of ascending int64 values (compressed differences)."""
    return zstandard.compress(np.diff(values.astype(np.int64), prepend=0).astype("<i8").tobytes(), 1)


def from_ascending(blob: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zstandard.decompress(blob), dtype="<i8"))


def range_number(value: Column, bounds: list[int]) -> Column:
    """How many bounds lie below ``value`` (null: none), found in two steps of sqrt(bounds)."""
    if not bounds:
        return F.lit(0)
    step = math.isqrt(len(bounds) - 1) + 1
    groups = F.size(F.filter(F.lit(bounds[::step]), lambda b: b < value))
    inside = F.size(F.filter(F.slice(F.lit(bounds), F.greatest(F.lit(1), (groups - 1) * step + 1), F.lit(step)), lambda b: b < value))
    return F.coalesce(F.when(groups == 0, 0).otherwise((groups - 1) * step + inside), F.lit(0))
