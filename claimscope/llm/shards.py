"""Training-order materialisation: token sequences in fixed-stride shards.

Documents' token ids (each text's, then END) are written one after the other
and cut into sequences of ``TOKENS``; every map task cuts what it reads, so
its last sequence may be short and is padded.  Sequences are numbered task by
task; a keyed Feistel permutation over the next power of four, with
cycle-walking into the range, gives every number its slot in the training
order.  Slots are range-partitioned into shards of ``RECORDS`` records; a
shard is one file in which record r begins at byte ``r * STRIDE``, so a
reader streams it, or resumes at any slot, with one seek.

A record is a little-endian header (sequence number, 8 bytes; tokens, 4
bytes), the ids (2 bytes each, padded with END) and a line feed.  Spark's own
writer commits the files, so a lost task leaves nothing behind.

Tokens are made twice: once to count the sequences of each task, which the
numbers need, and once to write them; storing them between the two passes
would take more room than the shards.  If a task's second count differs (its
input changed meanwhile), it fails.

Defined cases: null or empty text is one token (END); rows that repeat are
written again; ids and other columns are unused; an empty table writes no
shard.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimscope.llm import tokens
from claimscope.llm.hashing import mix
from claimscope.llm.shared import partitions, shared_path

TOKENS = 2048
RECORDS = 2048
HEADER = np.dtype([("sequence", "<u8"), ("tokens", "<u4")])
STRIDE = HEADER.itemsize + 2 * TOKENS + 1
KEY = "training order"
ROUNDS = 4


def permuted(numbers: np.ndarray, count: int, key: str = KEY) -> np.ndarray:
    """A keyed permutation of range(count), at the given numbers."""
    half = np.uint64(max(1, (max(count - 1, 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = [np.uint64(int.from_bytes(hashlib.blake2b(f"{key}:{r}".encode(), digest_size=8).digest(), "little")) for r in range(ROUNDS)]
    out = np.asarray(numbers, dtype=np.uint64).copy()
    walking = np.arange(len(out))
    while len(walking):
        x = out[walking]
        left, right = x >> half, x & mask
        for k in keys:
            left, right = right, left ^ (mix(right ^ k) & mask)
        out[walking] = (left << half) | right
        walking = walking[out[walking] >= count]
    return out.astype(np.int64)


def _sequences(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[np.ndarray]:
    """The task's tokens, in arrays of TOKENS; the last may be shorter."""
    encode = tokens.Encoder(path)
    held, size = [], 0
    for b in batches:
        for text in b.column(0):
            held.append(encode(text.as_py()))
            size += len(held[-1])
            if size >= 64 * TOKENS:
                ids = np.concatenate(held)
                for at in range(0, size - TOKENS + 1, TOKENS):
                    yield ids[at : at + TOKENS]
                held = [ids[size - size % TOKENS :]]
                size %= TOKENS
    if size:
        ids = np.concatenate(held)
        for at in range(0, size, TOKENS):
            yield ids[at : at + TOKENS]


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = sum(1 for _ in _sequences(batches, path))
        yield pa.RecordBatch.from_pydict({"task": pa.array([TaskContext.get().partitionId()], pa.int32()), "sequences": pa.array([n], pa.int64())})

    return run


def _records(path: str, first: np.ndarray, key: str):
    def rows(begin: int, held: list[np.ndarray]) -> pa.RecordBatch:
        numbers = np.arange(begin, begin + len(held))
        head = np.zeros(len(held), dtype=HEADER)
        head["sequence"], head["tokens"] = numbers, [len(x) for x in held]
        body = [np.concatenate([x, np.full(TOKENS - len(x), tokens.END, np.uint16)]) if len(x) < TOKENS else x for x in held]
        records = [zstandard.compress(h.tobytes() + b.astype("<u2").tobytes(), 1) for h, b in zip(head, body, strict=True)]
        return pa.RecordBatch.from_pydict({"slot": pa.array(permuted(numbers, int(first[-1]), key)), "record": pa.array(records, pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        at, held = int(first[task]), []
        for ids in _sequences(batches, path):
            held.append(ids)
            if len(held) == 256:
                yield rows(at, held)
                at, held = at + len(held), []
        if at + len(held) != first[task + 1]:
            raise RuntimeError("the input changed between counting and writing")
        if held:
            yield rows(at, held)

    return run


def _plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([zstandard.decompress(x) for x in b.column(2).to_pylist()], pa.binary())], names=["shard", "slot", "record"])


def write_shards(docs: DataFrame, path: str, tokenizer: str = tokens.PATH, key: str = KEY, records: int = RECORDS) -> int:
    """Write ``docs`` as shards below ``path``; the number of sequences."""
    texts = docs.select("text")
    counts = {r.task: r.sequences for r in texts.mapInArrow(_count(tokenizer), "task int, sequences long").collect()}  # a row a task
    first = np.concatenate([[0], np.cumsum([counts.get(t, 0) for t in range(max(counts, default=-1) + 1)], dtype=np.int64)])
    total = int(first[-1])
    if total:
        rows = texts.mapInArrow(_records(tokenizer, first, key), "slot long, record binary")
        rows = rows.select(F.floor(F.col("slot") / records).alias("shard"), "slot", "record")
        files = -(-total // records)
        width = min(partitions(docs.sparkSession), files)
        # slots are known to fill range(total): ranges of equal length need no sampling, which would make all tokens once more
        rows = rows.repartitionById(width, F.floor(F.col("shard") * width / files).cast("int"))
        rows = rows.select("shard", "slot", "record").mapInArrow(_plain, "shard long, slot long, record binary")
        # the last sort before the writer: it finds its shards in order and adds no sort of its own, which would lose the slots'
        rows = rows.sortWithinPartitions("shard", "slot").select("shard", F.col("record").cast("string").alias("value"))
        rows.write.partitionBy("shard").option("lineSep", "\n").option("compression", "none").text(path)
    return total


def _read(records: int, total: int | None, key: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                raw = content.as_buffer()
                if raw.size % STRIDE:
                    raise ValueError(f"shard {shard} has a torn record")
                n = raw.size // STRIDE
                head, crc = np.zeros(n, HEADER), np.zeros(n, np.int64)
                view = memoryview(raw)
                for r in range(n):
                    head[r] = np.frombuffer(view, HEADER, 1, r * STRIDE)[0]
                    ids = np.frombuffer(view, "<u2", int(head[r]["tokens"]), r * STRIDE + HEADER.itemsize)
                    crc[r] = zlib.crc32(ids.astype("<u4").tobytes())
                place = np.arange(n)
                if total is not None and not np.array_equal(permuted(head["sequence"], total, key), shard * records + place):
                    raise ValueError(f"shard {shard} has a record at a wrong slot")
                yield pa.RecordBatch.from_pydict(
                    {
                        "slot": pa.array(shard * records + place),
                        "shard": pa.array(np.full(n, shard)),
                        "record": pa.array(place),
                        "sequence": pa.array(head["sequence"].astype(np.int64)),
                        "n_tokens": pa.array(head["tokens"].astype(np.int64)),
                        "ids_crc32": pa.array(crc),
                    }
                )

    return run


_INDEX = "slot long, shard long, record long, sequence long, n_tokens long, ids_crc32 long"


def shard_index(spark: SparkSession, path: str, records: int = RECORDS, total: int | None = None, key: str = KEY) -> DataFrame:
    """What is in the shards below ``path``, read back: a row for each record.
    With ``total`` (all sequences) every record's slot is checked against the permutation."""
    files = spark.read.format("binaryFile").load(path).select(F.col("shard").cast("long").alias("shard"), "content")
    return files.mapInArrow(_read(records, total, key), _INDEX)


def materialised(docs: DataFrame) -> DataFrame:
    """Write ``docs`` to a fresh shared folder; the index of what was written."""
    spark = docs.sparkSession
    path = shared_path(spark, "shards")
    total = write_shards(docs, path)
    if not total:
        return spark.createDataFrame([], _INDEX)
    return shard_index(spark, path, total=total)
