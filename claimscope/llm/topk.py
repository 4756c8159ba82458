"""Exact top-k search by inner product, block at a time.

Vectors become integers, floor(scale * x); a dimension is a term and a vector
a document.  Documents are stored in groups of ranges of ``vec_id``, a group
in blocks, each with its forward index (the vectors) and, for every term, the
largest and the smallest component.  For a query, a block's bound is the sum
over terms of the larger of the two products; blocks are scored in order of
their bounds until these fall below the k-th score so far.

Queries meet the documents in blocks: a chunk of queries is sent to every
group of documents, a group answers with its own top k of each query, and a
second shuffle merges the answers.  A task holds one group and one chunk.

Defined cases: a vector that is null or empty or holds a null or non-finite
component takes no part.  Vectors of different lengths are compared over the
terms that both have.  A null ``vec_id`` takes no part.  Rows that repeat a
``vec_id`` are separate candidates (a query leaves out all rows of its own
id; its repeated rows give repeated answers, told apart by ``query_row``);
ties go to the smaller id.  Other columns are unused.  Vectors whose
squared length (of integers) reaches 2**62 are refused by an error, since scores might not fit in 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimscope.llm.shared import partitions, range_number, stored

SCALE = 64
K = 20
#: Queries are the rows whose id this divides.
EVERY = 20
#: Vectors of a group and of a block; queries of a chunk.
GROUP, BLOCK, CHUNK = 8192, 64, 256

_ROWS = "part long, kind int, chunk long, id long, vector binary"


def integer_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, vector array<long>) of the rows that take part."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x")).where(F.col("vec_id").isNotNull() & (F.size("x") > 0))
    rows = rows.where(F.forall("x", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))))
    # a score is at most the product of two lengths, so it fits in 64 bits if every squared length does
    square = F.aggregate("x", F.lit(0.0), lambda total, x: total + F.pow(F.floor(x * scale), 2))
    refused = F.raise_error(F.lit("a vector is too long for 64-bit scores")).cast("array<bigint>")
    return rows.select("vec_id", F.when(square < 2.0**62, F.transform("x", lambda x: F.floor(x * scale))).otherwise(refused).alias("vector"))


class _Group:
    """A group's blocks: forward index, and extremes of every term."""

    def __init__(self, ids: list[int], vectors: list[np.ndarray], block: int):
        width = max(len(v) for v in vectors)
        x = np.zeros((len(ids), width))
        for i, v in enumerate(vectors):
            x[i, : len(v)] = v
        # ranges of ids, and inside a group's range like with like: bounds get tighter
        strongest = np.abs(x).argmax(axis=1) if width else np.zeros(len(ids), int)
        order = np.lexsort((ids, x[np.arange(len(ids)), strongest], strongest))
        self.ids, self.x = np.array(ids, dtype=np.int64)[order], x[order]
        starts = np.arange(0, len(ids), block)
        self.starts, self.ends = starts, np.append(starts[1:], len(ids))
        self.high = np.maximum.reduceat(self.x, starts)
        self.low = np.minimum.reduceat(self.x, starts)

    def top(self, ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids, scores) of each query's best k here, best first."""
        width = min(queries.shape[1], self.x.shape[1])
        q = queries[:, :width]
        limit = np.abs(q).max(initial=0) * np.abs(self.x).max(initial=0) * max(width, 1)
        if limit >= 2**53:  # beyond what doubles hold exactly
            q, x, high, low = (np.array(a, dtype=object) for a in (q.astype(np.int64), self.x[:, :width].astype(np.int64), self.high[:, :width].astype(np.int64), self.low[:, :width].astype(np.int64)))
        else:
            x, high, low = self.x[:, :width], self.high[:, :width], self.low[:, :width]
        bounds = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
        out = []
        for i in range(len(q)):
            order = np.argsort(-bounds[i], kind="stable")
            best_ids, best = np.zeros(0, np.int64), np.zeros(0, x.dtype)
            at, step = 0, 4
            while at < len(order):
                if len(best) == k:
                    order = order[: at + int(np.count_nonzero(bounds[i][order[at:]] >= best[-1]))]
                taken = order[at : at + step]
                if not len(taken):
                    break
                rows = np.concatenate([np.arange(self.starts[b], self.ends[b]) for b in taken])
                rows = rows[self.ids[rows] != ids[i]]
                found = np.concatenate([best, x[rows] @ q[i]])
                named = np.concatenate([best_ids, self.ids[rows]])
                keep = np.lexsort((named, -found))[:k] if x.dtype != object else np.array(sorted(range(len(found)), key=lambda j: (-found[j], named[j]))[:k], dtype=int)
                best, best_ids = found[keep], named[keep]
                at, step = at + len(taken), step * 2
            out.append((best_ids, best))
        return out


def _matrix(vectors: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(vectors), max((len(v) for v in vectors), default=0)))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


_ANSWERS = "chunk long, answers binary"


def _search(k: int, block: int):
    """Rows in order of part: a group's vectors (kind 0), then query chunks (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, group, ids, vectors = None, None, [], []
        chunk, queries = None, []

        def answer() -> Iterator[pa.RecordBatch]:
            nonlocal queries, group
            if queries and ids:
                group = group or _Group(ids, vectors, block)
                named = np.array([i for i, _ in queries], dtype=np.int64)
                found = group.top(named, _matrix([v for _, v in queries]), k)
                table = [(r, i, s) for r, (a, b) in enumerate(found) for i, s in zip(a.tolist(), b.tolist(), strict=True)]
                if table:
                    row, doc, score = (np.array(c, dtype=np.int64) for c in zip(*[(r, i, int(s)) for r, i, s in table], strict=True))
                    blob = np.stack([row, named[row], doc, score]).tobytes()
                    yield pa.RecordBatch.from_pydict({"chunk": pa.array([chunk], pa.int64()), "answers": pa.array([blob], pa.binary())})
            queries = []

        for b in batches:
            for p, kind, c, i, blob in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if (p, c if kind else None) != (part, chunk) and queries:
                    yield from answer()
                if p != part:
                    part, group, ids, vectors, chunk = p, None, [], [], None
                vector = np.frombuffer(blob, dtype=">i8")
                if kind:
                    chunk = c
                    queries.append((i, vector))
                else:
                    ids.append(i)
                    vectors.append(vector)
        yield from answer()

    return run


def _merge(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def best(parts: np.ndarray) -> np.ndarray:
            row, _, doc, score = parts
            order = np.lexsort((doc, -score, row))
            new = np.ones(len(order), dtype=bool)
            new[1:] = row[order][1:] != row[order][:-1]
            rank = np.arange(len(order)) - np.flatnonzero(new)[np.cumsum(new) - 1]
            return parts[:, order[rank < k]]

        def rows(chunk: int, parts: np.ndarray) -> pa.RecordBatch:
            row, query, doc, score = parts
            rank = np.arange(len(row)) - np.searchsorted(row, row) + 1
            return pa.RecordBatch.from_arrays([pa.array(query), pa.array(rank.astype(np.int32)), pa.array(doc), pa.array(score), pa.array(chunk + row)], names=["query_id", "rank", "vec_id", "score", "query_row"])

        chunk, held = None, None
        for b in batches:
            for c, blob in zip(*(x.to_pylist() for x in b.columns), strict=True):
                parts = np.frombuffer(blob, np.int64).reshape(4, -1)
                if c != chunk:
                    if held is not None:
                        yield rows(chunk, held)
                    chunk, held = c, best(parts)
                else:
                    held = best(np.concatenate([held, parts], axis=1))
        if held is not None:
            yield rows(chunk, held)

    return run


def search(vectors: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE, group: int = GROUP, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best candidates of every
    row whose ``vec_id`` ``every`` divides, itself left out."""
    spark = vectors.sparkSession
    # a vector travels as bytes: eight for each component, big-endian
    packed = F.unhex(F.array_join(F.transform("vector", lambda v: F.lpad(F.hex(v), 16, "0")), ""))
    rows = stored(integer_vectors(vectors, scale).select("vec_id", packed.alias("vector")), "vectors")
    groups = max(1, -(-rows.count() // group))
    shares = [(i + 1) / groups for i in range(groups - 1)]
    bounds = sorted(set(rows.agg(F.percentile_approx("vec_id", shares, max(10_000, 20 * groups))).first()[0])) if shares else []
    part = range_number(F.col("vec_id"), bounds).cast("long")
    docs = rows.select(part.alias("part"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("chunk"), F.col("vec_id").alias("id"), "vector")

    queries = rows.where(F.col("vec_id") % every == 0)
    n = max(1, -(-queries.count() // chunk))
    dealt = queries.withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.lit(n)) * (1 << 32))
    to_all = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(len(bounds)).cast("long")))
    sent = dealt.select(to_all.alias("part"), F.lit(1).alias("kind"), "chunk", F.col("vec_id").alias("id"), "vector")

    width = max(partitions(spark), 1)
    met = docs.unionByName(sent).repartition(width, "part").sortWithinPartitions("part", "kind", "chunk", "id", "vector")
    answers = met.mapInArrow(_search(k, block), _ANSWERS)
    merged = answers.repartition(width, "chunk").sortWithinPartitions("chunk")
    return merged.mapInArrow(_merge(k), "query_id long, rank int, vec_id long, score long, query_row long")
