"""Substring dedup: repeated word windows, merged into removal spans.

Every window of ``size`` consecutive words gets a Rabin-Karp hash.  A window
is repeated when the same word sequence also starts in a document with a
smaller ``doc_id``; the spans to remove are the maximal unions of repeated
windows.  Windows are judged on the input, not on what is left of it.

Plan: each map task hashes its documents in batches of bounded size.  Within
a batch equal hashes meet first: only the occurrences in the smallest
document of the batch need a global answer, so a window that a third of all
documents share is sent once per batch.  What is sent goes, packed, to a
bucket by hash (first shuffle); a bucket answers with the window numbers that
also start in a smaller document of another batch; the answers return to
their batch (second, small shuffle) and become spans.

Defined cases: null or empty text has no words and no spans.  A null
``doc_id`` counts as larger than all others.  Rows with the same ``doc_id``
never count against each other; identical rows get identical spans.  Columns
other than ``doc_id`` and ``text`` play no part and are kept by
``remove_repeats`` whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimscope.llm import hashing
from claimscope.llm.shared import NULL_ID, ascending, from_ascending, partitions, rows_of

#: Words in a window.
WINDOW = 50
#: Bytes of text that a map task hashes at once.
BATCH_BYTES = 4 << 20
#: Buckets of hashes for each shuffle partition; one bucket is held at a time.
BUCKETS_PER_PARTITION = 4

_POSTINGS = "bucket int, batch long, hashes binary, windows binary, ids binary, directory binary"
_ANSWERS = "batch long, windows binary, directory binary"
_SPANS = "doc_id long, text_md5 binary, n_words int, starts array<int>, ends array<int>"


def _pack_directory(ids: np.ndarray, keys: list[bytes], words: np.ndarray, own: np.ndarray) -> bytes:
    parts = [np.int64(len(ids)).tobytes(), ids.tobytes(), b"".join(keys), words.astype(np.int64).tobytes(), np.packbits(own).tobytes()]
    return zstandard.compress(b"".join(parts), 1)


def _unpack_directory(blob: bytes) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
    raw = zstandard.decompress(blob)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    ids = np.frombuffer(raw, np.int64, n, 8)
    at = 8 + 8 * n
    keys = [raw[at + 16 * i : at + 16 * i + 16] for i in range(n)]
    words = np.frombuffer(raw, np.int64, n, at + 16 * n)
    return ids, keys, words, np.unpackbits(np.frombuffer(raw, np.uint8, offset=at + 24 * n)).astype(bool)


def _hash_windows(size: int, buckets: int):
    """Map side: one directory row a batch, and a posting row a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for number, table in enumerate(rows_of(batches, BATCH_BYTES)):
            batch = (task << 32) | number
            ids = np.array([NULL_ID if x is None else x for x in table.column("doc_id").to_pylist()], dtype=np.int64)
            texts = [(x or "").encode() for x in table.column("text").to_pylist()]
            order = np.argsort(ids, kind="stable")
            ids, texts = ids[order], [texts[i] for i in order]
            words = hashing.words(texts)
            w = hashing.windows(words, size)
            by_hash = np.argsort(w.hashes, kind="stable")  # documents ascend within equal hashes
            sorted_hashes, owner = w.hashes[by_hash], ids[w.text[by_hash]]
            first = np.ones(len(by_hash), dtype=bool)
            first[1:] = sorted_hashes[1:] != sorted_hashes[:-1]
            repeated = np.zeros(len(by_hash), dtype=bool)
            if len(by_hash):
                repeated[by_hash] = owner > owner[first][np.cumsum(first) - 1]
            keys = [hashlib.md5(x).digest() for x in texts]
            directory = _pack_directory(ids, keys, np.diff(words.offsets), repeated)
            sent = np.flatnonzero(~repeated)
            target = (w.hashes[sent] % np.uint64(buckets)).astype(np.int64)
            sent = sent[np.argsort(target, kind="stable")]
            cuts = np.concatenate([[0], np.cumsum(np.bincount(target, minlength=buckets))])
            full = np.flatnonzero(np.diff(cuts))
            rows = [sent[cuts[b] : cuts[b + 1]] for b in full]
            yield pa.RecordBatch.from_pydict(
                {
                    "bucket": pa.array([*full.tolist(), batch % buckets], pa.int32()),
                    "batch": pa.array([batch] * (len(rows) + 1), pa.int64()),
                    "hashes": pa.array([*(w.hashes[r].tobytes() for r in rows), None], pa.binary()),
                    "windows": pa.array([*(ascending(r) for r in rows), None], pa.binary()),
                    "ids": pa.array([*(ascending(ids[w.text[r]]) for r in rows), None], pa.binary()),
                    "directory": pa.array([*[None] * len(rows), directory], pa.binary()),
                }
            )

    return run


def _answer(table: pa.Table) -> pa.Table:
    """One bucket: which windows also start in a smaller document?"""
    rows = table.to_pydict()
    at = [i for i, h in enumerate(rows["hashes"]) if h is not None]
    out = [(rows["batch"][i], None, d) for i, d in enumerate(rows["directory"]) if d is not None]
    if at:
        hashes = np.concatenate([np.frombuffer(rows["hashes"][i], np.uint64) for i in at])
        ids = np.concatenate([from_ascending(rows["ids"][i]) for i in at])
        counts = np.array([len(rows["hashes"][i]) // 8 for i in at])
        order = np.lexsort((ids, hashes))
        first = np.ones(len(order), dtype=bool)
        first[1:] = hashes[order][1:] != hashes[order][:-1]
        smallest = ids[order][first][np.cumsum(first) - 1]
        repeated = np.zeros(len(order), dtype=bool)
        repeated[order] = ids[order] > smallest
        for i, part in zip(at, np.split(repeated, np.cumsum(counts)[:-1]), strict=True):
            if part.any():
                out.append((rows["batch"][i], ascending(from_ascending(rows["windows"][i])[part]), None))
    batch, windows, directory = zip(*out, strict=True) if out else ((), (), ())
    return pa.table({"batch": pa.array(batch, pa.int64()), "windows": pa.array(windows, pa.binary()), "directory": pa.array(directory, pa.binary())})


def _merge(size: int):
    """One batch: repeated windows of its documents as maximal spans."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pydict()
        ids, keys, words, bits = _unpack_directory(next(d for d in rows["directory"] if d is not None))
        per = np.maximum(words - size + 1, 0)
        begin = np.concatenate([[0], np.cumsum(per)])
        repeated = bits[: begin[-1]].copy()
        for blob in rows["windows"]:
            if blob is not None:
                repeated[from_ascending(blob)] = True
        at = np.flatnonzero(repeated)
        text = np.searchsorted(begin, at, side="right") - 1
        start = at - begin[text]
        new = np.ones(len(at), dtype=bool)
        new[1:] = (text[1:] != text[:-1]) | (start[1:] > start[:-1] + size)
        last = np.append(new[1:], True)[: len(at)]
        owner, starts, ends = text[new], start[new], start[last] + size
        docs, cut = np.unique(owner, return_index=True)
        offsets = pa.array(np.append(cut, len(owner)), pa.int32())
        return pa.table(
            {
                "doc_id": pa.array([None if ids[i] == NULL_ID else int(ids[i]) for i in docs], pa.int64()),
                "text_md5": pa.array([keys[i] for i in docs], pa.binary()),
                "n_words": pa.array(words[docs], pa.int32()),
                "starts": pa.ListArray.from_arrays(offsets, pa.array(starts, pa.int32())),
                "ends": pa.ListArray.from_arrays(offsets, pa.array(ends, pa.int32())),
            }
        )

    return run


def repeated_spans(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """Spans to remove: one row for each document that has any.

    Columns: ``doc_id``, ``text_md5`` (tells rows of one id apart),
    ``n_words``, and ``starts`` / ``ends``: word spans [start, end), disjoint,
    ascending and maximal.
    """
    buckets = BUCKETS_PER_PARTITION * partitions(docs.sparkSession)
    postings = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_hash_windows(size, buckets), _POSTINGS)
    answers = postings.groupBy("bucket").applyInArrow(_answer, _ANSWERS)
    return answers.groupBy("batch").applyInArrow(_merge(size), _SPANS).dropDuplicates(["doc_id", "text_md5"])


def with_spans(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` as one struct ``row`` each, with its span columns (null: none)."""
    spans = repeated_spans(docs, size).select(F.col("doc_id").alias("span_id"), F.col("text_md5").alias("span_md5"), "starts", "ends")
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.col("doc_id").cast("long").alias("own_id"),
        F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("own_md5"),
    )
    on = F.col("own_id").eqNullSafe(F.col("span_id")) & (F.col("own_md5") == F.col("span_md5"))
    return rows.join(spans, on, "left").select("row", "starts", "ends")


def kept_words(text: str | None, starts, ends) -> tuple[int, list[bytes]]:
    """Number of words, and the words outside the spans."""
    words = (text or "").encode().split()
    n = len(words)
    for s, e in zip(reversed(starts), reversed(ends), strict=True):
        del words[s:e]
    return n, words


def remove_repeats(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` with repeated spans cut from ``text``.

    Texts without repeats stay as they are, to the byte; in the others the
    kept words are joined by one space.  All columns and rows stay.
    """
    schema = docs.schema
    joined = with_spans(docs, size).select("row.text", "starts", "ends", "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(0).to_pylist()
            starts, ends = b.column(1).to_pylist(), b.column(2).to_pylist()
            new = [t if s is None else b" ".join(kept_words(t, s, e)[1]).decode() for t, s, e in zip(texts, starts, ends, strict=True)]
            row = b.column(3)
            fields = [pa.array(new, pa.string()) if f.name == "text" else row.field(i) for i, f in enumerate(row.type)]
            yield pa.RecordBatch.from_arrays(fields, names=[f.name for f in row.type])

    return joined.mapInArrow(run, schema)


def dedup_digest(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and the spans of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            starts, ends = (pc.fill_null(b.column(i), pa.scalar([], b.column(i).type)) for i in (2, 3))
            kept = [kept_words(t, s, e) for t, s, e in zip(b.column(1).to_pylist(), starts.to_pylist(), ends.to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    pa.array([n for n, _ in kept], pa.int64()),
                    pa.array([n - len(w) for n, w in kept], pa.int64()),
                    pa.array([hashlib.sha256(b" ".join(w)).hexdigest() for _, w in kept], pa.string()),
                    starts,
                    ends,
                ],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "span_starts", "span_ends"],
            )

    joined = with_spans(docs.select(F.col("doc_id").cast("long"), "text"), size).select("row.doc_id", "row.text", "starts", "ends")
    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string, span_starts array<int>, span_ends array<int>")
