"""Quality classifier: nearest-neighbour voting in a latent-semantic space.

Terms are shapes, not words, so that the model reads any language: trigrams
of character classes with runs collapsed (each common ASCII mark is a class
of its own), and how often a word repeats the one before it, the one before
that, or any earlier word.  Frequencies are square-rooted and weighted by
inverse document frequency over all documents.  A truncated SVD of labelled
documents gives the latent space; labelled vectors (at most ``SAMPLE``) go to
every task, which computes all cosines of its documents in blocks.  The
``NEIGHBOURS`` nearest vote, weighted by a power of their similarity.

Only the fit looks at a sample: the ``SAMPLE`` labelled rows that a digest
of their doc_id puts first.  Rows whose crc32(doc_id as text) mod 4 is 2 are
held out of it.

Defined cases: a text without terms (null, empty, white space) scores the
share of good labels in the sample; without any labelled row every score is
0.5.  Rows are scored one by one, so repeated rows and null ids score like
any other; a null doc_id is not held out.  ``good_documents`` keeps all
columns whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimscope.llm import hashing
from claimscope.llm.shared import rows_of, stored

#: Labelled rows in the model at most.
SAMPLE = 4000
DIMENSIONS = 32
NEIGHBOURS = 15
SHARPNESS = 8
THRESHOLD = 0.7
BATCH_BYTES, BATCH_ROWS = 2 << 20, 1024

_MARKS = b".,!|#$%&*"
CLASSES = 16
_CLASS = np.full(256, 15, dtype=np.uint16)  # other marks and control characters
_CLASS[128:] = 2  # letters beyond ASCII are most of these
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 2, 3, 4
_CLASS[[0x20, 0x09]], _CLASS[[0x0A, 0x0B, 0x0C, 0x0D]] = 0, 1
_CLASS[list(_MARKS)] = np.arange(5, 5 + len(_MARKS))
#: Repeats of the last word, of the last but one, of any earlier one; words that repeat none.
REPEATS = 4
TERMS = CLASSES**3 + REPEATS


def term_rows(texts: list[bytes]) -> np.ndarray:
    """Square-rooted term frequencies of each text, dense."""
    out = np.zeros((len(texts), TERMS), dtype=np.float32)
    for i, text in enumerate(texts):
        if not text:
            continue
        kinds = _CLASS[np.frombuffer(text, np.uint8)]
        runs = kinds[np.concatenate([[True], kinds[1:] != kinds[:-1]])].astype(np.int64)
        if len(runs) > 2:
            grams = (runs[:-2] * CLASSES + runs[1:-1]) * CLASSES + runs[2:]
            out[i, : CLASSES**3] = np.sqrt(np.bincount(grams, minlength=CLASSES**3) / len(grams))
    w = hashing.words(texts)
    for i in range(len(texts)):
        h = w.hashes[w.offsets[i] : w.offsets[i + 1]]
        if len(h):
            once, twice = int((h[1:] == h[:-1]).sum()), int((h[2:] == h[:-2]).sum())
            distinct = len(np.unique(h))
            out[i, CLASSES**3 :] = np.sqrt(np.array([once, twice, len(h) - distinct, distinct]) / len(h))
    return out


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string").cast("binary")) % 4 == 2, F.lit(False))


class Model(NamedTuple):
    weights: np.ndarray  # inverse document frequency
    space: np.ndarray  # terms x dimensions
    vectors: np.ndarray  # labelled rows, unit length
    labels: np.ndarray

    def project(self, terms: np.ndarray) -> np.ndarray:
        latent = _unit(terms * self.weights) @ self.space
        return _unit(latent)

    def score(self, terms: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(terms), 0.5)
        cosines = self.project(terms) @ self.vectors.T
        k = min(NEIGHBOURS, len(self.labels))
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        votes = np.maximum(np.take_along_axis(cosines, near, axis=1), 0).astype(np.float64) ** SHARPNESS
        total = votes.sum(axis=1)
        good = (votes * self.labels[near]).sum(axis=1)
        # rounded: the last bits depend on how rows are batched
        return np.round(np.where(total > 0, good / np.where(total > 0, total, 1), self.labels.mean()), 5)


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return (x / np.where(norm > 0, norm, 1)).astype(np.float32)


def _svd(x: np.ndarray, k: int) -> np.ndarray:
    """Leading right singular vectors, by subspace iteration."""
    basis = np.random.default_rng(0).standard_normal((x.shape[1], min(k + 8, *x.shape))).astype(np.float32)
    for _ in range(6):
        basis, _ = np.linalg.qr(x.T @ (x @ basis))
    _, _, right = np.linalg.svd(x @ basis, full_matrices=False)
    return (basis @ right.T)[:, :k]


def _texts(table: pa.Table) -> list[bytes]:
    return [(x or "").encode() for x in table.column("text").to_pylist()]


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each term, over all documents of the task; and the terms of labelled rows."""
    count, total = np.zeros(TERMS, np.int64), 0
    for table in rows_of(batches, BATCH_BYTES, most=BATCH_ROWS):
        terms = term_rows(_texts(table))
        count += (terms > 0).sum(axis=0)
        total += len(terms)
        quality = table.column("quality").to_pylist()
        mine = [i for i, q in enumerate(quality) if q is not None]
        if mine:
            blobs = [zstandard.compress(terms[i].tobytes(), 1) for i in mine]
            none = pa.nulls(len(mine), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, pa.array(blobs, pa.binary()), pa.array([quality[i] for i in mine], pa.int32())], names=["term", "documents", "vector", "quality"])
    if total:
        seen = np.append(np.flatnonzero(count), TERMS)  # term TERMS: all documents
        none = pa.nulls(len(seen))
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(np.append(count, total)[seen]), none.cast(pa.binary()), none.cast(pa.int32())], names=["term", "documents", "vector", "quality"])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, dimensions: int = DIMENSIONS) -> Model:
    """Statistics over all documents; the space and the neighbours from at most ``sample`` labelled rows."""
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(F.min("quality").cast("int").alias("quality"))
    chosen = stored(usable.orderBy(F.md5(F.col("label_id").cast("string"))).limit(sample), "labelled")
    read = docs.select("text", F.col("doc_id").cast("long").alias("doc_id")).join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"), "left")
    gathered = stored(read.select("text", "quality").mapInArrow(_gather, "term long, documents long, vector binary, quality int"), "terms")

    counts = np.zeros(TERMS + 1, dtype=np.float64)
    for r in gathered.where("term is not null").groupBy("term").agg(F.sum("documents").alias("n")).collect():
        counts[r.term] = r.n
    # rows of one doc_id in the documents would exceed the bound: one each
    rows = gathered.where("vector is not null").orderBy(F.md5("vector"), "quality").limit(sample).collect()
    weights = np.log((1 + counts[-1]) / (1 + counts[:-1])).astype(np.float32) + 1
    if not rows:
        return Model(weights, np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0))
    terms = np.stack([np.frombuffer(zstandard.decompress(r.vector), np.float32) for r in rows])
    space = _svd(_unit(terms * weights), dimensions)
    model = Model(weights, space, np.zeros((0, 1), np.float32), np.array([r.quality for r in rows], dtype=np.float64))
    return model._replace(vectors=model.project(terms))


def _scores(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in rows_of(batches, BATCH_BYTES, most=BATCH_ROWS):
            score = pa.array(model.score(term_rows(_texts(table))), pa.float64())
            yield from table.append_column("score", score).drop_columns(["text"]).combine_chunks().to_batches()

    return run


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    model = fit(docs, labels)
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scores(model), "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are predicted to be good."""
    model = fit(docs, labels)
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in rows_of(batches, BATCH_BYTES, most=BATCH_ROWS):
            keep = pa.array(model.score(term_rows(_texts(table))) >= THRESHOLD)
            yield from table.filter(keep).combine_chunks().to_batches()

    return docs.mapInArrow(run, schema)
