"""Cost-balanced packing of documents into training sequences.

A piece of n tokens costs ``LINEAR * n + QUADRATIC * n**2`` (attention inside
its document).  Every map task packs what it reads, block by block: pieces in
descending order go to the sequence of lowest cost that has room for them; a
piece that fits nowhere whole fills the cheapest sequence with room and its
rest goes on.  A block has just as many sequences as its tokens need, so at
most one sequence of padding is lost for ``BLOCK_TOKENS`` tokens (or ``BLOCK_ROWS`` documents), and nothing
is shuffled.

Documents longer than a sequence are first cut into whole sequences and a
rest.  Defined cases: null or empty text is one token (END); rows with one
``doc_id`` and null ids are packed like any other row; other columns are
unused; an empty table gives no pieces.  Sequence ids are unique, not dense.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimscope.llm import tokens

CAPACITY = 2048
#: Relative cost of a token and of a pair of tokens of one piece: at about 4,000 tokens attention costs as much as the rest.
LINEAR, QUADRATIC = 1.0, 1.0 / 4096
#: Tokens that a task packs together, about 12 MB; the last block of a task is smaller.
BLOCK_TOKENS = 6_000_000
#: Documents of a block at most (short ones are few tokens, but rows all the same).
BLOCK_ROWS = 200_000

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def cost(length):
    return LINEAR * length + QUADRATIC * np.square(length, dtype=np.float64)


def assign(lengths: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Pieces (item, start, length, sequence, offset) of items of at most ``capacity`` tokens."""
    count = -(-int(lengths.sum()) // capacity)
    room, spent, out = np.full(count, capacity), np.zeros(count), []
    order = np.argsort(-lengths, kind="stable")
    whole = order[lengths[order] == capacity]
    for at, item in enumerate(whole.tolist()):
        out.append((item, 0, capacity, at, 0))
    room[: len(whole)] = 0
    # only sequences with room are looked at; they are dropped, now and then, when full
    live, left, costs = np.arange(len(whole), count), room[len(whole) :].copy(), spent[len(whole) :].copy()
    full = 0
    for item in order[len(whole) :].tolist():
        start, rest = 0, int(lengths[item])
        while rest:
            fits = np.where(left >= rest, costs, np.inf)
            at = int(fits.argmin())
            if fits[at] == np.inf:
                at = int(np.where(left > 0, costs, np.inf).argmin())
            take = min(rest, int(left[at]))
            out.append((item, start, take, int(live[at]), capacity - int(left[at])))
            left[at] -= take
            costs[at] += cost(take)
            start, rest = start + take, rest - take
            if not left[at]:
                full += 1
                if full * 4 > len(live):
                    keep = left > 0
                    live, left, costs, full = live[keep], left[keep], costs[keep], 0
    return out


def _packed(path: str, capacity: int, block_rows: int):
    def block(documents: list[tuple[int | None, np.ndarray]], first: int) -> tuple[pa.RecordBatch, int]:
        items = [(d, s) for d, (_, ids) in enumerate(documents) for s in range(0, len(ids), capacity)]
        lengths = np.array([min(capacity, len(documents[d][1]) - s) for d, s in items])
        rows = []
        for item, start, length, sequence, offset in assign(lengths, capacity):
            d, s = items[item]
            doc_id, ids = documents[d]
            piece = ids[s + start : s + start + length].astype("<u4")
            rows.append((doc_id, s + start, length, zlib.crc32(piece.tobytes()), len(ids), first + sequence, offset))
        columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays(columns, names=names), first + 1 + max(r[5] - first for r in rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.Encoder(path)
        following = TaskContext.get().partitionId() << 32
        held, size = [], 0
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids = encode(text.as_py())
                held.append((doc_id, ids))
                size += len(ids)
                if size >= BLOCK_TOKENS or len(held) >= block_rows:
                    out, following = block(held, following)
                    yield out
                    held, size = [], 0
        if held:
            yield block(held, following)[0]

    return run


def pack(docs: DataFrame, path: str = tokens.PATH, capacity: int = CAPACITY, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_packed(path, capacity, block_rows), SCHEMA)
