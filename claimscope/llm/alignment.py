"""Alignment of two tokenizers' tokens over the same texts.

Side A is a byte-level BPE (of a space and the text), side B a sentencepiece
model (of the text; it adds the space itself).  Both sides' tokens are byte
ranges of space + text.  In every batch ``pandas.merge_asof``, keyed by
document, finds for each token's start the covering token of the other side;
the union of both directions is all pairs that overlap.  Where the two of a
pair end together, both sides have a boundary: the pair is a link, and the
boundaries cut the tokens into groups.

Corpus-wide counts of linked id pairs are summed in Spark after a sum in each
task.  A pair is linked only if one token's bytes end with the other's, so there
are at most as many pairs as the two vocabularies have bytes
(``most_pairs``, some 10**6), whatever the corpus: the counts may be broadcast.

Defined cases: a text that is null or empty, or whose tokens' joined bytes on
either side differ from space + text (sentencepiece maps some characters), has
no tokens; strings of special tokens are plain text; rows and ids that repeat
count again; a null doc_id stays; other columns are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimscope.llm import tokens
from claimscope.llm.shared import rows_of, stored

PATH_A = tokens.PATH
PATH_B = public_tokenizers.path("piece_bpe_32k.model")
#: Bytes of text aligned at once (or one text).
BATCH = 1 << 20
_MARK = "▁"
_TEXT = pa.large_string()


class SideA:
    def __init__(self, path: str):
        self._encode = tokens.plain_encoder(path)
        self.bytes = tokens.vocabulary(path)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return [self._encode(" " + t) for t in texts]


class SideB:
    def __init__(self, path: str):
        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = map(self._model.id_to_piece, range(self._model.get_piece_size()))
        self.bytes = [bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") and p.endswith(">") else p.replace(_MARK, " ").encode() for p in pieces]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int64) for ids in self._model.encode(texts, num_threads=1)]


class Widths:
    """The bytes of a vocabulary's ids, end to end."""

    def __init__(self, table: list[bytes]):
        self.of = np.array(list(map(len, table)), np.int64)
        self._first = np.cumsum(self.of) - self.of
        self._bytes = np.frombuffer(b"".join(table), np.uint8)

    def joined(self, ids: np.ndarray) -> bytes:
        widths = self.of[ids]
        ends = np.cumsum(widths)
        return self._bytes[np.repeat(self._first[ids] - ends + widths, widths) + np.arange(ends[-1] if len(ends) else 0)].tobytes()


@lru_cache(maxsize=1)
def _sides(path_a: str, path_b: str) -> tuple[SideA, SideB, Widths, Widths]:
    a, b = SideA(path_a), SideB(path_b)
    return a, b, Widths(a.bytes), Widths(b.bytes)


def most_pairs(path_a: str = PATH_A, path_b: str = PATH_B) -> int:
    """No more id pairs than this can be linked: one's bytes are a suffix of the other's."""
    return sum(int(x.of.sum()) for x in _sides(path_a, path_b)[2:])


def _frame(ids: list[np.ndarray], widths: np.ndarray) -> pd.DataFrame:
    """Tokens of the texts, in order: text, id, start and end byte (over all texts, end to end)."""
    counts = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.concatenate([*ids, np.zeros(0, np.int64)]).astype(np.int64)
    ends = np.cumsum(widths[flat])
    return pd.DataFrame({"text": np.repeat(np.arange(len(ids)), counts), "id": flat, "start": ends - widths[flat], "end": ends, "token": np.arange(len(flat))})


def _covering(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """For each token of one side the other side's that covers its start, in the same text."""
    other = right[["start", "text", "end", "token"]].rename(columns={"end": "other_end", "token": "other"})
    other["other_start"] = other["start"]
    return pd.merge_asof(left[["start", "text", "end", "token"]], other, on="start", by="text")


def _pairs(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """All pairs that overlap, once each: a's token, b's token, a's end, b's end."""
    ab, ba = _covering(a, b), _covering(b, a)
    ba = ba[ba["start"].to_numpy() != ba["other_start"].to_numpy()]  # those that start together are in ab
    both = (("token", "other"), ("other", "token"), ("end", "other_end"), ("other_end", "end"))
    return tuple(np.concatenate([ab[x].to_numpy(np.int64), ba[y].to_numpy(np.int64)]) for x, y in both)


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """All pairs (a's token, b's token) whose ranges overlap, and where each ends; both sides in order of start."""
    found = pd.DataFrame(dict(zip(("a", "b", "a_end", "b_end"), _pairs(a, b), strict=True)))
    return found.sort_values(["a", "b"], ignore_index=True)


def _joined(ids: np.ndarray, ends: np.ndarray, groups: int) -> pa.Array:
    """For each group its decimal ids with commas; ``ends``: number of ids up to a group's end."""
    strings = pa.array(ids).cast(_TEXT)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), strings), pa.scalar(",", _TEXT)) if groups else pa.array([], _TEXT)


class Aligned:
    """The tokens of a batch of texts and how they lie to each other."""

    def __init__(self, texts: list[str | None], path_a: str, path_b: str):
        side_a, side_b, width_a, width_b = _sides(path_a, path_b)
        some = [t or "" for t in texts]
        ids_a, ids_b = side_a(some), side_b(some)
        none = np.zeros(0, np.int64)
        for i, text in enumerate(some):
            whole = (" " + text).encode()
            if not text or width_a.joined(ids_a[i]) != whole or width_b.joined(ids_b[i]) != whole:
                ids_a[i] = ids_b[i] = none
        self.a, self.b = _frame(ids_a, width_a.of), _frame(ids_b, width_b.of)
        self.texts = len(texts)
        a, b, a_end, b_end = _pairs(self.a, self.b)
        together = np.flatnonzero(a_end == b_end)
        together = together[np.lexsort((b[together], a[together]))]
        self.link_a, self.link_b, link_end = a[together], b[together], a_end[together]
        self.link_text = self.a["text"].to_numpy()[self.link_a]
        # a group ends with the last tokens that end at its boundary
        last = np.ones(len(together), bool)
        last[:-1] = link_end[1:] != link_end[:-1]
        self.group_a, self.group_b, self.group_text = self.link_a[last], self.link_b[last], self.link_text[last]

    def per_text(self, of: np.ndarray) -> np.ndarray:
        return np.bincount(of, minlength=self.texts)

    def groups(self) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of each text ('' without tokens)."""
        n = len(self.group_text)
        parts_a, parts_b = _joined(self.a["id"].to_numpy(), self.group_a + 1, n), _joined(self.b["id"].to_numpy(), self.group_b + 1, n)
        both = pc.binary_join_element_wise(parts_a, parts_b, pa.scalar("|", _TEXT))
        ends = np.concatenate([[0], np.cumsum(self.per_text(self.group_text))])
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), both), pa.scalar(";", _TEXT)).to_pylist()


_ROWS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary"
_LINKS = np.dtype([("a", "<u4"), ("b", "<u4")])


def _aligning(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in rows_of(batches, BATCH):
            found = Aligned(rows["text"].to_pylist(), path_a, path_b)
            links = np.zeros(len(found.link_a), _LINKS)
            links["a"], links["b"] = found.a["id"].to_numpy()[found.link_a], found.b["id"].to_numpy()[found.link_b]
            n_links = found.per_text(found.link_text)
            ends = np.cumsum(n_links)
            # one column after the other compresses better than pairs
            blobs = [zstandard.compress(links["a"][e - n : e].tobytes() + links["b"][e - n : e].tobytes(), 1) if n else None for e, n in zip(ends.tolist(), n_links.tolist(), strict=True)]
            digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in found.groups()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays(rows["doc_id"].chunks),
                    *(pa.array(found.per_text(x).astype(np.int64)) for x in (found.a["text"].to_numpy(), found.b["text"].to_numpy(), found.group_text, found.link_text)),
                    pa.array(digests, pa.string()),
                    pa.array(blobs, pa.binary()),
                ],
                names=[c.split()[0] for c in _ROWS.split(", ")],
            )

    return run


def align(docs: DataFrame, path_a: str = PATH_A, path_b: str = PATH_B) -> DataFrame:
    """doc_id, numbers of tokens, groups and links, digest of the groups, and the linked ids (``links``, packed)."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_aligning(path_a, path_b), _ROWS)


def _pairs_of(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    a, b = np.frombuffer(zstandard.decompress(blob), "<u4").reshape(2, -1)
    return a.astype(np.int64), b.astype(np.int64)


#: Links whose pairs are counted at once.
LINKS = 1 << 19


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's linked pairs with their numbers: no more rows than there can be pairs."""
    none = np.zeros(0, np.int64)
    keys, total, held, size = none, none, [], 0

    def merge() -> None:
        nonlocal keys, total, held, size
        pairs = np.concatenate([keys, *held])
        weights = np.concatenate([total, np.ones(size, np.int64)])
        order = np.argsort(pairs, kind="stable")
        pairs = pairs[order]
        first = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]])) if len(pairs) else none
        keys, total = pairs[first], np.add.reduceat(weights[order], first) if len(first) else none
        held, size = [], 0

    for batch in batches:
        for blob in batch.column(0):
            if blob.is_valid:
                a, b = _pairs_of(blob.as_buffer())
                held.append(a << 32 | b)
                size += len(a)
                if size >= LINKS:
                    merge()
    merge()
    yield pa.RecordBatch.from_arrays([pa.array(keys >> 32), pa.array(keys & 0xFFFFFFFF), pa.array(total)], names=["a", "b", "n"])


def pair_counts(aligned: DataFrame) -> DataFrame:
    """a, b, n: how many links of the corpus hold the two ids; best: whether no other a has more for this b."""
    counts = aligned.select("links").mapInArrow(_count, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(most, "b").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


_SCORED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _scoring(counts):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, best = counts.value
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            sums, bests = [], []
            for blob in batch.column(batch.schema.get_field_index("links")):
                a, b = _pairs_of(blob.as_buffer()) if blob.is_valid else (np.zeros(0, np.int64),) * 2
                at = np.searchsorted(keys, a << 32 | b)
                sums.append(int(n[at].sum()))
                bests.append(int(best[at].sum()))
            kept = {c: rows[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
            kept |= {"n_best": pa.array(bests, pa.int64()), "count_sum": pa.array(sums, pa.int64())}
            yield from pa.table({c.split()[0]: kept[c.split()[0]] for c in _SCORED.split(", ")}).to_batches()

    return run


def alignment_digest(docs: DataFrame, path_a: str = PATH_A, path_b: str = PATH_B) -> DataFrame:
    """A row for each document: ``align`` with n_best (links that are their B id's
    commonest, ties included) and count_sum (over links, the pair's corpus-wide count)."""
    spark = docs.sparkSession
    aligned = stored(align(docs, path_a, path_b), "aligned")  # tokens are made once; links are packed ids
    counts = pair_counts(aligned).toArrow()
    if counts.num_rows > most_pairs(path_a, path_b):
        raise RuntimeError("more linked pairs than the vocabularies allow")
    a, b, n = (counts[c].to_numpy() for c in ("a", "b", "n"))
    order = np.argsort(a << 32 | b)
    shared = spark.sparkContext.broadcast(((a << 32 | b)[order], n[order], counts["best"].to_numpy(zero_copy_only=False)[order]))
    return aligned.mapInArrow(_scoring(shared), _SCORED)
