"""Document fingerprints: SpotSigs.

An anchor is a common word of the text's language (articles, prepositions,
pronouns and auxiliaries of four languages).  Each anchor, with the chain of
``CHAIN`` content words that follow it, is a spot; a document's fingerprint is
the set of its spots' 32-bit signatures.  A text without an anchor takes the
chains that begin at each of its words; one without words but not empty is
its own spot.  Words are runs of ASCII letters, digits and bytes beyond
ASCII, A-Z in lower case.

Likeness is the Jaccard coefficient of two fingerprints.  Two sets whose
lengths differ by more than the likeness asked for allows need no comparison:
``length_class`` gives ranges such that only equal or adjacent classes can
reach it, and ``likeness`` returns 0 for a pair that its lengths rule out.

Defined cases: null and empty texts have the empty fingerprint; two empty
fingerprints are alike (1), an empty and another are not (0).  Documents are
ordered by ``doc_id`` (null first), equal ids by text; the last one's next is
the first; a single document is its own next.  Other columns are unused.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimscope.llm import hashing
from claimscope.llm.shared import partitions, range_number, stored

CHAIN = 3
BATCH_BYTES = 2 << 20
#: Ranges of doc_id for each shuffle partition.
BLOCKS_PER_PARTITION = 2

# Anchors.
ANCHORS = (
    "a an the and or of to in on at by for from with as is are was were be been has have had that this these those it he she they we you not but which who will would can could do does did there"
    " der die das den dem des ein eine einer und oder von zu im in auf an bei für aus mit als ist sind war waren sein hat haben hatte dass dies es er sie wir nicht aber auch nach über"
    " le la les un une des du de et ou à en sur au aux par pour dans avec comme est sont était être a ont que qui ce cette il elle ils nous ne pas mais"
    " el los las una y o del al por para con como es son era ser ha han lo se su no pero más"
)

_BETWEEN = np.ones(256, dtype=bool)
_BETWEEN[128:] = _BETWEEN[48:58] = _BETWEEN[65:91] = _BETWEEN[97:123] = False


def _anchor_hashes() -> np.ndarray:
    return np.unique(hashing.words([ANCHORS.encode()], lower=True, between=_BETWEEN).hashes)


def fingerprints(texts: list[str | None], anchors: np.ndarray | None = None, chain: int = CHAIN) -> list[np.ndarray]:
    """The signature set of each text: ascending, distinct 32-bit values."""
    anchors = _anchor_hashes() if anchors is None else anchors
    raw = [(t or "").encode() for t in texts]
    w = hashing.words(raw, lower=True, between=_BETWEEN)
    text = np.repeat(np.arange(len(raw)), np.diff(w.offsets))
    anchor = np.isin(w.hashes, anchors)
    has = np.zeros(len(raw), dtype=bool)
    has[text[anchor]] = True
    spots = np.flatnonzero(anchor | ~has[text])
    content = np.append(np.flatnonzero(~anchor), [len(w.hashes)] * chain)
    hashes, owners = np.append(w.hashes, np.uint64(0)), np.append(text, -1)
    at = np.searchsorted(content[: len(content) - chain], spots, side="right")
    value = hashes[spots]
    for k in range(chain):
        word = content[np.minimum(at + k, len(content) - 1)]
        inside = owners[word] == text[spots]  # a chain ends with its text
        value = hashing.mix(value + np.where(inside, hashes[word], np.uint64(0)) * np.uint64(2 * k + 3))
    signatures = (value >> np.uint64(32)).astype(np.uint32)
    order = np.lexsort((signatures, text[spots]))
    cuts = np.searchsorted(text[spots][order], np.arange(len(raw) + 1))
    sorted_ = signatures[order]
    out = [np.unique(sorted_[cuts[i] : cuts[i + 1]]) for i in range(len(raw))]
    for i, t in enumerate(raw):
        if t and not len(out[i]):
            out[i] = np.frombuffer(hashlib.md5(t).digest()[:4], np.uint32)
    return out


def encoded(print_: np.ndarray) -> str:
    return base64.b64encode(print_.astype("<u4").tobytes()).decode()


def length_class(length: int, least: float) -> int:
    """Sets of likeness ``least`` or more are in the same or adjacent classes."""
    return 0 if length < 1 else 1 + math.floor(math.log(length) / -math.log(least) + 1e-9)


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard coefficient, or 0 if it can't reach ``least``."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) > len(b):
        a, b = b, a
    if len(a) < least * len(b) or a[-1] < b[0] or b[-1] < a[0]:
        return 0.0
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    found = shared / (len(both) - shared)
    return found if found >= least else 0.0


def neighbours(docs: DataFrame) -> DataFrame:
    """(block, guest, doc_id, text): ranges of doc_id in order, each followed by
    its successor's first document as a guest.  One shuffle of the texts."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    blocks = BLOCKS_PER_PARTITION * partitions(spark)
    shares = [(i + 1) / blocks for i in range(blocks - 1)]
    bounds = docs.agg(F.percentile_approx("doc_id", shares, max(10_000, 20 * blocks))).first()[0] if shares else []
    bounds = sorted(set(bounds or []))
    block = range_number(F.col("doc_id"), bounds)
    first = docs.groupBy(block.alias("block")).agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("named"), "doc_id")).alias("first"))
    in_order = Window.orderBy("block")  # a row for each range
    guests = first.withColumn("host", F.coalesce(F.lag("block").over(in_order), F.max("block").over(Window.partitionBy())))
    guests = stored(guests.select(F.col("first.doc_id").alias("guest_id"), "host"), "guests")
    rows = docs.join(F.broadcast(guests), F.col("doc_id").eqNullSafe(F.col("guest_id")), "left")  # at most len(bounds) + 1 rows
    own = F.struct(block.alias("block"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("host").alias("block"), F.lit(True).alias("guest"))
    rows = rows.select("doc_id", "text", F.explode(F.when(F.col("host").isNull(), F.array(own)).otherwise(F.array(own, guest))).alias("place"))
    rows = rows.select("place.block", "place.guest", "doc_id", "text")
    return rows.repartitionByRange(partitions(spark), "block").sortWithinPartitions("block", "guest", F.col("doc_id").asc_nulls_first(), "text")


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, str, str]]:
    """(doc_id, text, next text) of every own row, from rows in order."""
    held = None
    for b in batches:
        for block, guest, doc_id, text in zip(*(b.column(i).to_pylist() for i in range(3)), b.column(3), strict=True):
            text = text.as_py() or ""
            if held and held[0] == block:
                yield held[1], held[2], text
            held = None if guest else (block, doc_id, text)


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by the beginning of the next one."""
    q = len(text) // 4
    return text[: len(text) - q] + following[:q]


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    anchors = _anchor_hashes()

    def rows(held: list[tuple[int | None, str, str]]) -> pa.RecordBatch:
        ids, own, following = zip(*held, strict=True)
        changed = [edited(a, b) for a, b in zip(own, following, strict=True)]
        mine, theirs = fingerprints(own, anchors), fingerprints(changed, anchors)
        after = fingerprints([following[-1]], anchors)[0]
        # a row's next is the following row, but at the end of a block
        nexts = [mine[i + 1] if i + 1 < len(own) and following[i] is own[i + 1] else None for i in range(len(own))]
        nexts[-1] = after
        missing = [i for i, x in enumerate(nexts) if x is None]
        for i, x in zip(missing, fingerprints([following[i] for i in missing], anchors), strict=True):
            nexts[i] = x
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "n_chars": pa.array([len(t) for t in own], pa.int64()),
                "edited_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
                "fingerprint": pa.array(map(encoded, mine), pa.string()),
                "edited_fingerprint": pa.array(map(encoded, theirs), pa.string()),
                "near_edited": pa.array(map(likeness, mine, theirs), pa.float64()),
                "near_next": pa.array(map(likeness, mine, nexts), pa.float64()),
            }
        )

    held, size = [], 0
    for pair in _pairs(batches):
        held.append(pair)
        size += len(pair[1]) + 64
        if size >= BATCH_BYTES:
            yield rows(held)
            held, size = [], 0
    if held:
        yield rows(held)


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Every row's fingerprint, its edited text's, and the likeness of the
    fingerprint to that one and to the next document's."""
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return neighbours(docs).mapInArrow(_digest, schema)
