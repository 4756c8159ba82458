"""Byte-level BPE encoding and decoding of whole texts.

``encode``: texts are cut by the pre-tokenizer's pattern (``pretokens``), the
distinct words of a batch run through the transducer (``bpe_transducer``),
and the ids are put together in the order of the words.  ``decode``: ids
become bytes by a table, and an incremental UTF-8 state machine turns the bytes
into text piece by piece, holding back what a piece leaves unfinished.

Both work on Arrow batches, nothing is shuffled, and a task holds about
``BATCH`` bytes of text, or one text.  Defined cases: a null text is like an
empty one, without ids; null ids decode to a null text; an id outside the
vocabulary is an error; bytes that are not UTF-8 decode to U+FFFD; repeated
rows and ids stay; columns other than ``doc_id`` and the one read are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimscope.llm import pretokens
from claimscope.llm.bpe_transducer import Transducer, read_ranks, transducer
from claimscope.llm.shared import rows_of

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Bytes of text taken at once; ids decoded at once.
BATCH, IDS = 1 << 21, 1 << 16
#: Words whose ids a worker keeps, and the longest of them.
WORDS, LONG = 1 << 18, 64


def texts_of(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column end to end, and the texts' offsets; null is empty."""
    texts = pa.concat_arrays([c.cast(pa.large_binary()) for c in pc.fill_null(column, "").chunks])
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... over all ranges, one after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


class WordIds:
    """Ids of the words of a batch: each distinct word is encoded once."""

    def __init__(self, machine: Transducer, table: bytes):
        self._machine, self._kinds = machine, pretokens.classes(table)
        self._known: dict[bytes, list[int]] = {}

    def _of(self, word: bytes) -> list[int]:
        ids = self._known.get(word)
        if ids is None:
            ids = self._machine.encode(word)
            if len(word) <= LONG:
                if len(self._known) >= WORDS:
                    self._known.clear()
                self._known[word] = ids
        return ids

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the ids before each text (one entry more than texts)."""
        starts = pretokens.word_starts(data, offsets[:-1], self._kinds)
        if not len(starts):
            return np.zeros(0, "<u4"), np.zeros(len(offsets), np.int64)
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(data)).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
        coded = words.dictionary_encode()
        which = coded.indices.to_numpy()
        of_word = [self._of(w) for w in coded.dictionary.to_pylist()]
        count = np.fromiter(map(len, of_word), np.int64, len(of_word))
        flat = np.fromiter((i for ids in of_word for i in ids), "<u4", int(count.sum()))
        first = np.cumsum(count) - count
        ids = flat[ranges(first[which], count[which])]
        before = np.concatenate([[0], np.cumsum(count[which])])
        return ids, before[np.searchsorted(starts, offsets)]


_ENCODED = "doc_id long, n_tokens long, ids binary"


def _encoding(path: str, table: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_ids = WordIds(transducer(path), table)
        for rows in rows_of(batches, BATCH):
            ids, at = word_ids(*texts_of(rows["text"]))
            raw = pa.Array.from_buffers(pa.large_binary(), rows.num_rows, [None, pa.py_buffer(4 * at), pa.py_buffer(np.ascontiguousarray(ids))])
            columns = [pa.concat_arrays(rows["doc_id"].chunks), pa.array(np.diff(at)), raw.cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids"])

    return run


def encode(docs: DataFrame, path: str = PATH) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit) of every text."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_encoding(path, pretokens.class_table()), _ENCODED)


# the UTF-8 machine: a state is the bytes that must follow, and which the next may be
_BODY = range(0x80, 0xC0)
_DONE, _BAD = 0, 7
_LEADS = [  # (lead bytes, next byte, bytes that follow)
    (range(0x00, 0x80), range(0), 0),
    (range(0xC2, 0xE0), _BODY, 1),
    (range(0xE0, 0xE1), range(0xA0, 0xC0), 2),
    (range(0xED, 0xEE), range(0x80, 0xA0), 2),
    ([*range(0xE1, 0xED), 0xEE, 0xEF], _BODY, 2),
    (range(0xF0, 0xF1), range(0x90, 0xC0), 3),
    (range(0xF4, 0xF5), range(0x80, 0x90), 3),
    (range(0xF1, 0xF4), _BODY, 3),
]


def _machine() -> list[list[int]]:
    """state -> byte -> state; 0 between code points, ``_BAD`` where the byte cannot come."""
    states = {(0, ()): _DONE}
    for _, following, n in _LEADS:
        for left in range(1, n + 1):
            states.setdefault((left, tuple(following) if left == n else tuple(_BODY)), len(states) + (len(states) >= _BAD))
    table = [[_BAD] * 256 for _ in range(max(states.values()) + 1)]
    for leads, following, n in _LEADS:
        for byte in leads:
            table[_DONE][byte] = states[n, tuple(following)]
    for (left, following), state in states.items():
        for byte in following:
            table[state][byte] = states[left - 1, tuple(_BODY) if left > 1 else ()]
    return table


_NEXT = _machine()


class Utf8Stream:
    """Incremental decoding: text of the bytes fed so far, without a code point that is not finished."""

    def __init__(self):
        self._held = b""

    def feed(self, data: bytes) -> str:
        data = self._held + data
        begin = max(0, len(data) - 3)  # an unfinished code point has at most three bytes
        lead = next((i for i in range(len(data) - 1, begin - 1, -1) if data[i] >= 0xC0), len(data))
        state = _DONE
        for byte in data[lead:]:
            state = _NEXT[state][byte] if state != _BAD else _BAD
        cut = lead if state not in (_DONE, _BAD) else len(data)
        self._held = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def close(self) -> str:
        held, self._held = self._held, b""
        return held.decode("utf-8", "replace")


class TokenBytes:
    """Bytes of ids, by a table of the vocabulary."""

    def __init__(self, tokens: dict[int, bytes]):
        size = max(tokens) + 1
        self._known = np.zeros(size, bool)
        self._known[list(tokens)] = True
        self.lengths = np.array([len(tokens.get(i, b"")) for i in range(size)], np.int64)
        self._first = np.cumsum(self.lengths) - self.lengths
        self._bytes = np.frombuffer(b"".join(tokens.get(i, b"") for i in range(size)), np.uint8)

    def __call__(self, ids: np.ndarray) -> bytes:
        if len(ids) and (ids.max() >= len(self._known) or not self._known[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        return self._bytes[ranges(self._first[ids], self.lengths[ids])].tobytes()

    def decoded(self, ids: np.ndarray) -> tuple[bytes, str]:
        """Bytes and text of ids, piece by piece."""
        stream = Utf8Stream()
        parts = [self(ids[at : at + IDS]) for at in range(0, len(ids), IDS)]
        return b"".join(parts), "".join([*map(stream.feed, parts), stream.close()])


_DECODED = "doc_id long, n_tokens long, ids binary, decoded binary, decoded_text string"


@lru_cache(maxsize=2)
def token_bytes_of(path: str) -> TokenBytes:
    return TokenBytes({number: token for token, number in read_ranks(path).items()})


def _decoding(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token_bytes = token_bytes_of(path)
        for rows in rows_of(batches, BATCH, "ids"):
            pairs = [token_bytes.decoded(np.frombuffer(x.as_buffer(), "<u4")) if x.is_valid else (None, None) for x in rows["ids"]]
            data, texts = zip(*pairs, strict=True)
            yield pa.RecordBatch.from_arrays([*(pa.concat_arrays(rows[c].chunks) for c in ("doc_id", "n_tokens", "ids")), pa.array(data, pa.binary()), pa.array(texts, pa.string())], names=[c.split()[0] for c in _DECODED.split(", ")])

    return run


def decode(encoded: DataFrame, path: str = PATH) -> DataFrame:
    """``encoded`` with the bytes (``decoded``) and the text (``decoded_text``) of its ids."""
    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(_decoding(path), _DECODED)


_DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, decoded_chars long"


def _round_trip(path: str, table: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_ids, token_bytes = WordIds(transducer(path), table), token_bytes_of(path)
        for rows in rows_of(batches, BATCH):
            ids, at = word_ids(*texts_of(rows["text"]))
            out = []
            for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                data, text = token_bytes.decoded(ids[a:b])
                out.append((hashlib.sha256(ids[a:b].tobytes()).hexdigest(), hashlib.sha256(data).hexdigest(), len(text)))
            of_ids, of_bytes, chars = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.concat_arrays(rows["doc_id"].chunks), pa.array(np.diff(at)), pa.array(of_ids), pa.array(of_bytes), pa.array(chars, pa.int64())], names=[c.split()[0] for c in _DIGEST.split(", ")])

    return run


def round_trip_digest(docs: DataFrame, path: str = PATH) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and decoded_chars: every text
    encoded and its ids decoded, in one pass."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_round_trip(path, pretokens.class_table()), _DIGEST)
