"""Rabin-Karp hashes of words and word windows, vectorised over a batch.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D, which is the
same as ``[^\\x20\\x09-\\x0D]+`` over code points in UTF-8.  Hashes are
64-bit polynomial (Rabin-Karp) sums modulo 2**64 with odd bases, each word
mixed before windows are formed.  Such sums can be made to collide by long
self-similar sequences (of some thousand terms), so words beyond ``LONG_WORD`` bytes are
hashed by BLAKE2b instead; windows are far shorter.  Different windows then
collide with a probability of about 2**-56 per compared pair or less.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np

BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD1342543DE82EF95

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes hashed at once; longer buffers are taken in slices cut at white space.
SLICE = 1 << 19
#: Longer words are no polynomial sums.
LONG_WORD = 128


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of an odd base and of its inverse modulo 2**64."""
    if base not in _POWERS or len(_POWERS[base][0]) < size:
        n = 1 << max(12, int(size).bit_length())
        up = np.full(n, base, dtype=np.uint64)
        down = np.full(n, pow(base, -1, 2**64), dtype=np.uint64)
        up[0] = down[0] = 1
        _POWERS[base] = np.cumprod(up), np.cumprod(down)
    up, down = _POWERS[base]
    return up[:size], down[:size]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _sums(values: np.ndarray, base: int) -> np.ndarray:
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(base, len(values))[0], out=out[1:])
    return out


class Words(NamedTuple):
    """Words of a batch of texts, in order: hash, and first word of each text
    (``offsets`` has one entry more than there are texts)."""

    hashes: np.ndarray
    offsets: np.ndarray


def _slice_words(buf: np.ndarray, between: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    space = np.ones(len(buf) + 2, dtype=bool)
    space[1:-1] = between[buf]
    edges = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edges[0::2], edges[1::2]
    sums = _sums(buf.astype(np.uint64) + np.uint64(1), BYTE_BASE)
    hashes = (sums[ends] - sums[starts]) * powers(BYTE_BASE, len(buf) + 1)[1][starts]
    hashes = mix(hashes + (ends - starts).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    for i in np.flatnonzero(ends - starts > LONG_WORD).tolist():
        hashes[i] = int.from_bytes(hashlib.blake2b(buf[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return hashes, starts


def words(texts: list[bytes], lower: bool = False, between: np.ndarray = IS_SPACE) -> Words:
    """Hash every word of every text; ``between`` tells the bytes that separate
    words (0x0A among them)."""
    joined = b"\n".join(texts) + b"\n"
    buf = np.frombuffer(joined, dtype=np.uint8)
    if lower:
        buf = LOWER[buf]
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    begins = np.concatenate([[0], np.cumsum(lengths + 1)])
    hashes, starts, at = [], [], 0
    while at < len(buf):
        end = at + SLICE
        while end < len(buf):  # cut after a separator
            spaces = np.flatnonzero(between[buf[end - 1 : end + SLICE]])
            if len(spaces):
                end += int(spaces[0])
                break
            end += SLICE
        h, s = _slice_words(buf[at:end], between)
        hashes.append(h)
        starts.append(s + at)
        at = end
    hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    starts = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    return Words(hashes, np.searchsorted(starts, begins))


class Windows(NamedTuple):
    """Windows of a batch: hash, index of the text, first word in the text."""

    hashes: np.ndarray
    text: np.ndarray
    start: np.ndarray


def windows(w: Words, size: int, whole_if_short: bool = False) -> Windows:
    """All windows of ``size`` consecutive words that lie inside one text.

    ``whole_if_short``: a text of 1 to ``size - 1`` words has one window, all
    its words; else it has none.
    """
    counts = np.diff(w.offsets)
    per = np.maximum(counts - size + 1, 0)
    width = np.full(len(counts), size)
    if whole_if_short:
        short = (counts > 0) & (counts < size)
        per[short], width = 1, np.where(short, counts, size)
    text = np.repeat(np.arange(len(counts)), per)
    begin = np.concatenate([[0], np.cumsum(per)])[:-1]
    start = np.arange(len(text)) - begin[text]
    first = w.offsets[:-1][text] + start
    sums = _sums(w.hashes, WORD_BASE)
    wide = width[text]
    hashes = (sums[first + wide] - sums[first]) * powers(WORD_BASE, len(w.hashes) + 1)[1][first]
    return Windows(mix(hashes + wide.astype(np.uint64)), text, start)
