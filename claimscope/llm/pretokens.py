"""The pre-tokenizer's pattern, over the bytes of many texts at once.

``public_tokenizers.PATTERN`` cuts a text into words: contractions; runs of
letters, of numbers or of other marks, each with one space before it; white
space.  Here code points become classes, and runs of a class become words by a
few rules, so that no regular expression runs over the corpus.  The classes
are asked of ``tiktoken`` itself (which drops what a pattern does not match),
so they are of its Unicode version.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import tiktoken
import zstandard

OTHER, LETTER, NUMBER, SPACE = range(4)


@lru_cache(maxsize=1)
def class_table() -> bytes:
    """The class of every code point, compressed (a few KB), to be shipped to tasks."""
    table = np.zeros(0x110000, np.uint8)
    points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    single = {bytes([b]): b for b in range(256)}
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        matched = bytes(tiktoken.Encoding(pattern, pat_str=pattern, mergeable_ranks=single, special_tokens={}).encode_ordinary(points))
        table[np.frombuffer(matched.decode().encode("utf-32-le"), np.uint32)] = kind
    return zstandard.compress(table.tobytes())


def classes(table: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(table), np.uint8)


def _code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each code point, and the code point."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    if len(at) == len(data):
        return at, data.astype(np.uint32)
    more = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.uint32)
    a, b, c, d = (more[at + i] for i in range(4))
    tail = lambda x: x & 0x3F
    point = np.where(a < 0x80, a, np.where(a < 0xE0, (a & 0x1F) << 6 | tail(b), np.where(a < 0xF0, (a & 0x0F) << 12 | tail(b) << 6 | tail(c), (a & 0x07) << 18 | tail(b) << 12 | tail(c) << 6 | tail(d))))
    return at, np.minimum(point, 0x10FFFF)


def word_starts(data: np.ndarray, text_starts: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """First byte of every word of the texts that lie end to end in ``data``
    (valid UTF-8); ``text_starts`` are the texts' first bytes."""
    if not len(data):
        return np.zeros(0, np.int64)
    at, point = _code_points(data)
    kind = kinds[point]
    size = len(at)
    opens = np.zeros(size + 1, bool)
    opens[np.searchsorted(at, text_starts)] = True
    opens[0] = opens[size] = True
    begins = opens[:size].copy()
    begins[1:] |= kind[1:] != kind[:-1]
    run = np.flatnonzero(begins)
    length = np.diff(run, append=size)
    of = kind[run]
    alone = opens[run]  # nothing of the same text before it
    ends = opens[run + length]  # nothing after it
    last_space = (of == SPACE) & (point[run + length - 1] == 0x20) & ~ends
    takes = np.zeros(len(run), bool)  # the space before it
    takes[1:] = last_space[:-1]

    starts = np.zeros(size, bool)
    # words of letters, numbers or marks, without the letters of a contraction
    cut = np.zeros(len(run), np.int64)
    mark = np.flatnonzero((of == OTHER) & (length == 1) & (point[run] == ord("'")) & ~takes & ~ends)
    mark = mark[of[mark + 1] == LETTER]
    first = point[run[mark + 1]]
    second = np.where(length[mark + 1] > 1, point[np.minimum(run[mark + 1] + 1, size - 1)], 0)
    one = np.isin(first, [ord(c) for c in "stmd"])
    two = ((first == ord("r")) & (second == ord("e"))) | ((first == ord("v")) & (second == ord("e"))) | ((first == ord("l")) & (second == ord("l")))
    cut[mark + 1] = np.where(one, 1, np.where(two, 2, 0))
    solid = (of != SPACE) & (cut < length)
    starts[(run + cut - takes)[solid]] = True
    # white space: all but its last character, then that, unless a word takes it
    blank = of == SPACE
    starts[run[blank & ((length > 1) | ~last_space)]] = True
    starts[(run + length - 1)[blank & ~ends & ~last_space]] = True
    return at[starts]
