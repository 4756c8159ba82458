"""Byte-level BPE ids of whole texts.

Ids are those of the ``tokenizers`` file at ``path`` with
``add_special_tokens=False``: none are added, but the string of an added token
(``<|endoftext|>``) in a text is that token.  Its merges run in ``tiktoken``;
texts without two white space characters in a row, nearly all, use a
pretokenizer pattern without look-ahead, which cuts them alike and is faster.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache, partial

import numpy as np
import public_tokenizers
import tiktoken

#: Ends every document.
END = 1
PATH = public_tokenizers.path("byte_bpe_50k.json")

# Fixed value: the file's pretokenizer, for texts whose white space stands alone.
LONE_SPACES = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"
_RUN = re.compile(r"\s\s")


@lru_cache(maxsize=1)
def _encodings(path: str) -> tuple[tiktoken.Encoding, tiktoken.Encoding]:
    """The merges of the file as ranks (a token's id is its rank) and its added tokens, with either pattern."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    vocabulary, added = file["model"]["vocab"], file.get("added_tokens") or []
    if any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip")):
        raise ValueError(f"added tokens of {path} that take or need white space around them are not supported")
    special = {t["content"]: t["id"] for t in added}
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
    ranks = {bytes(letters[c] for c in token): i for token, i in vocabulary.items() if token not in special}
    return tuple(tiktoken.Encoding(path, pat_str=p, mergeable_ranks=ranks, special_tokens=special) for p in (public_tokenizers.PATTERN, LONE_SPACES))


class Encoder:
    """A document's text to its ids, then END; 16 bits each."""

    def __init__(self, path: str = PATH):
        whole, lone = _encodings(path)
        self._whole, self._lone = whole.encode_ordinary, lone.encode_ordinary
        self._special, self._with_special = whole.special_tokens_set, partial(whole.encode, allowed_special="all")

    def __call__(self, text: str | None) -> np.ndarray:
        text = text or ""
        encode = self._with_special if any(s in text for s in self._special) else self._whole if _RUN.search(text) else self._lone
        ids = array("H", encode(text))
        ids.append(END)
        return np.frombuffer(ids, dtype=np.uint16)


def vocabulary(path: str = PATH) -> list[bytes]:
    """The bytes of every id (of an added token: its string's)."""
    whole, _ = _encodings(path)
    return [whole.decode_single_token_bytes(i) for i in range(whole.max_token_value + 1)]


def plain_encoder(path: str = PATH):
    """A text to its ids (an array), strings of added tokens being plain text."""
    whole, lone = _encodings(path)
    return lambda text: (whole if _RUN.search(text) else lone).encode_to_numpy(text, disallowed_special=())
