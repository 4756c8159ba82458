"""Byte-level BPE as a lazily determinised finite-state transducer.

A sequence of tokens is what BPE makes of its bytes just when every two
neighbours are (``Merges.compatible``): merging their joined bytes gives the
two back.  So a prefix of a word has one last token, the only suffix token
that is compatible with the last token of what stands before it.

The transducer that reads a byte and guesses where tokens begin is made
deterministic by subsets: a state is the set of starts from which the bytes
read so far begin a longer token, each as a node of the tokens' trie.  States and arcs
are made when first met; the oldest start determines a state, so there are no more
than the trie has nodes, whatever the corpus.  An arc names the tokens that can
end at its byte, the longest first; registers hold the last token of the few prefixes
that are starts, and decide which one does.

Ids are emitted when the segmentations before all starts agree on them; that
is looked for every ``LOOK`` bytes and at a word's end, so a word of any length
needs only the registers of a short stretch.
"""

from __future__ import annotations

import base64
from functools import lru_cache

#: Bytes after which decided ids are emitted.
LOOK = 128
#: Pairs of ids whose compatibility is kept.
PAIRS = 1 << 18


def read_ranks(path: str) -> dict[bytes, int]:
    """token bytes -> id (which is its rank), from a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Merges:
    """The merge rules that ranks stand for: of all neighbours whose joined
    bytes are a token, those of the lowest rank merge first, leftmost first."""

    def __init__(self, ranks: dict[bytes, int]):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("every single byte must be a token")
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self._edge: dict[int, tuple[tuple[int, ...], tuple[int, ...]]] = {}
        self.known: dict[int, bool] = {}  # (left + 1) << 32 | right

    def _parts(self, piece: bytes, least: int = 1) -> list[bytes]:
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > least:
            found = [(rank, i) for i in range(len(parts) - 1) if (rank := self.ranks.get(parts[i] + parts[i + 1])) is not None]
            if not found:
                break
            _, i = min(found)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def merged(self, piece: bytes) -> list[int]:
        """The definition, for short pieces."""
        return [self.ranks[p] for p in self._parts(piece)]

    def _edges(self, number: int) -> tuple[tuple[int, ...], tuple[int, ...]]:
        """A token, then the part of its last merge at its left (right) end, and so on to one
        byte; empty for a token that merges do not reach in the order of their ranks."""
        known = self._edge.get(number)
        if known is None:
            token, known = self.tokens[number], ((number,), (number,))
            if len(token) > 1:
                parts = self._parts(token, 2)
                left, right = (self.ranks[parts[0]], self.ranks[parts[-1]])
                lefts, rights = self._edges(left)[0], self._edges(right)[1]
                known = ((number, *lefts), (number, *rights)) if len(parts) == 2 and left < number > right and lefts and rights else ((), ())
            self._edge[number] = known
        return known

    def _apart(self, left: int, right: int) -> bool:
        """Undo the merges next to the boundary, the latest first; the two stay
        apart if no merge over the boundary comes before the next one inside."""
        ends, begins = self._edges(left)[1], self._edges(right)[0]
        if not ends or not begins:
            return self.merged(self.tokens[left] + self.tokens[right]) == [left, right]
        i = j = 0
        while True:
            across = self.ranks.get(self.tokens[ends[i]] + self.tokens[begins[j]])
            # of equal ranks the leftmost merges first
            if across is not None and (not i or across < ends[i - 1]) and (not j or across <= begins[j - 1]):
                return False
            more_left, more_right = i + 1 < len(ends), j + 1 < len(begins)
            if not (more_left or more_right):
                return True
            if more_left and (not more_right or ends[i] > begins[j]):
                i += 1
            else:
                j += 1

    def compatible(self, left: int, right: int) -> bool:
        """Whether ``right`` can follow ``left`` (-1: the start of a word)."""
        pair = (left + 1) << 32 | right
        known = self.known.get(pair)
        if known is None:
            if len(self.known) >= PAIRS:
                self.known.clear()
            known = self.known[pair] = self._apart(left, right) if left >= 0 else self.merged(self.tokens[right]) == [right]
        return known


ROOT = 0


class Transducer:
    def __init__(self, merges: Merges):
        self.merges = merges
        self._child: dict[int, int] = {}  # node << 8 | byte -> node
        self._token: list[int] = [-1]  # of a node's bytes
        self._depth: list[int] = [0]
        self._begins: list[bool] = [True]  # whether a longer token begins with a node's bytes
        for token, number in merges.ranks.items():
            node = ROOT
            for depth, byte in enumerate(token, 1):
                self._begins[node] = True
                following = self._child.setdefault(node << 8 | byte, len(self._token))
                if following == len(self._token):
                    self._token.append(-1)
                    self._depth.append(depth)
                    self._begins.append(False)
                node = following
            self._token[node] = number
        self._states: list[tuple[int, ...]] = [(ROOT,)]  # live starts, the oldest first
        self._ids = {(ROOT,): 0}
        self._arcs: dict[int, tuple[int, tuple[tuple[int, int], ...]]] = {}

    def __len__(self) -> int:
        return len(self._states)

    def _arc(self, number: int, byte: int) -> tuple[int, tuple[tuple[int, int], ...]]:
        """Where a byte leads, and the tokens that can end at it with their lengths."""
        nodes = [n for node in self._states[number] if (n := self._child.get(node << 8 | byte)) is not None]
        ending = tuple((self._token[n], self._depth[n]) for n in nodes if self._token[n] >= 0)
        state = (*(n for n in nodes if self._begins[n]), ROOT)
        at = self._ids.setdefault(state, len(self._states))
        if at == len(self._states):
            self._states.append(state)
        arc = self._arcs[number << 8 | byte] = at, ending
        return arc

    def _back(self, last: list[int], at: int) -> list[int]:
        """Ends of the tokens of the first ``at`` bytes, from there back to 0."""
        ends = [at]
        while at:
            at -= len(self.merges.tokens[last[at]])
            ends.append(at)
        return ends

    def _decided(self, last: list[int], state: int) -> int:
        """How many bytes all live starts' segmentations share as whole tokens."""
        here = len(last) - 1
        chains = [set(self._back(last, here - self._depth[node])) for node in self._states[state]]
        return max(set.intersection(*chains))

    def encode(self, word: bytes) -> list[int]:
        """The ids of a word (one match of the pre-tokenizer's pattern)."""
        arcs, pairs = self._arcs, self.merges.known
        out: list[int] = []
        at, last, size = 0, [-1], 0  # last[i]: last token of the first i bytes that are not emitted
        for byte in word:
            at, ending = arcs.get(at << 8 | byte) or self._arc(at, byte)
            size += 1
            for token, length in ending:
                before = last[size - length]
                fits = pairs.get((before + 1) << 32 | token)
                if fits is None:
                    fits = self.merges.compatible(before, token)
                if fits:
                    break
            last.append(token)
            if size % LOOK == 0 and (decided := self._decided(last, at)):
                out += [last[e] for e in reversed(self._back(last, decided)[:-1])]
                last, size = last[decided:], size - decided
        out += [last[e] for e in reversed(self._back(last, size)[:-1])]
        if len(out) > 1 and (whole := self.merges.ranks.get(word)) is not None:
            return [whole]  # a token that its own merges do not reach stands for the whole word only
        return out


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    """One for each Python worker, which keeps its states from task to task."""
    return Transducer(Merges(read_ranks(path)))
