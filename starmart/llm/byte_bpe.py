"""Byte-level BPE encoding and decoding by dynamic programming over prefixes.

For every prefix of a piece of text there is exactly one token that can come last in its encoding: the token
before it must be the last token of the shorter prefix, and the two must stand side by side in an encoding of
their own bytes. The table of last tokens gives the encoding by walking back from the end. Appending bytes
only adds entries; an edit recomputes entries from the edit until they agree with the old ones again.

A null text counts as empty and has no tokens. Any text, however long, with however long pieces, is encoded
whole in time linear in its length. Columns other than the text are never read.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from starmart.llm.resident import hold, trim

#: Pieces whose encoding a worker remembers, in two generations of this size each; longer ones than this many
#: characters are not remembered. Likewise pairs of tokens and steps of the automaton.
CACHED, CACHED_CHARS = 100_000, 48
CACHED_PAIRS = 400_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ids from a rank file (base64 of the token, a space, the id)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Recent(dict):
    """A bounded memory: when it is full it becomes the older generation, and what is used comes back from there."""

    def __init__(self, make, most: int = CACHED):
        super().__init__()
        self._make, self._most, self._older = make, most, {}

    def __missing__(self, key):
        value = self._older.get(key)
        if value is None:
            value = self._make(key)
            if len(key) > CACHED_CHARS:
                return value
        if len(self) >= self._most:
            self._older = dict(self)
            self.clear()
        self[key] = value
        return value

    def drop_older(self) -> None:
        self._older = {}


class PrefixTable:
    """The last token of the encoding of every prefix of some bytes (a piece or any byte string)."""

    def __init__(self, bpe: ByteBpe, data: bytes = b""):
        self._bpe = bpe
        self.data = b""
        self.last: list[int] = [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        """Extend the bytes; entries that are there stay as they are."""
        self.data += more
        self._fill(len(self.last), len(self.data) + 1)

    def replace(self, start: int, end: int, by: bytes) -> int:
        """Replace data[start:end]; the number of entries that had to be computed.

        An entry depends on the entries of the last ``longest`` prefixes only, so once that many after the
        edit equal the old ones, all later ones do.
        """
        old, shift = self.last, len(by) - (end - start)
        self.data = self.data[:start] + by + self.data[end:]
        self.last = old[: start + 1]
        same, at, size = 0, start + 1, len(self.data) + 1
        while at < size:
            self._fill(at, at + 1)
            settled = at > start + len(by) and self.last[at] == old[at - shift]
            same = same + 1 if settled else 0
            at += 1
            if same >= self._bpe.longest:
                self.last += old[at - shift :]
                break
        return at - start - 1

    def _fill(self, first: int, stop: int) -> None:
        bpe, last = self._bpe, self.last
        step, move, ending, pairs, base = bpe.step.get, bpe.move, bpe.ending, bpe.pairs, bpe.base
        state = 0
        for byte in self.data[max(0, first - 1 - bpe.longest) : first - 1]:
            state = move(state, byte)
        for at, byte in enumerate(self.data[first - 1 : stop - 1], first):
            to = step(state << 8 | byte)
            state = move(state, byte) if to is None else to
            for size, token in ending[state]:
                before = last[at - size]
                if before < 0:
                    if size == at:
                        break
                    continue
                fits = pairs.get(before * base + token)
                if fits is None:
                    fits = bpe.stand_together(before, token)
                if fits:
                    break
            last.append(token)

    def ids(self) -> list[int]:
        """The encoding of all bytes."""
        out, at = [], len(self.data)
        while at:
            token = self.last[at]
            out.append(token)
            at -= len(self._bpe.tokens[token])
        return out[::-1]


class ByteBpe:
    """Encoder and decoder for a rank file and the pattern that cuts text into pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.cut = regex.compile(pattern)
        self.tokens = {i: t for t, i in ranks.items()}
        self.base = max(self.tokens, default=0) + 1
        self.pairs: dict[int, bool] = {}
        self._left: dict[int, list[int]] = {}
        self._right: dict[int, list[int]] = {}
        #: Tokens that merging makes of their own bytes; others only stand for a whole piece.
        self.proper = {t: i for t, i in ranks.items() if len(t) == 1 or self._merged(t) == [i]}
        self.longest = max(map(len, self.proper), default=1)
        self._find_tokens()
        self._pieces = Recent(self._remember)
        self._written = {i: str(i) for i in self.tokens}

    def _find_tokens(self) -> None:
        """An automaton over bytes whose state tells the tokens that end here, longest first."""
        self.step: dict[int, int] = {}
        above, paths = [(0, 0)], [b""]
        for token in sorted(self.proper, key=lambda t: (len(t), t)):
            state = 0
            for byte in token:
                to = self.step.get(state << 8 | byte)
                if to is None:
                    to = self.step[state << 8 | byte] = len(above)
                    above.append((state, byte))
                    paths.append(paths[state] + bytes([byte]))
                state = to
        self._fail = [0] * len(above)
        self.ending: list[tuple[tuple[int, int], ...]] = [()] * len(above)
        for state in sorted(range(1, len(above)), key=lambda s: len(paths[s])):
            parent, byte = above[state]
            if parent:
                self._fail[state] = self.move(self._fail[parent], byte)
            own = self.proper.get(paths[state])
            rest = self.ending[self._fail[state]]
            self.ending[state] = rest if own is None else ((len(paths[state]), own), *rest)

    def move(self, state: int, byte: int) -> int:
        """The state after one more byte; found transitions are remembered."""
        at = state
        to = self.step.get(at << 8 | byte)
        while to is None and at:
            at = self._fail[at]
            to = self.step.get(at << 8 | byte)
        if at != state and len(self.step) < CACHED_PAIRS:
            self.step[state << 8 | byte] = to or 0
        return to or 0

    def _merged(self, data: bytes, stop: int = 1) -> list[int]:
        """Encoding by merging the pair of lowest rank, leftmost first, until ``stop`` parts are left."""
        parts = [data[i : i + 1] for i in range(len(data))]
        ranks = self.ranks
        while len(parts) > stop:
            rank, at = min((ranks.get(a + b, self.base), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == self.base:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def _spine(self, token: int, side: int) -> list[int]:
        """The tokens that stand at an edge of a token while it is merged, from its byte to itself."""
        spine, at = [token], token
        while len(self.tokens[at]) > 1:
            at = self._merged(self.tokens[at], 2)[side]
            spine.append(at)
        return spine[::-1]

    def stand_together(self, left: int, right: int) -> bool:
        """Whether the bytes of two proper tokens are encoded as these two tokens.

        Both are merged in rising order of ranks; they stay apart if no pair across the border, at the time
        it exists, has a lower rank than the next merge beside it.
        """
        key = left * self.base + right
        if key in self.pairs:
            return self.pairs[key]
        if left not in self._right:
            self._right[left] = self._spine(left, -1)
        if right not in self._left:
            self._left[right] = self._spine(right, 0)
        ends, starts = self._right[left], self._left[right]
        i = j = 0
        apart = True
        while apart:
            rank = self.ranks.get(self.tokens[ends[i]] + self.tokens[starts[j]], self.base)
            next_left = ends[i + 1] if i + 1 < len(ends) else self.base
            next_right = starts[j + 1] if j + 1 < len(starts) else self.base
            apart = rank == self.base or rank >= next_left or rank > next_right
            if next_left == next_right == self.base:
                break
            if next_left <= next_right:
                i += 1
            else:
                j += 1
        if len(self.pairs) >= CACHED_PAIRS:
            self.pairs.clear()
        self.pairs[key] = apart
        return apart

    def encode_piece(self, piece: bytes) -> list[int]:
        """The last tokens of all prefixes, as in ``PrefixTable``, and the walk back, for bytes that stay as they are."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        step, ending, pairs, base = self.step, self.ending, self.pairs, self.base
        last: list[int] = []  # of the prefix of one byte, of two, ...
        sizes: list[int] = []
        state = 0
        for at, byte in enumerate(piece):
            key = state << 8 | byte
            state = step[key] if key in step else self.move(state, byte)
            for size, token in ending[state]:
                if size > at:
                    break
                pair = last[at - size] * base + token
                if pairs[pair] if pair in pairs else self.stand_together(last[at - size], token):
                    break
            last.append(token)
            sizes.append(size)
        out, at = [], len(piece) - 1
        while at >= 0:
            out.append(last[at])
            at -= sizes[at]
        out.reverse()
        return out

    def _remember(self, piece: str) -> tuple[int, ...]:
        return tuple(self.encode_piece(piece.encode("utf-8", "replace")))

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self._pieces.__getitem__, self.cut.findall(text))))

    def encode_with_text(self, text: str) -> tuple[list[int], str]:
        """The ids, and the same as decimal numbers joined by commas."""
        ids = self.encode(text)
        return ids, ",".join(map(self._written.__getitem__, ids))

    def rest(self) -> None:
        """Keep only the younger generation of pieces while a worker waits for its next task."""
        self._pieces.drop_older()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def load(path: str, pattern: str) -> ByteBpe:
    """Read once in each Python worker. The file must be at the same place on every machine."""
    return hold(("byte_bpe", path, pattern), lambda: ByteBpe(read_ranks(path), pattern))


def encode(path: str, pattern: str) -> Callable[[Column], Column]:
    """A function from a text column to an array of token ids."""

    @F.pandas_udf("array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = load(path, pattern)
        for batch in batches:
            yield pd.Series([np.array(bpe.encode(t or ""), np.int32) for t in batch], dtype=object)
        bpe.rest()
        trim()

    return run


def decode(path: str, pattern: str) -> Callable[[Column], Column]:
    """A function from a column of token ids to the bytes they stand for."""

    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = load(path, pattern)
        for batch in batches:
            yield pd.Series([b"" if i is None else bpe.decode(i.tolist()) for i in batch], dtype=object)

    return run


def round_trip(path: str, pattern: str) -> Callable[[Column], Column]:
    """A function from a text column to a struct of ``ids``, ``n_tokens`` and the ``decoded`` bytes.

    The same as ``encode`` and ``decode`` after each other, in one pass. ``ids`` is written as decimal numbers
    joined by commas.
    """

    @F.pandas_udf("ids string, n_tokens long, decoded binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = load(path, pattern)
        for batch in batches:
            written, counts, decoded = [], [], []
            for text in batch:
                ids, as_text = bpe.encode_with_text(text or "")
                written.append(as_text)
                counts.append(len(ids))
                decoded.append(bpe.decode(ids))
            yield pd.DataFrame(
                {
                    "ids": pd.Series(written, dtype=object),
                    "n_tokens": pd.Series(counts, dtype="int64"),
                    "decoded": pd.Series(decoded, dtype=object),
                }
            )
        bpe.rest()
        trim()

    return run
