"""Words of many texts as numpy arrays.

A word is a run of bytes other than ``\\x20`` and ``\\x09-\\x0D`` of the UTF-8 text. Every function works on a
slice of texts at a time, whose size in bytes the callers bound with ``slices``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

#: Words of more bytes than this are hashed one by one.
_LONG = 1024
_PADDING = 8
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)
_SEED, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xA0761D6478BD642F)

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def slices(texts: list[bytes], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold about ``most`` bytes each; a longer text is a range of its own."""
    first, held = 0, 0
    for i, text in enumerate(texts):
        if i > first and held + len(text) > most:
            yield first, i
            first, held = i, 0
        held += len(text)
    if first < len(texts):
        yield first, len(texts)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every bit over all (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """Bounds and hashes of the words of a few texts.

    ``start`` and ``end`` are byte offsets into ``data``; words of text i are ``first[i]`` to ``first[i + 1]``.
    A hash depends on the bytes of the word alone, so it is the same on every machine.
    """

    def __init__(self, texts: list[bytes]):
        self.data = np.frombuffer(b" ".join([b"", *texts, b" " * _PADDING]), np.uint8)
        #: The 8 bytes from every offset on, as a number; a view, not a copy.
        self._blocks = np.ndarray((len(self.data) - _PADDING + 1,), "<u8", buffer=self.data, strides=(1,))
        space = _SPACE[self.data]
        turn = np.flatnonzero(space[1:] != space[:-1]) + 1
        self.start, self.end = turn[0::2], turn[1::2]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        bounds = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(sizes + 1, out=bounds[1:])
        self.first = np.searchsorted(self.start, bounds)

    def hashes(self, start: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """64-bit hashes of the words, or of other byte ranges.

        The bytes are taken in 8 at a time, with a mixing of all bits after each, for all words at once; there is no
        arithmetic relation between words that have one hash. A long word is hashed by BLAKE2b.
        """
        start = self.start if start is None else start
        end = self.end if end is None else end
        size = end - start
        value = mix(size.astype(np.uint64) + _SEED)
        for i in np.flatnonzero(size > _LONG):
            value[i] = int.from_bytes(hashlib.blake2b(self.data[start[i] : end[i]].tobytes(), digest_size=8).digest(), "little")
        left, done = np.flatnonzero((size > 0) & (size <= _LONG)), 0
        while len(left):
            block = self.block(start[left] + done, size[left] - done)
            value[left] = mix((value[left] ^ block) * _STEP + np.uint64(done))
            done += 8
            left = left[size[left] > done]
        return value

    def block(self, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Up to 8 bytes from these offsets on, as numbers."""
        return self._blocks[at] & _MASKS[np.minimum(size, 8)]

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the words with these numbers have the same bytes, pair by pair."""
        size = self.end[a] - self.start[a]
        equal = size == self.end[b] - self.start[b]
        left, done = np.flatnonzero(equal), 0
        while len(left):
            rest = size[left] - done
            alike = self.block(self.start[a[left]] + done, rest) == self.block(self.start[b[left]] + done, rest)
            equal[left[~alike]] = False
            done += 8
            left = left[alike & (rest > 8)]
        return equal

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
