"""Sets of word shingles and their MinHash signatures, for many texts at a time.

Words are runs of bytes other than x20 and x09-x0D of the text with A-Z in lower case. A text's set holds its
distinct runs of ``words`` words; with fewer words, the whole sequence as one; without words it is empty. Sets hold
64-bit hashes of the shingles; ``told_apart`` compares the bytes behind them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from starmart.llm.arrays import Words, mix

_STEP = np.uint64(0xD6E8FEB86659FD93)


def _hash_constants(count: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return seeds[:count] | np.uint64(1), seeds[count:]


@dataclass(frozen=True)
class Sets:
    """Sorted distinct shingle hashes of text i: ``values[bounds[i]:bounds[i + 1]]``."""

    values: np.ndarray
    bounds: np.ndarray

    def sizes(self) -> np.ndarray:
        return np.diff(self.bounds)

    def of(self, i: int) -> np.ndarray:
        return self.values[self.bounds[i] : self.bounds[i + 1]]


def as_bytes(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "replace").lower()


@dataclass(frozen=True)
class _Shingles:
    """The runs of words of a few texts: number of the first word, words, text, and hash of each run."""

    words: Words
    start: np.ndarray
    length: np.ndarray
    owner: np.ndarray
    values: np.ndarray


def _shingles(texts: list[bytes], words: int) -> _Shingles:
    found = Words(texts)
    hashes, first = found.hashes(), found.first
    counts = np.diff(first)
    taken = np.where(counts >= words, counts - words + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(taken)])
    owner = np.repeat(np.arange(len(texts)), taken)
    start = first[owner] + np.arange(bounds[-1]) - bounds[owner]
    length = np.minimum(counts[owner], words)
    values = length.astype(np.uint64)
    for k in range(words):
        at = np.minimum(start + k, max(len(hashes) - 1, 0))
        values = np.where(k < length, mix(values * _STEP + hashes[at]), values) if len(hashes) else values
    return _Shingles(found, start, length, owner, values)


def told_apart(texts: list[bytes], words: int) -> bool:
    """Whether no two different shingles of the texts have one hash, so that the sizes of their sets, and of what
    they have in common, are exact."""
    s = _shingles(texts, words)
    order = np.argsort(s.values, kind="stable")
    alike = s.values[order][1:] == s.values[order][:-1]
    a, b = order[:-1][alike], order[1:][alike]
    if (s.length[a] != s.length[b]).any():
        return False
    for k in range(words):
        on = s.length[a] > k
        if not s.words.same(s.start[a[on]] + k, s.start[b[on]] + k).all():
            return False
    return True


def true_set(text: bytes, words: int) -> set:
    """The set of a text, shingle by shingle."""
    found = text.split()
    if len(found) < words:
        return {tuple(found)} if found else set()
    return set(zip(*(found[k:] for k in range(words))))


def shingle_sets(texts: list[bytes], words: int) -> Sets:
    """The sets of a slice of texts, as ``as_bytes`` gives them."""
    found = _shingles(texts, words)
    owner, values = found.owner, found.values
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    sizes = np.bincount(owner[new], minlength=len(texts))
    return Sets(values[new], np.concatenate([[0], np.cumsum(sizes)]))


def signatures(sets: Sets, count: int) -> np.ndarray:
    """The least 32-bit hash of each set by each of ``count`` hash functions; all ones for an empty set."""
    full = sets.sizes() > 0
    out = np.full((count, len(full)), 0xFFFFFFFF, np.uint32)
    if full.any():
        at = sets.bounds[:-1][full]
        for k, (factor, shift) in enumerate(zip(*_hash_constants(count))):
            hashed = ((sets.values * factor + shift) >> np.uint64(32)).astype(np.uint32)
            out[k, full] = np.minimum.reduceat(hashed, at)
    return np.ascontiguousarray(out.T)
