"""Wu-Manber search for many byte strings at once, over arrays of positions.

The strings are put into classes by their length, so that short ones don't slow down the search for long ones. In a
class, the first ``least`` bytes of each string count, ``least`` being the shortest length. A **shift table** over
hashed blocks of up to 8 bytes tells how far the end of a window may move on without missing a string: the distance of
the block's last occurrence in any string to the end of the window, or the whole window if it occurs in none. Where
the shift is 0, the **suffix-hash buckets** name the strings that end (in their first ``least`` bytes) with a block of
this hash, and the bytes are **compared directly**. Equal hashes of different blocks only make a shift shorter or a
bucket longer, so the result is exact.

The text is cut into lanes whose windows move on side by side, one step of all lanes at a time.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np

#: Bytes of a lane, and pairs of a position and a string that are compared at a time.
LANE, PAIRS = 1024, 1 << 16
#: Bits of a hash at most; the table then has 16 MB.
MOST_BITS = 24
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Zero bytes behind a text, so that a block can be read at any of its places.
PADDING = 8
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)


def blocks_of(data: np.ndarray) -> np.ndarray:
    """Little-endian numbers of 8 bytes at every place of a padded text, without a copy."""
    return np.ndarray((len(data) - PADDING + 1,), "<u8", buffer=data, strides=(1,))


class _Class:
    """Strings of similar lengths."""

    def __init__(self, strings: list[bytes], numbers: list[int]):
        self.numbers = np.array(numbers, np.int64)
        sizes = np.array([len(s) for s in strings], np.int64)
        self.least = int(sizes.min())
        self.block = min(8, self.least)
        self.mask = _MASKS[self.block]
        joined = np.frombuffer(b"".join(strings) + bytes(PADDING), np.uint8)
        self.text, self.sizes = blocks_of(joined), sizes
        self.starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        places = self.least - self.block + 1
        bits = min(MOST_BITS, max(12, (8 * len(strings) * places).bit_length()))
        self.drop = np.uint64(64 - bits)
        self.shift = np.full(1 << bits, min(places, 255), np.uint8)
        for place in range(places):  # ascending, so that the last occurrence stays
            distance = min(places - 1 - place, 255)
            at = self._hash(self.text[self.starts + place])
            self.shift[at] = np.minimum(self.shift[at], distance)
        suffix = self._hash(self.text[self.starts + places - 1])
        self.order = np.argsort(suffix, kind="stable")
        self.suffix = suffix[self.order]
        self.head = self.text[self.starts] & self.mask

    def _hash(self, blocks: np.ndarray) -> np.ndarray:
        return ((blocks & self.mask) * _ODD) >> self.drop

    def find(self, blocks: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, strings): where in a text of this size strings begin."""
        found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        lane = max(LANE, 4 * self.least)
        at = np.arange(0, max(size - self.least + 1, 0), lane, dtype=np.int64)
        stop = np.minimum(at + lane, size - self.least + 1)
        last = self.least - self.block  # of a window: the place of its last block
        while len(at):
            hashed = self._hash(blocks[at + last])
            step = self.shift[hashed]
            here = step == 0
            if here.any():
                found += self._compare(blocks, size, at[here], hashed[here])
            at = at + np.maximum(step, 1)
            on = at < stop
            at, stop = at[on], stop[on]
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def _compare(self, blocks: np.ndarray, size: int, at: np.ndarray, hashed: np.ndarray):
        """Strings of the buckets that are in the text at these places."""
        low = np.searchsorted(self.suffix, hashed, "left")
        many = np.searchsorted(self.suffix, hashed, "right") - low
        ends = np.cumsum(many)
        for first in range(0, int(ends[-1]) if len(ends) else 0, PAIRS):
            pair = np.arange(first, min(first + PAIRS, ends[-1]))
            who = np.searchsorted(ends, pair, "right")
            string = self.order[low[who] + pair - (ends[who] - many[who])]
            place = at[who]
            same = (blocks[place] & self.mask == self.head[string]) & (place + self.sizes[string] <= size)
            place, string = place[same], string[same]
            done, left = 0, np.arange(len(place))
            while len(left):
                rest = self.sizes[string[left]] - done
                mask = _MASKS[np.clip(rest, 0, 8)]
                inside = rest > 0
                mine = blocks[np.where(inside, place[left] + done, 0)] & mask
                theirs = self.text[np.where(inside, self.starts[string[left]] + done, 0)] & mask
                equal = ~inside | (mine == theirs)
                string[left[~equal]] = -1
                left = left[equal & inside]
                done += 8
            yield place[string >= 0], self.numbers[string[string >= 0]]


class WuManber:
    """Search for a list of strings; none may be empty, and none should be there twice."""

    def __init__(self, strings: list[bytes]):
        classes = defaultdict(list)
        for number, string in enumerate(strings):
            if not string:
                raise ValueError("an empty string is everywhere")
            classes[len(string).bit_length()].append(number)
        self.classes = [_Class([strings[i] for i in numbers], numbers) for _, numbers in sorted(classes.items())]

    def find(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, strings) of all occurrences in a text of bytes with ``PADDING`` zero bytes behind it."""
        blocks, size = blocks_of(data), len(data) - PADDING
        found = [c.find(blocks, size) for c in self.classes] or [(np.empty(0, np.int64),) * 2]
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
