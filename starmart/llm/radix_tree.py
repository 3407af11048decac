"""An adaptive radix tree over keys of fixed-width ids, and the totals of its id-aligned prefixes.

A key is the concatenation of big-endian ids of ``WIDTH`` bytes. Inner nodes of the tree hold the bytes that all keys
below them share (path compression) and one of four layouts for what follows, which grow as children come: 4 or 16
children in sorted lists of bytes, 48 children behind an index of 256 bytes, or 256 places. Only prefixes whose
length is a multiple of ``WIDTH`` are nodes of the trie that is reported; one inner node may cover several of them, or
none.

A tree is built over a run of neighbours in the order of all keys. The prefixes of its first and of its last key may
go on in the neighbouring runs: they stay **open**, and what lies below them is summed up in ``Border`` paths, which
are the keys of the next, smaller tree. All other prefixes are final.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from dataclasses import dataclass, field

WIDTH = 8


class _Sorted:
    """Children by their bytes in a sorted list, up to a size."""

    __slots__ = ("bytes", "nodes")
    size = 4

    def __init__(self, items=()):
        self.bytes, self.nodes = bytearray(b for b, _ in items), [n for _, n in items]

    def get(self, byte):
        i = self.bytes.find(byte)
        return None if i < 0 else self.nodes[i]

    def put(self, byte, node):
        i = bisect_left(self.bytes, byte)
        if i < len(self.bytes) and self.bytes[i] == byte:
            self.nodes[i] = node
        elif len(self.nodes) < self.size:
            self.bytes.insert(i, byte)
            self.nodes.insert(i, node)
        else:
            return self.larger(list(self.items())).put(byte, node)
        return self

    def items(self):
        return zip(self.bytes, self.nodes)

    def larger(self, items):
        return Layout16(items)


class Layout4(_Sorted):
    __slots__ = ()


class Layout16(_Sorted):
    __slots__ = ()
    size = 16

    def larger(self, items):
        return Layout48(items)


class Layout48:
    """Up to 48 children; an index tells for each byte the place of its child."""

    __slots__ = ("index", "nodes")
    _none = 255

    def __init__(self, items):
        self.index, self.nodes = bytearray([self._none]) * 256, []
        for byte, node in items:
            self.put(byte, node)

    def get(self, byte):
        i = self.index[byte]
        return None if i == self._none else self.nodes[i]

    def put(self, byte, node):
        i = self.index[byte]
        if i != self._none:
            self.nodes[i] = node
        elif len(self.nodes) < 48:
            self.index[byte] = len(self.nodes)
            self.nodes.append(node)
        else:
            return Layout256(self.items()).put(byte, node)
        return self

    def items(self):
        return ((b, self.nodes[i]) for b, i in enumerate(self.index) if i != self._none)


class Layout256:
    __slots__ = ("nodes",)

    def __init__(self, items):
        self.nodes = [None] * 256
        for byte, node in items:
            self.nodes[byte] = node

    def get(self, byte):
        return self.nodes[byte]

    def put(self, byte, node):
        self.nodes[byte] = node
        return self

    def items(self):
        return ((b, n) for b, n in enumerate(self.nodes) if n is not None)


class _Node:
    """Bytes ``start`` to ``start + len(prefix)`` of the keys below; the byte before them led here."""

    __slots__ = ("start", "prefix", "children", "sample", "own", "open")

    def __init__(self, start, prefix, sample):
        self.start, self.prefix, self.sample = start, prefix, sample
        self.children, self.own, self.open = None, {}, False

    @property
    def end(self):
        return self.start + len(self.prefix)

    def depths(self):
        """Ids of the prefixes that the node covers, the longest first."""
        return range(self.end // WIDTH, -(-self.start // WIDTH) - 1, -1)


@dataclass(slots=True)
class Part:
    """Totals of a prefix without those of its open continuation."""

    members: int = 0
    least: int = 0  # of the members, if any
    children: int = 0
    leaves: int = 0
    saved: int = 0
    ends: str | None = None  # what the key that ends here carries

    def add(self, other: Part) -> None:
        if other.members:
            self.least = min(self.least, other.least) if self.members else other.least
        self.members += other.members
        self.children += other.children
        self.leaves += other.leaves
        self.saved += other.saved
        self.ends = self.ends if other.ends is None else other.ends


@dataclass(slots=True)
class Prefix:
    """A final node of the trie. ``parent`` is the least member of the parent, if the parent is final; else ``open_parent``
    is its digest."""

    depth: int
    total: Part
    last_id: int
    digest: bytes | None
    parent: int | None = None
    open_parent: bytes | None = None


@dataclass(slots=True)
class Border:
    """The first or the last key of a run, with the parts of its prefixes by their number of ids."""

    key: bytes
    weights: list[int]
    parts: list[Part]


@dataclass
class _Below:
    """Of the final nodes below an inner node: their totals, and those without a parent yet."""

    total: Part = field(default_factory=Part)
    hanging: list[Prefix] = field(default_factory=list)

    def add(self, other: _Below) -> None:
        self.total.add(other.total)
        self.hanging += other.hanging


class RadixTree:
    def __init__(self):
        self.root: _Node | None = None
        self._paths: list[Border] = []
        self._first: bytes | None = None
        self._last: bytes | None = None

    def insert(self, key: bytes, weights: list[int], part: Part) -> None:
        """A key that ``part.members`` sequences end with; ``weights[i]`` belongs to its i-th id."""
        end = self._place(key, weights)
        end.own.setdefault(len(key) // WIDTH, Part()).add(part)

    def insert_path(self, path: Border) -> None:
        self._place(path.key, path.weights)
        self._paths.append(path)

    def _place(self, key: bytes, weights: list[int]) -> _Node:
        self._first = key if self._first is None else min(self._first, key)
        self._last = key if self._last is None else max(self._last, key)
        if self.root is None:
            self.root = _Node(0, key, (key, weights))
            return self.root
        above, node = None, self.root
        while True:
            have, end = node.prefix, node.end
            if key[node.start : end] != have:
                node = self._split(above, node, key)
                end = node.end
            if len(key) == end:
                return node
            step = key[end]
            child = node.children.get(step) if node.children else None
            if child is None:
                child = _Node(end + 1, key[end + 1 :], (key, weights))
                node.children = (node.children or Layout4()).put(step, child)
                return child
            above, node = node, child

    def _split(self, above: _Node | None, node: _Node, key: bytes) -> _Node:
        """A new node for the bytes that the node shares with the key; the node goes below it."""
        have, rest = node.prefix, key[node.start :]
        same = next((i for i, (a, b) in enumerate(zip(have, rest)) if a != b), min(len(have), len(rest)))
        upper = _Node(node.start, have[:same], node.sample)
        if above is None:
            self.root = upper
        else:
            above.children = above.children.put(key[node.start - 1], upper)
        upper.children = Layout4().put(have[same], node)
        node.start, node.prefix = upper.end + 1, have[same + 1 :]
        return upper

    def _along(self, key: bytes):
        node = self.root
        while True:
            yield node
            if node.end == len(key):
                return
            node = node.children.get(key[node.end])

    def totals(self, last_run: bool, digests: bool) -> tuple[list[Prefix], list[Border]]:
        """The final prefixes, and the border paths unless this is the only run.

        ``digests`` gives every final prefix its digest, by which nodes of earlier runs look for their parent.
        """
        if self.root is None:
            return [], []
        for path in self._paths:
            for node in self._along(path.key):
                for depth in node.depths():
                    node.own.setdefault(depth, Part()).add(path.parts[depth])
        edges: list[Border] = []
        if not last_run:
            for key in dict.fromkeys([self._first, self._last]):
                for node in self._along(key):
                    node.open = True
                    weights = node.sample[1]
                edges.append(Border(key, list(weights[: len(key) // WIDTH]), [Part() for _ in range(len(key) // WIDTH + 1)]))
        named = {edge.key: _digests(edge.key) for edge in edges}
        final: list[Prefix] = []
        done: dict[int, _Below] = {}
        stack = [(self.root, False)]
        while stack:
            node, ready = stack.pop()
            children = [child for _, child in node.children.items()] if node.children else []
            if not ready:
                stack.append((node, True))
                stack += [(child, False) for child in children]
                continue
            below = _Below()
            for child in children:
                below.add(done.pop(id(child)))
            done[id(node)] = self._cover(node, below, final, edges, named, digests)
        return final, edges

    def _cover(self, node: _Node, below: _Below, final: list, edges: list, named: dict, digests: bool) -> _Below:
        """Reports the prefixes that an inner node covers, from the longest; returns what hangs from above them."""
        key, weights = node.sample
        names = None
        for depth in node.depths():
            total = node.own.get(depth) or Part()
            total.add(below.total)
            if node.open:
                edge = next(e for e in edges if e.key.startswith(key[: depth * WIDTH]))
                edge.parts[depth].add(total)
                for child in below.hanging:
                    child.open_parent = named[edge.key][depth]
                below = _Below()
                continue
            total.leaves += total.children == 0
            total.saved += (total.members - 1) * weights[depth - 1] if depth else 0
            if digests and names is None:
                names = _digests(key[: node.end - node.end % WIDTH])
            last = int.from_bytes(key[(depth - 1) * WIDTH : depth * WIDTH], "big") if depth else 0
            prefix = Prefix(depth, total, last, names[depth] if digests else None)
            for child in below.hanging:
                child.parent = total.least
            final.append(prefix)
            below = _Below(Part(total.members, total.least, 1, total.leaves, total.saved), [prefix])
        return below


def _digests(key: bytes) -> list[bytes]:
    """SHA-256 of the prefixes of a key by their number of ids."""
    digest = hashlib.sha256()
    found = [digest.digest()]
    for i in range(0, len(key), WIDTH):
        digest.update(key[i : i + WIDTH])
        found.append(digest.copy().digest())
    return found
