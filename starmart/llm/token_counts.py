"""Greedy word-piece lengths by a longest-match automaton.

A word with a space before it is cut, from its start, into the longest tokens of a vocabulary of byte strings.
The automaton is the trie of the vocabulary. Every node has a failure link and the number of tokens that are cut
off when it is followed, both worked out once, so a word is measured in time linear in its bytes and no piece is
ever built. A word that can't be cut to its end counts as one token.

Words are runs of bytes other than x20 and x09-x0D. Null, empty and blank texts have 0 words and 0 tokens. Columns
other than the text are never read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from starmart.llm.byte_bpe import Recent, read_ranks
from starmart.llm.resident import hold


class LongestMatch:
    """The automaton of a vocabulary."""

    def __init__(self, vocabulary: Iterable[bytes]):
        self.child: dict[int, int] = {}
        parent, last, token = [0], [0], [False]
        for word in vocabulary:
            at = 0
            for byte in word:
                to = self.child.get(at << 8 | byte)
                if to is None:
                    to = self.child[at << 8 | byte] = len(parent)
                    parent.append(at)
                    last.append(byte)
                    token.append(False)
                at = to
            token[at] = at > 0
        depth = [0] * len(parent)
        for at in range(1, len(parent)):
            depth[at] = depth[parent[at]] + 1
        #: Node to go on from when no child fits (-1: there is none), and the tokens cut off on the way.
        self.link, self.popped = [-1] * len(parent), [0] * len(parent)
        for at in sorted(range(1, len(parent)), key=depth.__getitem__):
            if token[at]:
                self.link[at], self.popped[at] = 0, 1
                continue
            to, popped = self.link[parent[at]], self.popped[parent[at]]
            while to >= 0 and (to << 8 | last[at]) not in self.child:
                popped += self.popped[to]
                to = self.link[to]
            if to >= 0:
                self.link[at], self.popped[at] = self.child[to << 8 | last[at]], popped
        self.words = Recent(self.length)

    def length(self, word: bytes) -> int:
        """Tokens of a word with a space before it."""
        child, link, popped = self.child, self.link, self.popped
        at = count = 0
        for byte in b" " + word:
            to = child.get(at << 8 | byte)
            while to is None:
                count += popped[at]
                at = link[at]
                if at < 0:
                    return 1
                to = child.get(at << 8 | byte)
            at = to
        while at > 0:
            count += popped[at]
            at = link[at]
        return 1 if at < 0 else count

    def count(self, text: str) -> tuple[int, int]:
        """Words and tokens of a text."""
        words = text.encode("utf-8", "replace").split()
        return len(words), sum(map(self.words.__getitem__, words))


def _load(path: str) -> LongestMatch:
    return hold(("token_counts", path), lambda: LongestMatch(read_ranks(path)))


def count_tokens(path: str) -> Callable[[Column], Column]:
    """A function from a text column to a struct of ``n_words`` and ``n_tokens`` by the vocabulary of a rank file."""

    @F.pandas_udf("n_words long, n_tokens long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = _load(path)
        for batch in batches:
            counts = [automaton.count(t or "") for t in batch]
            yield pd.DataFrame(counts, columns=["n_words", "n_tokens"], dtype="int64")

    return run
