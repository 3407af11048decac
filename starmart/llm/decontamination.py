"""Words of documents that occur in a benchmark, by Wu-Manber search.

Words are runs of letters and digits: bytes 0-9, a-z (after lower-casing A-Z) and everything beyond ASCII. A window is
any 10 consecutive words of a benchmark item; an item of fewer words is one window, and one without words has none.
Windows are written as their words with one space before, between and after them, documents likewise, so that a
window is in a document exactly where its text is.

The windows are counted before any of them is collected. ``BLOCK_BYTES`` of them at a time are broadcast, each with
its items, and searched for in all documents; the documents of a larger benchmark are written and read again between
the blocks. So every window is searched for, whatever the size of the benchmark, and no worker holds more than
one block. Nothing of the documents is shuffled. A text is worked on as a whole, in about 10 bytes a byte.

Null texts have no words. An item without an id counts as one whose id is the empty text; items that share an id count
as one item with the windows of each. Repeated documents get the same result each; an empty table an empty result, and
with an empty benchmark nothing is hit. Columns other than the texts and the items' ids are only carried along.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.arrays import slices
from starmart.llm.columns import free_name
from starmart.llm.places import written
from starmart.llm.resident import hold
from starmart.llm.wu_manber import PADDING, WuManber

WORDS = 10
#: Bytes of windows and items that are broadcast at a time.
BLOCK_BYTES = 16 << 20
_SLICE = 4 << 20
_SPACE = 0x20
#: Bytes of words in lower case; all others are spaces.
_LETTER = np.full(256, _SPACE, np.uint8)
for _b in [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]:
    _LETTER[_b] = _b
_LETTER[0x41:0x5B] = np.arange(0x61, 0x7B)


class Normal:
    """Texts with one space between words, and two at least between texts.

    ``words`` has the place of each word, and the words of text i are ``first[i]`` to ``first[i + 1]``.
    """

    def __init__(self, texts: list[bytes]):
        raw = _LETTER[np.frombuffer(b"  ".join([b"", *texts, b""]), np.uint8)]
        word = raw != _SPACE
        begins = word.copy()
        begins[1:] &= ~word[:-1]
        border = np.cumsum([0, *[len(t) + 2 for t in texts]])
        counts = np.add.reduceat(begins, border[:-1], dtype=np.int64) if texts else np.empty(0, np.int64)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        keep = word
        keep[1:] |= word[:-1].copy()  # the first space after a word stays
        keep[border] = keep[border + 1] = True
        size = int(np.count_nonzero(keep))
        self.data = np.zeros(size + PADDING, np.uint8)
        self.data[:size] = raw[keep]
        self.words = np.flatnonzero(begins[keep])


def windows_of(text: str | None, words: int = WORDS) -> list[bytes]:
    """The distinct windows of an item."""
    all_words = _LETTER[np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)].tobytes().split()
    if not all_words:
        return []
    count = max(1, len(all_words) - words + 1)
    return sorted({b" " + b" ".join(all_words[i : i + words]) + b" " for i in range(count)})


def window_table(benchmark: DataFrame, *, id: str = "item_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """(window, item), each pair once, written to the shared folder."""

    @F.pandas_udf("array<binary>")
    def windows(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([windows_of(t, words) for t in batch], dtype=object)

    item = F.coalesce(F.col(id).cast("string"), F.lit("")).alias("item")
    rows = benchmark.select(item, windows(F.col(text)).alias("windows"))
    return written(rows.select(F.explode("windows").alias("window"), "item").distinct(), "windows")


class Searcher:
    """Windows and the items that they are of."""

    def __init__(self, pairs: list[tuple[bytes, str]]):
        items: dict[bytes, list[str]] = {}
        for window, item in pairs:
            items.setdefault(window, []).append(item)
        windows = sorted(items)
        self.items = [items[w] for w in windows]
        self.sizes = np.array([w.count(b" ") - 1 for w in windows], np.int64)
        self.search = WuManber(windows)

    def run(self, texts: list[bytes]) -> list[tuple[int, list[int], list[int], list[str]]]:
        """Words, first and last words of the disjoint spans that are hit, and items, of each text."""
        normal = Normal(texts)
        found = [(int(n), [], [], []) for n in np.diff(normal.first)]
        place, window = self.search.find(normal.data)
        begin = np.searchsorted(normal.words, place + 1)
        end = begin + self.sizes[window]
        text = np.searchsorted(normal.first, begin, "right") - 1
        for i, w in np.unique(np.stack([text, window]), axis=1).T:
            found[i][3].extend(self.items[w])
        order = np.argsort(begin, kind="stable")
        begin, end, text = begin[order], np.maximum.accumulate(end[order]), text[order]
        fresh = np.ones(len(begin), bool)
        fresh[1:] = (begin[1:] > end[:-1]) | (text[1:] != text[:-1])
        final = np.ones(len(begin), bool)
        final[:-1] = fresh[1:]
        for i, a, b in zip(text[fresh], begin[fresh], end[final]):
            found[i][1].append(int(a - normal.first[i]))
            found[i][2].append(int(b - normal.first[i]) - 1)
        return [(n, first, last, sorted(set(items))) for n, first, last, items in found]


def _load(name: str, block: Broadcast) -> Searcher:
    return hold(("decontamination", name), lambda: Searcher(block.value))


def _merged(first: list, last: list, before: dict | None) -> tuple[list[int], list[int]]:
    """Disjoint spans that cover what these and the earlier ones do."""
    if not before or not len(before["first"]):
        return first, last
    spans: list[list[int]] = []
    for a, b in sorted([*zip(first, last), *zip(before["first"], before["last"])]):
        if spans and a <= spans[-1][1] + 1:
            spans[-1][1] = max(spans[-1][1], int(b))
        else:
            spans.append([int(a), int(b)])
    return [a for a, _ in spans], [b for _, b in spans]


_FOUND = "n_words long, first array<long>, last array<long>, items array<string>"


def searcher(block: Broadcast) -> Callable[[Column, Column], Column]:
    """A function from a text and what earlier blocks found in it to what all of them find."""
    name = uuid.uuid4().hex

    @F.pandas_udf(_FOUND)
    def run(batches: Iterator[tuple[pd.Series, pd.DataFrame]]) -> Iterator[pd.DataFrame]:
        search = _load(name, block)
        for texts, before in batches:
            raw = [(t or "").encode("utf-8", "replace") for t in texts]
            rows = []
            for low, high in slices(raw, _SLICE):
                rows += search.run(raw[low:high])
            earlier = before.to_dict("records") if before["n_words"].notna().any() else [None] * len(rows)
            done = []
            for (n, first, last, items), old in zip(rows, earlier):
                first, last = _merged(first, last, old)
                done.append((n, first, last, sorted({*items, *(old["items"] if old else ())})))
            yield pd.DataFrame(done, columns=["n_words", "first", "last", "items"])

    return run


def find_windows(docs: DataFrame, windows: DataFrame, found: str = "found", *, text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with a column (n_words, first, last, items): the first and last words, counted from 0, of the disjoint
    spans of words that are in windows, and the ids of the items whose windows there are, in order and each once."""
    if found.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"there is a column {found}")
    spark = docs.sparkSession
    size = F.octet_length("window") + F.octet_length("item") + 16
    held = windows.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    blocks = max(1, -(-held // block_bytes))
    dealt = windows.withColumn("block", F.pmod(F.xxhash64("window", "item"), F.lit(blocks)))
    column = free_name(docs, "before")
    docs = docs.withColumn(column, F.lit(None).cast(f"struct<{', '.join(c.replace(' ', ': ', 1) for c in _FOUND.split(', '))}>"))
    for number in range(blocks):
        pairs = [(bytes(r.window), r.item) for r in dealt.filter(F.col("block") == number).select("window", "item").collect()]
        docs = docs.withColumn(column, searcher(spark.sparkContext.broadcast(pairs))(F.col(text), F.col(column)))
        if number < blocks - 1:
            docs = written(docs, "searched")
    return docs.withColumnRenamed(column, found)


def n_hit(found: Column) -> Column:
    """Words in the spans."""
    sizes = F.zip_with(found["first"], found["last"], lambda a, b: b - a + 1)
    return F.aggregate(sizes, F.lit(0).cast("long"), lambda total, n: total + n)
