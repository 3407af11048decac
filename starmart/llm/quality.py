"""Quality by positive-unlabelled learning on the make-up of a text.

A text is described by shares of its characters and words, such as capitals, symbols and repeated words. Trusted
positives and unlabelled rows of the corpus fit a linear classifier with the non-negative unbiased risk; the class
prior is the share of 1 among the labels.

Null and empty texts are described by zeros and scored as such. Without any label 1 every text gets the prior's
score. Repeated rows get equal scores. Columns other than the text are never read for a score.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm import pu_learning
from starmart.llm.arrays import Words, slices

#: Bounds of the sample that the classifier is fitted on.
POSITIVES, UNLABELLED = 4000, 8000
SLICE_BYTES = 1 << 19

_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_LOWER = np.zeros(256, bool)
_LOWER[0x61:0x7B] = True
_LOWER[0x80:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
_PLAIN = np.zeros(256, bool)
_PLAIN[[ord(c) for c in ".,;:'\"-()?"]] = True
_SYMBOL = ~(_UPPER | _LOWER | _DIGIT | _PLAIN)
_SYMBOL[:0x21] = False


def _by_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return (total[bounds[1:]] - total[bounds[:-1]]).astype(float)


def describe(texts: list[bytes]) -> np.ndarray:
    """One row of numbers for each text of a slice."""
    words = Words(texts)
    data, first, owner = words.data, words.first, words.owner()
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begin = 1 + np.concatenate([[0], np.cumsum(sizes + 1)])
    bytes_of = lambda kind: _total(kind[data], begin, sizes)
    count = np.diff(first).astype(float)
    some, chars = np.maximum(count, 1), np.maximum(bytes_of(~_SPACES), 1)
    hashes = words.hashes()
    again = np.zeros(len(hashes), bool)
    if len(hashes):
        again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    order = np.lexsort((hashes, owner))
    new = np.ones(len(hashes), bool)
    if len(hashes):
        new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    distinct = np.bincount(owner[order][new], minlength=len(texts)) if len(hashes) else np.zeros(len(texts))
    symbol_at = np.concatenate([[0], np.cumsum(_SYMBOL[data], dtype=np.int64)])
    upper_at = np.concatenate([[0], np.cumsum(_UPPER[data], dtype=np.int64)])
    length = words.end - words.start
    marked = symbol_at[words.end] > symbol_at[words.start]
    bare = symbol_at[words.end] - symbol_at[words.start] == length
    shouted = (upper_at[words.end] - upper_at[words.start] >= 0.5 * length) & (length > 1)
    upper, symbol = bytes_of(_UPPER), bytes_of(_SYMBOL)
    shares = [
        upper / chars,
        symbol / chars,
        bytes_of(_DIGIT) / chars,
        bytes_of(_PLAIN) / chars,
        _by_text(again, first) / some,
        _by_text(marked, first) / some,
        _by_text(bare, first) / some,
        _by_text(shouted, first) / some,
        np.minimum(some, 200) / 200 * (1 - distinct / some) * (count > 0),
        np.minimum(_by_text(length, first) / some, 20) / 20,
    ]
    # Besides each share, whether it is clearly there at all: a text is spoilt by a part of it.
    there = [np.minimum(s, 0.1) * 10 for s in (shares[0], shares[1], shares[4], shares[5], shares[6], shares[7])]
    return np.stack([*shares, *there, np.log1p(count) / 10, np.minimum(count, 8) / 8], axis=1)


_SPACES = np.zeros(256, bool)
_SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _total(flags: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return (total[begin[:-1] + sizes] - total[begin[:-1]]).astype(float)


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    linear: pu_learning.Linear

    def score(self, texts: list[bytes]) -> np.ndarray:
        return self.linear.probability((describe(texts) - self.mean) / self.scale)


def _described(texts: Iterator[str | None]) -> np.ndarray:
    data = [(t or "").encode("utf-8", "replace") for t in texts]
    parts = [describe(data[a:b]) for a, b in slices(data, SLICE_BYTES)]
    return np.concatenate(parts) if parts else np.zeros((0, len(describe([b""])[0])))


def fit(
    docs: DataFrame, labels: DataFrame, train: Column, *, label: str = "quality", id: str = "doc_id", text: str = "text"
) -> QualityModel:
    """Fit on a sample of at most ``POSITIVES`` rows with label 1 and ``UNLABELLED`` rows of the corpus."""

    @F.pandas_udf("array<double>")
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(list(_described(batch)), dtype=object)

    rows, prior = pu_learning.training_rows(
        docs, labels, label, train, positives=POSITIVES, unlabelled=UNLABELLED, id=id, text=text
    )
    found = rows.select("positive", features("text").alias("x")).collect()
    found.sort(key=lambda r: (r["positive"], r["x"]))
    positive = np.array([r["positive"] for r in found], bool)
    x = np.array([r["x"] for r in found]) if found else np.zeros((0, describe([b""]).shape[1]))
    mean = x.mean(axis=0) if found else np.zeros(x.shape[1])
    scale = x.std(axis=0) + 1e-3 if found else np.ones(x.shape[1])
    x = (x - mean) / scale
    return QualityModel(mean, scale, pu_learning.fit(x[positive], x[~positive], prior))


def score(model: QualityModel) -> Callable[[Column], Column]:
    """A function from a text column to the probability that the label is 1."""

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(model.linear.probability((_described(batch) - model.mean) / model.scale))

    return run
