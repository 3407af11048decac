"""Toxicity by non-negative positive-unlabelled learning on words.

A text is the set of its words (letters in lower case, without punctuation at the ends) and of their beginnings.
Those that confirmed toxic texts have far more often than the corpus are kept, by counts over the sample that
Spark makes; a linear classifier over them is fitted with the non-negative risk, corrected for the class prior.

Null and empty texts have no words and get the score of a text without any mark. Without any label 1 every text
gets the prior's score. Repeated rows get equal scores. Columns other than the text are never read for a score.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm import pu_learning
from starmart.llm.arrays import Words, mix, slices

#: Bounds of the sample that the classifier is fitted on.
POSITIVES, UNLABELLED = 4000, 8000
#: Words and beginnings of words kept: at most so many, each in so many positives and this surely more often there.
MARKS, LEAST_POSITIVES, LEAST_DEVIATIONS = 1024, 3, 4.0
#: Share of texts with the mark that must be toxic, as estimated from the prior.
LEAST_PRECISION = 0.4
#: Bytes of the beginnings of words.
PREFIXES = (4, 5, 6, 7)
SLICE_BYTES = 1 << 19

_INNER = np.zeros(256, bool)
_INNER[0x30:0x3A] = _INNER[0x41:0x5B] = _INNER[0x61:0x7B] = _INNER[0x80:] = True


def marks_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the distinct words and beginnings of words of a slice of texts, sorted."""
    words = Words([t.lower().encode("utf-8", "replace") for t in texts])
    owner = words.owner()
    inside = _INNER[words.data]
    after = np.concatenate([np.flatnonzero(inside), [len(inside)]])
    rank = np.concatenate([[0], np.cumsum(inside)])
    start = np.minimum(after[rank[words.start]], words.end)
    end = np.maximum(np.where(rank[words.end] > 0, after[rank[words.end] - 1] + 1, 0), start)
    kept = end > start
    owner, start, end = owner[kept], start[kept], end[kept]
    owners, hashes = [owner], [words.hashes(start, end)]
    for size in PREFIXES:
        long = end - start > size
        owners.append(owner[long])
        hashes.append(mix(words.hashes(start[long], start[long] + size) + np.uint64(size)))
    owner, found = np.concatenate(owners), np.concatenate(hashes).view(np.int64)
    order = np.lexsort((found, owner))
    owner, found = owner[order], found[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    return owner[new], found[new]


@dataclass(frozen=True)
class ToxicityModel:
    """Sorted hashes of the marks, and the classifier over them."""

    marks: np.ndarray
    linear: pu_learning.Linear

    def presence(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(text, mark) pairs, marks by position."""
        owner, found = marks_of(texts)
        at = np.searchsorted(self.marks, found)
        at[at == len(self.marks)] = 0
        hit = self.marks[at] == found if len(self.marks) else np.zeros(len(found), bool)
        return owner[hit], at[hit]

    def score(self, texts: list[str]) -> np.ndarray:
        owner, at = self.presence(texts)
        total = np.bincount(owner, weights=self.linear.weights[at], minlength=len(texts)) + self.linear.bias
        return 1.0 / (1.0 + np.exp(-np.clip(total, -30, 30)))


def _sliced(batch: pd.Series) -> Iterator[list[str]]:
    texts = [t or "" for t in batch]
    for a, b in slices(texts, SLICE_BYTES):
        yield texts[a:b]


def fit(
    docs: DataFrame, labels: DataFrame, train: Column, *, label: str = "toxic", id: str = "doc_id", text: str = "text"
) -> ToxicityModel:
    """Fit on a sample of at most ``POSITIVES`` rows with label 1 and ``UNLABELLED`` rows of the corpus."""

    @F.pandas_udf("array<long>")
    def marks(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for texts in _sliced(batch):
                owner, found = marks_of(texts)
                out += np.split(found, np.searchsorted(owner, np.arange(1, len(texts))))
            yield pd.Series(out, dtype=object)

    rows, prior = pu_learning.training_rows(
        docs, labels, label, train, positives=POSITIVES, unlabelled=UNLABELLED, id=id, text=text
    )
    described = rows.select("positive", marks("text").alias("marks"))
    n_pos = rows.filter("positive").count()
    n_unl = rows.filter("NOT positive").count()
    counts = (
        described.select("positive", F.explode("marks").alias("mark"))
        .groupBy("mark")
        .agg(F.count_if("positive").alias("p"), F.count_if(~F.col("positive")).alias("u"))
        .filter(F.col("p") >= LEAST_POSITIVES)
        .withColumn("usual", F.col("u") * (n_pos / max(n_unl, 1)))
        .withColumn("above", (F.col("p") - F.col("usual")) / F.sqrt(F.col("usual") + 0.5))
        .filter((F.col("above") >= LEAST_DEVIATIONS) & (F.col("p") * prior >= LEAST_PRECISION * F.col("usual")))
    )
    chosen = counts.orderBy(F.desc("above"), "mark").limit(MARKS).collect()
    model = ToxicityModel(np.array(sorted(r["mark"] for r in chosen), np.int64), pu_learning.Linear(np.zeros(len(chosen)), 0.0))

    @F.pandas_udf("array<int>")
    def present(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for texts in _sliced(batch):
                owner, at = model.presence(texts)
                out += np.split(at.astype(np.int32), np.searchsorted(owner, np.arange(1, len(texts))))
            yield pd.Series(out, dtype=object)

    found = rows.select("positive", present("text").alias("at")).collect()
    found.sort(key=lambda r: (r["positive"], r["at"]))
    positive, unlabelled = (_as_marks([r["at"] for r in found if r["positive"] == kind], len(chosen)) for kind in (True, False))
    return ToxicityModel(model.marks, pu_learning.fit(positive, unlabelled, prior))


def _as_marks(rows: list[list[int]], width: int) -> pu_learning.Marks:
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    return pu_learning.Marks(owner, np.array([at for r in rows for at in r], int), (len(rows), width))


def score(model: ToxicityModel) -> Callable[[Column], Column]:
    """A function from a text column to the probability that the label is 1."""

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            scores = [model.score(texts) for texts in _sliced(batch)]
            yield pd.Series(np.concatenate(scores) if scores else np.zeros(0))

    return run
