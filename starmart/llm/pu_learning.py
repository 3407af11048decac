"""Learning from positive and unlabelled examples with the non-negative unbiased risk."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.session import scratch_path

STEPS, RATE, SMOOTHING = 600, 0.05, 1e-3


@dataclass(frozen=True)
class Linear:
    """Weights of a linear score; ``probability`` is its logistic."""

    weights: np.ndarray
    bias: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(x @ self.weights + self.bias, -30, 30)))


class Marks:
    """A matrix of zeros and ones, kept as the places of its ones; of numpy's operations it has what ``fit`` needs."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, shape: tuple[int, int]):
        self.rows, self.columns, self.shape = rows, columns, shape

    def __len__(self) -> int:
        return self.shape[0]

    @property
    def T(self) -> Marks:  # noqa: N802
        return Marks(self.columns, self.rows, self.shape[::-1])

    def __matmul__(self, vector: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, weights=vector[self.columns], minlength=self.shape[0])


def fit(positive: np.ndarray | Marks, unlabelled: np.ndarray | Marks, prior: float) -> Linear:
    """Minimise prior * R(positive as 1) + max(0, R(unlabelled as 0) - prior * R(positive as 0)).

    R is the mean logistic loss. Where the difference is negative, which the true risk can't be, the step goes
    against its gradient. All examples take part in every step, so the result depends on the data alone.
    """
    size = (positive if len(positive) else unlabelled).shape[1]
    prior = min(max(prior, 1e-3), 1 - 1e-3)
    w, b = np.zeros(size), float(np.log(prior / (1 - prior)))
    if not len(positive) or not len(unlabelled):
        return Linear(w, b)
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, STEPS + 1):
        p_pos = 1 / (1 + np.exp(-np.clip(positive @ w + b, -30, 30)))
        p_unl = 1 / (1 + np.exp(-np.clip(unlabelled @ w + b, -30, 30)))
        rest = -np.log1p(-np.minimum(p_unl, 1 - 1e-12)).mean() + prior * np.log1p(-np.minimum(p_pos, 1 - 1e-12)).mean()
        as_one = prior * (p_pos - 1) / len(p_pos)
        as_zero_u, as_zero_p = p_unl / len(p_unl), -prior * p_pos / len(p_pos)
        if rest >= 0:
            of_pos, of_unl = as_one + as_zero_p, as_zero_u
        else:
            of_pos, of_unl = -as_zero_p, -as_zero_u
        slope = np.append(positive.T @ of_pos + unlabelled.T @ of_unl + SMOOTHING * w, of_pos.sum() + of_unl.sum())
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - float(move[-1])
    return Linear(w, b)


def training_rows(
    docs: DataFrame, labels: DataFrame, label: str, train: Column, *, positives: int, unlabelled: int, id: str, text: str
) -> tuple[DataFrame, float]:
    """A bounded sample (text, positive) of rows for which ``train`` holds, and the share of label 1 among labels.

    The rows with the least hashes of their ids are taken: trusted positives, and rows of the corpus whatever
    their label. Rows without id and null labels are not used; if a document has several labels, the largest counts.
    Of an id with several texts the least one is used, so the sample is as small as stated whatever the ids.
    """
    by_hash = F.xxhash64(F.col(id).cast("string"), F.lit("sample"))
    known = (
        labels.filter(F.col(label).isNotNull() & F.col(id).isNotNull())
        .filter(train)
        .groupBy(F.col(id).alias("id"))
        .agg(F.max(label).alias("label"))
    )
    found = known.agg(F.sum(F.col("label").cast("long")), F.count("*")).first()
    prior = ((found[0] or 0) + 1) / (found[1] + 2)
    chosen = known.filter("label = 1").orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(positives)
    rows = docs.filter(F.col(id).isNotNull()).filter(train)
    others = rows.select(F.col(id).alias("id")).orderBy(by_hash, id).limit(unlabelled)
    wanted = chosen.select("id", F.lit(True).alias("positive")).unionByName(others.select("id", F.lit(False).alias("positive")))
    texts = rows.select(F.col(id).alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    # positives + unlabelled rows at most, written because they are read several times
    path = scratch_path(docs.sparkSession, "training")
    one_text = texts.join(F.broadcast(wanted), "id").groupBy("id", "positive").agg(F.min("text").alias("text"))
    one_text.select("text", "positive").distinct().write.parquet(path)
    return docs.sparkSession.read.parquet(path), prior
