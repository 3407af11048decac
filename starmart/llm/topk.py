"""Exact top-k by inner product with a pivot-distance index.

With one more component, sqrt(M**2 - |x|**2) for a row and 0 for a query, where M is the largest norm, the row with
the larger inner product is the nearer one, so distances and the triangle inequality apply.

The index keys every row by its nearest pivot and its distance to it; the rows of a pivot are cut by distance into
annuli, and an annulus of more than ``CELL`` rows, such as copies of one vector, into cells by a hash. A query first
visits the annulus with the least lower bound, which gives its k-th best distance so far; then, annulus by annulus
outwards, the cells whose bound |d(query, pivot) - annulus| is not beyond that. All rows are indexed; only the
pivots come from a bounded sample, which affects speed, never results. Queries meet a cell in blocks.

Rows with a null id, a null vector, or null or non-finite components take no part, neither do those with a component
whose integer is no long (|x| of 2**55 or more with a factor of 256). An empty vector scores 0 with every other. Products are exact whatever
their size; a score in the result that is no long fails the query. Shorter vectors count as filled up with zeros.
Rows that repeat an id are rows of their own as candidates (but never for a query with that id); a repeated query id is answered once, by its least vector. Ties go to the smaller id. Without
candidates there are no rows. Columns other than id and vector are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from starmart.session import scratch_path

#: Pivots, the rows they are chosen from, annuli of each pivot, rows of a cell and queries of a block.
PIVOTS, SAMPLE, RINGS, CELL, BLOCK = 16, 2048, 16, 4096, 1024
#: What stands for scores that are no long, and, negative, for none: every other score is between.
BEYOND = 2**63 - 1
NOTHING_KNOWN = -BEYOND
#: Components are cut into limbs of so many bits where products are large, and multiplied in runs of so many columns.
LIMB, COLUMNS = 21, 512


def valid(vector: Column, factor: int = 256) -> Column:
    """Whether a vector is there and none of its components is null, non-finite or beyond a long as an integer."""
    scaled = lambda x: x.cast("double") * factor
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (scaled(x) >= 2.0**63) | (scaled(x) < -(2.0**63)))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def quantised(vector: Column, factor: int = 256) -> Column:
    """floor(factor * x) of each component x as double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * factor).cast("long"))


def _matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _largest_norm(vectors: np.ndarray) -> float:
    return float((vectors.astype(np.float64) ** 2).sum(axis=1).max(initial=0))


def _products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer inner products, ``BEYOND`` or its negative where they are no long.

    No product and no part of its sum is larger than that of the largest norms. By floating point where that is
    below 2**53, by integers below 2**62, else by limbs.
    """
    most = np.sqrt(_largest_norm(queries)) * np.sqrt(_largest_norm(rows)) * (1 + 1e-9)
    if most < 2**53:
        return (queries.astype(np.float64) @ rows.T.astype(np.float64)).astype(np.int64)
    if most < 2**62:
        return queries @ rows.T
    return _large_products(queries, rows)


def _limbs(vectors: np.ndarray) -> list[np.ndarray]:
    mask = (1 << LIMB) - 1
    return [(part).astype(np.float64) for part in (vectors & mask, (vectors >> LIMB) & mask, vectors >> 2 * LIMB)]


def _large_products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """By three limbs of each component, whose products in a run of columns are below 2**53."""
    mask = (1 << LIMB) - 1
    sums = [np.zeros((len(queries), len(rows)), np.int64) for _ in range(5)]
    for at in range(0, queries.shape[1], COLUMNS):
        left, right = _limbs(queries[:, at : at + COLUMNS]), _limbs(rows[:, at : at + COLUMNS])
        for i, x in enumerate(left):
            for j, y in enumerate(right):
                sums[i + j] += (x @ y.T).astype(np.int64)
    for k in range(4):
        sums[k + 1] += sums[k] >> LIMB
        sums[k] &= mask
    low = sums[0] + (sums[1] << LIMB) + (sums[2] << 2 * LIMB)  # 63 bits; the sign and what is above them are in the others
    positive, negative = (sums[4] == 0) & (sums[3] == 0), (sums[4] == -1) & (sums[3] == mask)
    out = np.where(positive, low, np.where(negative, low + np.iinfo(np.int64).min, np.where(sums[4] < 0, -BEYOND, BEYOND)))
    return np.maximum(out, -BEYOND)


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Rows of the sample that are far from each other: each next one is the farthest from those before."""
    if not len(sample):
        return sample
    chosen = [0]
    away = ((sample - sample[0]) ** 2).sum(axis=1)
    while len(chosen) < count and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


def _distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (points**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1)[None, :] - 2 * points @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def _lift(vectors: np.ndarray, largest: float) -> np.ndarray:
    """Rows with the component that gives all of them the largest norm."""
    x = vectors.astype(np.float64)
    rest = np.sqrt(np.maximum(largest - (x**2).sum(axis=1), 0))
    return np.concatenate([x, rest[:, None]], axis=1)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest scores, ties by the smaller id."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


class PivotIndex:
    """Rows (id, vector of long) keyed by pivot, annulus and cell, written to the shared folder."""

    def __init__(self, rows: DataFrame, *, pivots: int = PIVOTS, rings: int = RINGS):
        self.spark = rows.sparkSession
        self.path = scratch_path(self.spark, "pivots")
        rows.write.parquet(f"{self.path}/rows")
        self.rows = self.spark.read.parquet(f"{self.path}/rows")
        norm = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
        about = self.rows.agg(F.max(F.size("vector")), F.max(norm), F.count("*")).first()
        self.width, self.largest, self.count = about[0] or 0, about[1] or 0.0, about[2]
        sample = self.rows.orderBy(F.xxhash64("id"), "vector").limit(SAMPLE).collect()
        self.pivots = choose_pivots(_lift(_matrix([r["vector"] for r in sample], self.width), self.largest), pivots)
        self.keyed = self._keyed(rings)

    def _keyed(self, rings: int) -> DataFrame:
        width, pivots, largest = self.width, self.pivots, self.largest

        @F.pandas_udf("pivot int, distance double")
        def key(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                away = _distances(_lift(_matrix(batch, width), largest), pivots) if len(batch) else np.zeros((0, 1))
                yield pd.DataFrame({"pivot": away.argmin(axis=1).astype("int32"), "distance": away.min(axis=1)})

        path = f"{self.path}/keyed"
        found = self.rows.withColumn("key", key("vector")).select("id", "vector", "key.pivot", "key.distance")
        found.write.parquet(path)
        found = self.spark.read.parquet(path)
        cuts = found.groupBy("pivot").agg(
            F.percentile_approx("distance", [i / rings for i in range(1, rings)], 1000).alias("cuts")
        )
        ring = F.aggregate("cuts", F.lit(0), lambda n, cut: n + (F.col("distance") > cut).cast("int"))
        found = found.join(F.broadcast(cuts), "pivot").withColumn("ring", ring).drop("cuts")
        annuli = found.groupBy("pivot", "ring").agg(
            F.min("distance").alias("inner"), F.max("distance").alias("outer"), F.count("*").alias("rows")
        )
        annuli = annuli.withColumn("cells", F.ceil(F.col("rows") / CELL).cast("int"))
        annuli.write.parquet(f"{self.path}/annuli")  # pivots * rings rows at most
        self.annuli = sorted(self.spark.read.parquet(f"{self.path}/annuli").collect(), key=lambda r: (r["pivot"], r["ring"]))
        cells = F.broadcast(self.spark.read.parquet(f"{self.path}/annuli").select("pivot", "ring", "cells"))
        cell = F.pmod(F.xxhash64("id", "distance"), F.col("cells")).cast("int")
        return found.join(cells, ["pivot", "ring"]).withColumn("cell", cell)

    def search(self, queries: DataFrame, k: int) -> DataFrame:
        """(query_id, rank, id, score) of the k best rows with other ids, for every query (id, vector)."""
        queries = queries.groupBy("id").agg(F.min("vector").alias("vector"))
        if not self.count or queries.isEmpty():
            return self.spark.createDataFrame([], "query_id long, rank int, id long, score long")
        queries.write.parquet(f"{self.path}/queries")
        queries = self.spark.read.parquet(f"{self.path}/queries")
        width, pivots, largest = self.width, self.pivots, self.largest
        annuli = [(r["pivot"], r["ring"], r["inner"], r["outer"]) for r in self.annuli]

        def bounds_of(vectors: np.ndarray) -> np.ndarray:
            lifted = np.concatenate([vectors.astype(np.float64), np.zeros((len(vectors), 1))], axis=1)
            return _bounds(lifted, pivots, annuli)

        @F.pandas_udf("int")
        def home(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                at = bounds_of(_matrix(batch, width)).argmin(axis=1) if len(batch) else np.zeros(0)
                yield pd.Series(at.astype("int32"))

        queries = queries.withColumn("home", home("vector"))
        queries = queries.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(max(1, -(-queries.count() // BLOCK)))).cast("int"))
        queries.write.parquet(f"{self.path}/homes")
        queries = self.spark.read.parquet(f"{self.path}/homes")
        table = F.broadcast(
            self.spark.createDataFrame(
                [(i, r["pivot"], r["ring"], r["cells"]) for i, r in enumerate(self.annuli)],
                "annulus int, pivot int, ring int, cells int",
            )
        )
        cells = self.keyed.drop("cells").join(table, ["pivot", "ring"]).select("id", "vector", "annulus", "cell")
        def visit(unit: pd.DataFrame) -> pd.DataFrame:
            """The k best rows of a cell, none worse than what is known, for each query of a block that may have some there."""
            asking = unit[unit["asks"]]
            rows = unit[~unit["asks"]]
            out = []
            if len(asking) and len(rows):
                vectors, ids = _matrix(rows["vector"].to_list(), width), rows["id"].to_numpy()
                asked = _matrix(asking["vector"].to_list(), width)
                reach = asking["reach"].to_numpy(float)
                bound = bounds_of(asked)[:, int(unit["annulus"].iloc[0])]
                wanted = ~(bound > reach * (1 + 1e-9) + _slack(asked, largest))  # no reach yet: everything is within it
                keys, asked = asking["id"].to_numpy()[wanted], asked[wanted]
                least = asking["least"].to_numpy(np.int64)[wanted]
                scores = _products(asked, vectors)
                for key, own, low in zip(keys, scores, least):
                    other = np.flatnonzero((ids != key) & (own >= low))
                    best = other[_best(own[other], ids[other], k)]
                    out += [(key, ids[i], own[i]) for i in best]
            return pd.DataFrame(out, columns=["query_id", "id", "score"], dtype="int64")

        def visited(asks: DataFrame, rows: DataFrame, name: str) -> DataFrame:
            asks = asks.select("id", "vector", "annulus", "cell", "part", "reach", "least", F.lit(True).alias("asks"))
            rows = rows.select(
                "id", "vector", "annulus", "cell", "part", F.lit(None).cast("double").alias("reach"),
                F.lit(NOTHING_KNOWN).alias("least"), F.lit(False).alias("asks"),
            )
            found = asks.unionByName(rows).groupBy("annulus", "cell", "part").applyInPandas(
                visit, "query_id long, id long, score long"
            )
            found.write.parquet(f"{self.path}/{name}")
            return self.spark.read.parquet(f"{self.path}/{name}")

        # First the annulus with the least bound, for what can be reached there.
        at_home = table.select(F.col("annulus").alias("home"), F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("cell"))
        asks = queries.join(at_home, "home").select(
            "id", "vector", F.col("home").alias("annulus"), "cell", "part", F.lit(None).cast("double").alias("reach"),
            F.lit(NOTHING_KNOWN).alias("least"),
        )
        needed = asks.select("annulus", "cell", "part").distinct()
        first = visited(asks, cells.join(needed, ["annulus", "cell"]), "first")
        by_score = W.partitionBy("query_id").orderBy(F.desc("score"), "id")
        kth = first.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") == k)
        norm = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
        square = norm + F.lit(float(self.largest)) - 2 * F.col("score").cast("double")
        reached = queries.join(kth.select(F.col("query_id").alias("id"), "score"), "id", "left").withColumn(
            "reach", F.when(F.col("score").isNotNull(), F.sqrt(F.greatest(square, F.lit(0.0))))
        ).withColumn("least", F.coalesce("score", F.lit(NOTHING_KNOWN)))
        # Then all others that the bounds allow, annuli in order of their bound.
        @F.pandas_udf("array<int>")
        def outwards(vector: pd.Series, reach: pd.Series, home: pd.Series) -> pd.Series:
            if not len(vector):
                return pd.Series([], dtype=object)
            vectors = _matrix(vector, width)
            bound = bounds_of(vectors)
            limit = reach.fillna(np.inf).to_numpy(float)[:, None]
            open_ = bound <= limit * (1 + 1e-9) + _slack(vectors, largest)[:, None]
            open_[np.arange(len(open_)), home.to_numpy(int)] = False
            order = np.argsort(bound, axis=1, kind="stable")
            return pd.Series([o[keep[o]].astype(np.int32) for o, keep in zip(order, open_)], dtype=object)

        asks = (
            reached.withColumn("annulus", F.explode(outwards("vector", "reach", "home")))
            .join(table.select("annulus", "cells"), "annulus")
            .withColumn("cell", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
        )
        needed = asks.select("annulus", "cell", "part").distinct()
        rest = visited(asks, cells.join(needed, ["annulus", "cell"]), "rest")
        best = first.unionByName(rest).withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k)
        beyond = F.raise_error(F.concat(F.lit("op8: the score is no long: query "), "query_id", F.lit(", row "), "id"))
        score = F.when(F.col("score").between(-BEYOND + 1, BEYOND - 1), F.col("score")).otherwise(beyond.cast("long"))
        return best.select("query_id", F.col("rank").cast("int").alias("rank"), "id", score.alias("score"))


def _slack(vectors: np.ndarray, largest: float) -> np.ndarray:
    """How far rounding can move a distance from each vector.

    Squares of distances are sums and differences of squared norms, so their error is a share of those, and that of
    a distance at most its root; a distance, an annulus, the lifted component and the reach each have one.
    """
    norms = (vectors.astype(np.float64) ** 2).sum(axis=1) + largest
    return 1e-6 + 8 * np.sqrt(2.0**-52 * (vectors.shape[1] + 8) * norms)


def _bounds(lifted: np.ndarray, pivots: np.ndarray, annuli: list) -> np.ndarray:
    away = _distances(lifted, pivots)
    pivot = np.array([a[0] for a in annuli], int)
    inner, outer = np.array([a[2] for a in annuli]), np.array([a[3] for a in annuli])
    at = away[:, pivot]
    return np.maximum(0, np.maximum(at - outer, inner - at))


def top_k(
    rows: DataFrame, asks: Column, *, k: int = 5, factor: int = 256, id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, id, score): the k best other rows for every row for which ``asks`` holds."""
    usable = rows.filter(F.col(id).isNotNull() & valid(F.col(vector), factor))
    ints = usable.select(F.col(id).alias("id"), quantised(F.col(vector), factor).alias("vector"), asks.alias("asks"))
    index = PivotIndex(ints.select("id", "vector", F.coalesce("asks", F.lit(False)).alias("asks")))
    return index.search(index.rows.filter("asks").select("id", "vector"), k)
