"""Mixing sources to target weights by temperature.

The tokens of each source give its share. Shares are raised to an exponent between 0 and 1 and normalised; the
exponent is bisected until the entropy of the weights meets a target, and then raised again as far as the limit
on repeating any source asks. Each source's budget is its weight of all tokens, and is spent in passes over the
source: full passes, and one partial pass over a permutation of its blocks. A block holds about the square root
of the source's documents, dealt by a hash, so neither the table of blocks nor one block grows with the source.
The partial pass takes whole blocks in permuted order, and of the block in which the budget ends the documents in
permuted order as far as they fit.

Without a given budget, the smallest one is taken that spends every source at least once: no document is lost.
A null source is a source of its own. Documents without tokens cost nothing; a source without any token is passed
over once. Rows with equal ids of one source are chosen together, a null id counts as an id. An empty table gives
an empty mix. Columns other than id and source are carried along, whatever their names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from starmart.llm.columns import free_name, if_small
from starmart.session import scratch_path

BISECTIONS = 60
#: Sources whose shares are brought to the driver and broadcast, some 100 bytes each.
MOST_SOURCES = 200_000


def entropy(weights: list[float]) -> float:
    return -sum(w * math.log(w) for w in weights if w > 0)


def tempered(tokens: list[int], exponent: float) -> list[float]:
    """Normalised weights of the sources' shares raised to the exponent."""
    total = sum(tokens)
    raised = [(t / total) ** exponent if t else 0.0 for t in tokens]
    whole = sum(raised)
    return [r / whole for r in raised]


def _bisect(reached, low: float, high: float) -> float:
    """The largest exponent for which ``reached`` holds; it holds at ``low`` if anywhere."""
    if reached(high):
        return high
    for _ in range(BISECTIONS):
        middle = (low + high) / 2
        low, high = (middle, high) if reached(middle) else (low, middle)
    return low


def _repeats(tokens: list[int], weights: list[float]) -> float:
    """Passes over the most repeated source when the least repeated one is passed over once."""
    rates = [w * sum(tokens) / t for t, w in zip(tokens, weights) if t]
    return max(rates) / min(rates)


def exponent_for(tokens: list[int], target_entropy: float, max_repeats: float) -> float:
    """The exponent whose weights reach this share of the largest entropy, within the limit on repeats."""
    tokens = [t for t in tokens if t]
    if len(tokens) < 2:
        return 1.0
    goal = target_entropy * math.log(len(tokens)) - 1e-9
    exponent = _bisect(lambda x: entropy(tempered(tokens, x)) >= goal, 0.0, 1.0)
    if _repeats(tokens, tempered(tokens, exponent)) > max_repeats:
        exponent = 1.0 - _bisect(lambda x: _repeats(tokens, tempered(tokens, 1.0 - x)) <= max_repeats, 0.0, 1.0)
    return exponent


def word_count(text: Column) -> Column:
    """Words between white space (x20, x09-x0D); 0 for null."""
    words = F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+")
    return F.size(F.filter(words, lambda w: w != "")).cast("long")


def _draw(*parts: Column) -> Column:
    """32 bits of the md5 of some values."""
    written = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(written), 1, 8), 16, 10).cast("long")


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


@dataclass(frozen=True)
class Source:
    key: str
    tokens: int
    documents: int
    blocks: int
    weight: float
    budget: int
    passes: int


@dataclass(frozen=True)
class Mix:
    """The exponent, the sources' weights and budgets, and what the partial passes take."""

    exponent: float
    sources: list[Source]
    #: (key, block) taken whole by the partial pass.
    whole: DataFrame
    #: (key, id) taken of the block in which a budget ends.
    edge: DataFrame
    whole_rows: int
    edge_rows: int

    def apply(self, docs: DataFrame, *, id: str = "doc_id", source: str = "source", as_pass: str = "pass") -> DataFrame:
        """One row for every document and pass that takes it, with the number of the pass (from 0)."""
        spark = docs.sparkSession
        names = docs.columns
        key, block, passes, blocks, ident, found = (free_name(docs, n) for n in ("k", "b", "p", "n", "i", "f"))
        per_source = F.broadcast(
            spark.createDataFrame(
                [(s.key, s.passes, s.blocks) for s in self.sources], f"`{key}` string, `{passes}` int, `{blocks}` long"
            )
        )
        whole = self.whole.select(F.col("key").alias(key), F.col("block").alias(block), F.lit(1).alias(found + "w"))
        edge = self.edge.select(F.col("key").alias(key), F.col("id").alias(ident), F.lit(1).alias(found + "e"))
        rows = (
            docs.withColumns({key: _key(F.col(source)), ident: F.coalesce(F.col(id).cast("string"), F.lit("null"))})
            .join(per_source, key)
            .withColumn(block, F.pmod(_draw(F.lit("block"), F.col(ident)), F.col(blocks)))
            .join(if_small(whole, self.whole_rows), [key, block], "left")
            .join(if_small(edge, self.edge_rows), [key, ident], "left")
        )
        partial = F.coalesce(F.col(found + "w"), F.col(found + "e"), F.lit(0))
        copies = F.col(passes) + partial
        number = F.explode(F.sequence(F.lit(0), copies - 1)).alias(as_pass)
        return rows.filter(copies > 0).select(*[F.col(f"`{n}`") for n in names], number)


def plan_mix(
    docs: DataFrame,
    tokens: Column,
    *,
    target_entropy: float = 0.999,
    max_repeats: float = 2.0,
    budget: int | None = None,
    id: str = "doc_id",
    source: str = "source",
) -> Mix:
    """Weights, budgets and the choice of the partial passes, from one reading of the documents.

    The sources' shares are brought to the driver and broadcast; more than ``MOST_SOURCES`` sources are refused.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "mix")
    ident = F.coalesce(F.col(id).cast("string"), F.lit("null"))
    docs.select(ident.alias("id"), _key(F.col(source)).alias("key"), tokens.cast("long").alias("tokens")).write.parquet(
        f"{path}/sizes"
    )
    sizes = spark.read.parquet(f"{path}/sizes")
    shares = sizes.groupBy("key").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("documents"))
    found = sorted(shares.limit(MOST_SOURCES + 1).collect(), key=lambda r: r["key"])
    if len(found) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources; mix groups of them instead")
    counts = [r["tokens"] for r in found]
    total = sum(counts)
    exponent = exponent_for(counts, target_entropy, max_repeats) if total else 1.0
    weights = tempered(counts, exponent) if total else [0.0] * len(found)
    if budget is None:
        budget = math.ceil(max([t / w for t, w in zip(counts, weights) if t], default=0) * (1 + 1e-12))
    sources = []
    for r, w in zip(found, weights):
        own = math.floor(w * budget + 1e-6)
        passes = own // r["tokens"] if r["tokens"] else 1
        blocks = math.isqrt(max(r["documents"] - 1, 0)) + 1
        sources.append(Source(r["key"], r["tokens"], r["documents"], blocks, w, own, passes))

    left = F.broadcast(
        spark.createDataFrame(
            [(s.key, s.blocks, s.passes, s.budget - s.passes * s.tokens if s.tokens else 0) for s in sources],
            T.StructType.fromDDL("key string, blocks long, passes int, left_over long"),
        )
    )
    dealt = sizes.join(left, "key").withColumn("block", F.pmod(_draw(F.lit("block"), F.col("id")), F.col("blocks")))
    order = _draw(F.lit("order"), F.col("key"), F.col("block"), F.col("passes"))
    by_block = W.partitionBy("key").orderBy("place", "block").rowsBetween(W.unboundedPreceding, -1)
    (
        dealt.groupBy("key", "block", "passes", "left_over")
        .agg(F.sum("tokens").alias("tokens"))
        .withColumn("place", order)
        .withColumn("before", F.coalesce(F.sum("tokens").over(by_block), F.lit(0)))
        .filter(F.col("before") < F.col("left_over"))
        .write.parquet(f"{path}/blocks")
    )
    blocks = spark.read.parquet(f"{path}/blocks")
    fits = F.col("before") + F.col("tokens") <= F.col("left_over")
    whole = blocks.filter(fits).select("key", "block")
    last = blocks.filter(~fits).select("key", "block", (F.col("left_over") - F.col("before")).alias("room"))
    by_doc = W.partitionBy("key").orderBy("place", "id").rowsBetween(W.unboundedPreceding, 0)
    (
        dealt.join(F.broadcast(last), ["key", "block"])  # one block of each source at most
        .groupBy("key", "id", "passes", "room")
        .agg(F.sum("tokens").alias("tokens"))
        .withColumn("place", _draw(F.lit("order"), F.col("id"), F.col("passes")))
        .withColumn("spent", F.sum("tokens").over(by_doc))
        .filter(F.col("spent") <= F.col("room"))
        .select("key", "id")
        .write.parquet(f"{path}/edge")
    )
    edge = spark.read.parquet(f"{path}/edge")
    return Mix(exponent, sources, whole, edge, whole.count(), edge.count())

