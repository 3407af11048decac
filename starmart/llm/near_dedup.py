"""Near-duplicate documents by MinHash bands, sequential Bayesian pruning and exact verification.

Two documents are linked if the Jaccard similarity of their sets of word shingles is at least ``percent``; the
result holds the connected components of these links.

1. Each document gets the size and a signature of its set. Documents with equal texts (A-Z in lower case) are one
   class.
2. Signatures of classes are cut into bands; classes that share a band are candidates.
3. Candidates' signatures are compared in batches of hash functions. After each batch a pair is given up if the
   posterior probability that it is similar enough is below ``miss``. In a band, first the least class is compared
   with the others, then about ``HUBS`` of them with those that are not yet connected with them (in a band of up to
   ``HUBS`` members that is every pair), and in larger bands at last the members outside of the band's main part with
   all of its members, in units of two blocks. So a band of thousands of similar classes takes few rows more than it
   has members, and none is cut.
4. What is connected that way is a cluster. Within clusters, pairs are verified on the full sets, in units of a
   few hundred texts: first one block of a large cluster against all blocks, then those of its members that
   differ from the main part against all blocks. Pairs that are already connected need no check.

A pair at the threshold shares no band with probability (1 - 0.8 ** 4) ** 32, about 5e-8, and is pruned with
probability of about ``miss`` in each batch. A link is reported when the sets have enough in common, and after the
bytes of the two texts' shingles were compared wherever hashes are equal; so no link rests on hashes.

Null and empty texts and texts without words have empty sets and are linked with nothing. A row with a null id
takes no part: it is a component of its own without id, and kept. Repeated rows are in one class. If an id comes
with several texts, each row has the component of its own text, and texts are linked by what they hold alone: the
same id is kept with one text and dropped with another. Rows of a component's least id are all kept. Columns other
than id and text are never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.arrays import slices
from starmart.llm.columns import if_small, join_groups
from starmart.llm.components import components
from starmart.llm.exact_dedup import digest_of
from starmart.llm.resident import release, trim
from starmart.llm.shingles import Sets, as_bytes, shingle_sets, signatures, told_apart, true_set
from starmart.session import scratch_path

BANDS, BAND_ROWS = 32, 4
#: Hash functions compared between two looks at the posterior.
BATCH = 16
MISS = 1e-9
SLICE_BYTES = 1 << 19
#: Bytes of two texts beyond which their shingles are compared as arrays first.
LONG_BYTES = 1 << 20
#: Characters of a unit after which a worker gives memory back.
TRIM_BYTES = 4 << 20
#: Texts in a block; a unit of verification holds two blocks. Blocks are dealt by hash, so sizes vary a little.
BLOCK = 192
#: Members of a band that are compared with the others in the second round.
HUBS = 16


def least_matches(percent: int, hashes: int, miss: float = MISS) -> np.ndarray:
    """Matches needed after each batch so that the posterior of being similar enough is at least ``miss``.

    With a uniform prior, the posterior after m matches of n is Beta(m + 1, n - m + 1), and its tail beyond t is
    the probability of at most m successes in n + 1 trials of probability t.
    """
    t, needed = percent / 100, []
    for n in range(BATCH, hashes + 1, BATCH):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += math.exp(
                math.lgamma(n + 2) - math.lgamma(m + 1) - math.lgamma(n + 2 - m)
                + m * math.log(t) + (n + 1 - m) * math.log1p(-t)
            ) if t < 1 else float(m > n)
            if m > n:
                break
        needed.append(m)
    return np.array(needed)


def similar_enough(left: np.ndarray, right: np.ndarray, needed: np.ndarray) -> np.ndarray:
    """Which pairs of signatures (rows of both) are not given up after any batch."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), np.int64)
    for k, least in enumerate(needed):
        part = slice(k * BATCH, (k + 1) * BATCH)
        matches[alive] += (left[alive, part] == right[alive, part]).sum(axis=1)
        alive = alive[matches[alive] >= least]
    out = np.zeros(len(left), bool)
    out[alive] = True
    return out


def _describe(words: int, hashes: int):
    """Column function: size and signature of each text's set."""

    @F.pandas_udf("n long, signature binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        release()
        for batch in batches:
            texts = [as_bytes(t) for t in batch]
            parts = []
            for a, b in slices(texts, SLICE_BYTES):
                sets = shingle_sets(texts[a:b], words)
                rows = signatures(sets, hashes)
                parts.append(pd.DataFrame({"n": sets.sizes(), "signature": [r.tobytes() for r in rows]}))
            yield pd.concat(parts) if parts else pd.DataFrame({"n": [], "signature": []})
        trim()

    return run


def _compare(needed: np.ndarray):
    """Column function: whether two signatures are not given up."""

    @F.pandas_udf("boolean")
    def run(left: pd.Series, right: pd.Series) -> pd.Series:
        if not len(left):
            return pd.Series([], dtype=bool)
        a, b = (np.frombuffer(b"".join(s), np.uint32).reshape(len(s), -1) for s in (left, right))
        return pd.Series(similar_enough(a, b, needed))

    return run


class _Joined:
    """Union-find over a unit's texts."""

    def __init__(self, labels: list):
        first: dict = {}
        self.to = [first.setdefault(label, i) for i, label in enumerate(labels)]

    def root(self, i: int) -> int:
        while self.to[i] != i:
            self.to[i] = i = self.to[self.to[i]]
        return i


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    small, large = sorted((len(a), len(b)))
    if 100 * small < percent * large:
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (small + large - common)


def _really_linked(a: bytes, b: bytes, words: int, percent: int) -> bool:
    """Whether two texts whose hashed sets are linked are so by the bytes of their shingles."""
    if len(a) + len(b) > LONG_BYTES and told_apart([a, b], words):
        return True
    x, y = true_set(a, words), true_set(b, words)
    return 100 * len(x & y) >= percent * len(x | y)


def compare_unit(
    nodes: np.ndarray, labels: list, sizes: np.ndarray, x: np.ndarray, y: np.ndarray, marks: np.ndarray, percent: int, needed
) -> list[tuple[int, int]]:
    """Pairs of x and y rows of a unit that are not given up and connect what was not yet connected."""
    left, right = _across(labels, x, y)
    close = 100 * np.minimum(sizes[left], sizes[right]) >= percent * np.maximum(sizes[left], sizes[right])
    left, right = left[close], right[close]
    joined, links = _Joined(labels), []
    for at in range(0, len(left), 1 << 16):
        a, b = left[at : at + (1 << 16)], right[at : at + (1 << 16)]
        alive = similar_enough(marks[a], marks[b], needed)
        for i, j in zip(a[alive].tolist(), b[alive].tolist()):
            root_i, root_j = joined.root(i), joined.root(j)
            if root_i != root_j:
                joined.to[max(root_i, root_j)] = min(root_i, root_j)
                links.append((int(nodes[i]), int(nodes[j])))
    return links


def _across(labels: list, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of an x and a y row with different labels, each once."""
    left, right = np.nonzero(x[:, None] & y[None, :])
    once = ((left < right) | ~(x[right] & y[left])) & (left != right)
    left, right = left[once], right[once]
    joined = _Joined(labels)
    roots = np.array([joined.root(i) for i in range(len(labels))])
    apart = roots[left] != roots[right]
    return left[apart], right[apart]


def verify_unit(
    nodes: np.ndarray, labels: list, x: np.ndarray, y: np.ndarray, texts: list[bytes], words: int, percent: int, needed
) -> list[tuple[int, int]]:
    """Verified links between x and y rows of a unit that connect what was not yet connected."""
    sets: list[np.ndarray] = []
    signed = []
    for a, b in slices(texts, SLICE_BYTES):
        part: Sets = shingle_sets(texts[a:b], words)
        sets += [part.of(i) for i in range(b - a)]
        signed.append(signatures(part, len(needed) * BATCH))
    marks = np.concatenate(signed)
    left, right = _across(labels, x, y)
    joined = _Joined(labels)
    links = []
    if len(left):
        alive = np.zeros(len(left), bool)
        for at in range(0, len(left), 1 << 16):
            part = slice(at, at + (1 << 16))
            alive[part] = similar_enough(marks[left[part]], marks[right[part]], needed)
        left, right = left[alive], right[alive]
        near = np.zeros(len(left), np.int32)
        for k in range(marks.shape[1]):
            near += marks[left, k] == marks[right, k]
        for i in np.argsort(-near, kind="stable"):
            a, b = int(left[i]), int(right[i])
            root_a, root_b = joined.root(a), joined.root(b)
            if root_a != root_b and _linked(sets[a], sets[b], percent) and _really_linked(texts[a], texts[b], words, percent):
                joined.to[max(root_a, root_b)] = min(root_a, root_b)
                links.append((int(nodes[a]), int(nodes[b])))
    return links


class _Search:
    """The steps over one table of documents; every step's result is written below ``path``."""

    def __init__(self, docs: DataFrame, id: str, text: str, words: int, percent: int):
        self.spark: SparkSession = docs.sparkSession
        self.path = scratch_path(self.spark, "near")
        self.docs = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
        self.words, self.percent = words, percent
        self.needed = least_matches(percent, BANDS * BAND_ROWS)
        self.step = 0

    def written(self, df: DataFrame, name: str) -> DataFrame:
        self.step += 1
        path = f"{self.path}/{self.step}-{name}"
        df.write.parquet(path)
        return self.spark.read.parquet(path)

    def describe(self) -> None:
        found = _describe(self.words, BANDS * BAND_ROWS)(F.col("text"))
        rows = self.docs.select("id", digest_of(F.col("text")).alias("digest"), found.alias("d"))
        self.rows = self.written(rows.select("id", "digest", "d.n", "d.signature"), "rows")
        keyed = self.rows.filter("n > 0 AND id IS NOT NULL")
        groups = keyed.groupBy("digest").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
        # a number of its own, since several classes may have the same least id
        groups = groups.sortWithinPartitions("digest").withColumn("node", F.monotonically_increasing_id())
        self.classes = self.written(groups.select("node", "id", "digest", "copies"), "classes")
        reps = keyed.join(self.classes.select("id", "digest", "node"), ["id", "digest"]).dropDuplicates(["node"])
        self.reps = self.written(reps.select("node", "n", "signature"), "reps")

    def bands(self) -> DataFrame:
        """(key, node, n, k) of bands that at least two classes share; k is the number of members."""
        width = 4 * BAND_ROWS
        bands = F.transform(
            F.sequence(F.lit(0), F.lit(BANDS - 1)),
            lambda i: F.xxhash64(i, F.substring(F.col("signature"), i * width + 1, F.lit(width))),
        )
        rows = self.reps.select("node", "n", F.explode(bands).alias("key"))
        shared = rows.groupBy("key").agg(F.count("*").alias("k"), F.min("node").alias("hub"), F.max("node").alias("last"))
        shared = shared.filter("hub < last").drop("last")
        return self.written(rows.join(shared, "key"), "bands")

    def prune(self, pairs: DataFrame, number: int) -> DataFrame:
        """Pairs (a, b) of classes that are not given up."""
        close = 100 * F.least("n_a", "n_b") >= self.percent * F.greatest("n_a", "n_b")
        pairs = pairs.filter(close).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        for side in ("a", "b"):
            marks = self.reps.select(F.col("node").alias(side), F.col("signature").alias(f"signature_{side}"))
            pairs = pairs.join(marks, side)
        kept = pairs.filter(_compare(self.needed)(F.col("signature_a"), F.col("signature_b")))
        return self.written(kept.select("a", "b").distinct(), f"pairs-{number}")

    def labelled(self, links: DataFrame, number: str) -> DataFrame:
        return components(links, f"{self.path}/components-{number}")

    def clusters(self) -> DataFrame:
        """(node, label) of classes that are connected by pairs that were not given up."""
        members = self.bands()
        hub_sizes = members.filter("node = hub").select("key", F.col("n").alias("n_a"))
        first = members.filter("node <> hub").join(hub_sizes, "key")
        first = first.select(F.col("hub").alias("a"), F.col("node").alias("b"), "n_a", F.col("n").alias("n_b"))
        pairs = self.prune(first, 0)
        labels = self.labelled(pairs, "0")
        draw = (F.pmod(F.xxhash64("key", "node"), F.lit(1 << 53)) / F.lit(float(1 << 53))).alias("draw")
        now = self.open(members, labels, draw)
        hubs = now.filter(F.col("draw") < HUBS / F.col("k")).select(
            "key", F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("label").alias("label_a"), F.col("draw").alias("draw_a")
        )
        across = hubs.join(now, "key").filter(
            (F.col("label") != F.col("label_a")) & (F.struct("draw", "node") > F.struct("draw_a", "a"))
        )
        more = self.prune(across.select("a", F.col("node").alias("b"), "n_a", F.col("n").alias("n_b")), 1)
        if not more.isEmpty():
            pairs = pairs.unionByName(more)
            labels = self.labelled(pairs, "1")
        now = self.open(members.filter(F.col("k") > HUBS), labels, draw)
        if now.isEmpty():
            return labels
        rest = self.compare_blocks(now)
        return labels if rest.isEmpty() else self.labelled(pairs.unionByName(rest), "2")

    def open(self, members: DataFrame, labels: DataFrame, draw) -> DataFrame:
        """Members, with their labels, of the bands that are not all connected."""
        now = members.join(labels, "node", "left").select(
            "key", "node", "n", "k", draw, F.coalesce("label", "node").alias("label")
        )
        mixed = now.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"))
        return self.written(now.join(mixed.filter("low < high").select("key"), "key"), "open")

    def compare_blocks(self, now: DataFrame) -> DataFrame:
        """Pairs (a, b) of a band's members outside of its main part with any of its members, not given up."""
        percent, needed = self.percent, self.needed

        def run(unit: pd.DataFrame) -> pd.DataFrame:
            same = unit.groupby("node", sort=True).agg(
                {"label": "first", "n": "first", "signature": "first", "x": "any", "y": "any"}
            )
            links = compare_unit(
                same.index.to_numpy(), same["label"].tolist(), same["n"].to_numpy(), same["x"].to_numpy(bool),
                same["y"].to_numpy(bool), np.frombuffer(b"".join(same["signature"]), np.uint32).reshape(len(same), -1),
                percent, needed,
            )
            return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

        counts = now.groupBy("key", "label").count()
        main = counts.groupBy("key").agg(
            F.max_by("label", F.struct("count", "label")).alias("main"), F.sum("count").alias("size"), F.max("count").alias("most")
        )
        blocks = F.ceil(F.col("size") / BLOCK).cast("int")
        strips = F.ceil((F.col("size") - F.col("most")) / BLOCK).cast("int")
        dealt = F.xxhash64(F.col("node"), F.lit("block"))
        now = now.join(main, "key").select(
            "key", "node", "n", "label", (F.col("label") != F.col("main")).alias("x"), blocks.alias("blocks"), strips.alias("strips")
        )
        now = now.withColumns({"j": F.pmod(dealt, F.col("blocks")).cast("int"), "i": F.pmod(dealt, F.col("strips")).cast("int")})
        every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
        as_x = now.filter("x").select("key", "node", "n", "label", "i", every("blocks").alias("j"), F.lit(True).alias("x"), F.lit(False).alias("y"))
        as_y = now.select("key", "node", "n", "label", every("strips").alias("i"), "j", F.lit(False).alias("x"), F.lit(True).alias("y"))
        marks = self.reps.select("node", "signature")
        units = as_x.unionByName(as_y).join(marks, "node")
        return self.written(units.groupBy("key", "i", "j").applyInPandas(run, "a long, b long").distinct(), "blocks")

    def verify(self, units: DataFrame, name: str) -> DataFrame:
        """Links (a, b) that units (node, id, digest, cluster, i, j, label, x, y) verify; texts are read again for them."""
        words, percent, needed = self.words, self.percent, self.needed

        def run(unit: pd.DataFrame) -> pd.DataFrame:
            same = unit.groupby("node", sort=True).agg({"text": "first", "label": "first", "x": "any", "y": "any"})
            same = same.reset_index()
            links = verify_unit(
                same["node"].to_numpy(), same["label"].tolist(), same["x"].to_numpy(bool), same["y"].to_numpy(bool),
                [as_bytes(t) for t in same["text"]], words, percent, needed,
            )
            if same["text"].map(len).sum() > TRIM_BYTES:
                del same
                trim()
            return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

        units = self.written(units, f"units-{name}")
        texts = self.docs.filter("id IS NOT NULL").withColumn("digest", digest_of(F.col("text")))
        texts = texts.join(if_small(units, units.count()), ["id", "digest"]).drop("id", "digest")
        links = texts.groupBy("cluster", "i", "j").applyInPandas(run, "a long, b long")
        return self.written(links, f"links-{name}")

    def links(self) -> DataFrame:
        """Verified links that connect every component."""
        members = self.clusters().withColumnRenamed("label", "cluster")
        sizes = members.groupBy("cluster").agg(F.count("*").alias("size"))
        blocks = F.ceil(F.col("size") / BLOCK).cast("int")
        hashed = F.xxhash64(F.col("node"), F.lit("block"))
        members = members.join(sizes, "cluster").join(self.classes.select("node", "id", "digest"), "node")
        members = members.select("node", "id", "digest", "cluster", blocks.alias("blocks"))
        members = self.written(members.withColumn("block", F.pmod(hashed, F.col("blocks")).cast("int")), "members")
        one = F.when(F.col("block") == 0, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("block"))
        units = members.select("node", "id", "digest", "cluster", "block", F.explode(one).alias("j")).select(
            "node", "id", "digest", "cluster", F.lit(0).alias("i"), "j", F.col("node").alias("label"),
            (F.col("block") == 0).alias("x"), (F.col("block") == F.col("j")).alias("y"),
        )
        links = self.verify(units, "first")
        large = members.filter("blocks > 1")
        if large.isEmpty():
            return links
        now = large.join(self.labelled(links, "first"), "node", "left").withColumn("label", F.coalesce("label", "node"))
        counts = now.groupBy("cluster", "label").count()
        main = counts.groupBy("cluster").agg(F.max_by("label", F.struct("count", "label")).alias("main"))
        now = self.written(now.join(main, "cluster"), "large")
        rest = now.filter("label <> main")
        if rest.isEmpty():
            return links
        strips = F.ceil(F.count("*") / BLOCK).cast("int").alias("strips")
        now = now.join(rest.groupBy("cluster").agg(strips), "cluster")
        strip = F.when(F.col("label") != F.col("main"), F.pmod(hashed, F.col("strips")).cast("int"))
        now = self.written(now.withColumn("strip", strip), "strips")
        as_x = now.filter("strip IS NOT NULL").select(
            "node", "id", "digest", "cluster", F.col("strip").alias("i"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"),
            "label", F.lit(True).alias("x"), F.lit(False).alias("y"),
        )
        as_y = now.select(
            "node", "id", "digest", "cluster", F.explode(F.sequence(F.lit(0), F.col("strips") - 1)).alias("i"), F.col("block").alias("j"),
            "label", F.lit(False).alias("x"), F.lit(True).alias("y"),
        )
        return links.unionByName(self.verify(as_x.unionByName(as_y), "rest"))

    def run(self) -> DataFrame:
        self.describe()
        labels = self.labelled(self.links(), "all").join(self.classes.select("node", "id"), "node")
        labels = self.written(labels, "all")
        least = self.written(labels.groupBy("label").agg(F.min("id").alias("component"), F.count("*").alias("size")), "least")
        total = least.agg(F.sum("size")).first()[0] or 0
        named = join_groups(labels.select("node", "label"), least, ["label"], "size", total).select("node", "component")
        found = self.classes.join(named, "node", "left").select(
            "digest", "copies", F.coalesce("component", "id").alias("component")
        )
        found = self.written(found, "found")
        linked = self.rows.filter("n > 0 AND id IS NOT NULL").select("id", "digest", "n")
        total = found.agg(F.sum("copies")).first()[0] or 0
        linked = join_groups(linked, found, ["digest"], "copies", total).select("id", "n", "component", "digest")
        alone = self.rows.filter("n = 0 OR id IS NULL").select("id", "n", F.col("id").alias("component"), "digest")
        return linked.unionByName(alone).withColumn("kept", F.col("id").eqNullSafe(F.col("component")))


def near_duplicates(
    docs: DataFrame, *, words: int = 5, percent: int = 80, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row for every row: id, n (size of its set), component (least id reachable), digest (of its text), kept (id = component).

    Rows with equal id and digest have equal results.
    """
    return _Search(docs, id, text, words, percent).run()
