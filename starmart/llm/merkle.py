"""Merkle manifest of a dataset: a tree of digests over each group of rows, and one tree over the groups.

A leaf is the digest of a row's fields. The leaves of a group ascend by id; while a level of the group's tree has
several nodes, every run of ``fanout`` of them (the last run may be shorter) has the digest of its nodes as its
parent. What remains is the group's subroot, and the subroots, ordered by group (null first, then bytewise), are the
leaves of the tree whose top is the root. Digests are SHA-256 in lower-case hex, and they are hashed as that text.

**Slot pivot.** A place in a level splits into a parent and a slot. One grouping by parent spreads its children into
fanout columns by conditional aggregates; the columns joined are hashed to the parent, and the columns but a child's
own are its siblings. A grouping takes several levels at a time: it spreads as many descendants of a node as there
are in ``WIDTH`` columns, and hashes them level by level where they lie. Sibling paths are handed down the same
tables, from the root to the leaves. All of it is DataFrame functions; a grouping holds at most ``WIDTH`` rows by
key, places are numbered over the cluster, and the number of steps is that of the levels divided by those in a table.

A null field counts as ``-`` and any other as its length in bytes, a colon and its text, so that no two rows have
the same encoding unless their fields are equal. Rows with a null id come first; rows that repeat an id are ordered by
their leaf, and equal rows are leaves of their own beside each other (the siblings of each are the same as if they had
changed places). A null group is a group. An empty table has an empty manifest. Columns other than the fields, the id,
the group and what ``carry`` reads are never read; the names of the result don't clash with them, because carried
values come under names of the caller's.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.places import with_places, written
from starmart.operators.keys import dense_key

FANOUT = 2
#: Columns into which one grouping spreads descendants, at most (one level is always taken).
WIDTH = 16


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def encoded(value: Column) -> Column:
    """A field as text that no other value or row of fields shares."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(*fields: Column) -> Column:
    """The leaf of a row with these fields."""
    return digest(F.concat(*map(encoded, fields)))


def fold(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and its siblings."""
    return F.aggregate(path, leaf, lambda node, at: digest(F.concat(at["left"], node, at["right"])))


def siblings(path: Column) -> Column:
    """The siblings of a leaf, level by level and from left to right, as one text."""
    return F.array_join(F.transform(path, lambda at: F.concat(at["left"], at["right"])), "")


class _Shape:
    """The fanout, and the levels that one grouping takes."""

    def __init__(self, fanout: int):
        if fanout < 2:
            raise ValueError("a parent needs two children at least")
        self.fanout, self.levels = fanout, 1
        while fanout ** (self.levels + 1) <= WIDTH:
            self.levels += 1
        self.width = fanout**self.levels

    def across(self, level: int) -> int:
        """Nodes of a level (0: the lowest) in one grouping."""
        return self.width // self.fanout**level

    def several(self, level: int) -> Column:
        """Whether a level of the group's tree has several nodes, and so is hashed to the next."""
        return F.col("n") > self.fanout**level


def _div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b))


def _hashed(shape: _Shape, level: int) -> Column:
    """The parents of the nodes of a level."""

    def parent(i: Column) -> Column:
        children = F.slice(F.col(f"h{level}"), i * shape.fanout + 1, F.lit(shape.fanout))
        return F.when(F.get(children, 0).isNotNull(), digest(F.array_join(children, "")))

    return F.transform(F.sequence(F.lit(0), F.lit(shape.across(level + 1) - 1)), parent)


def _pivot(nodes: DataFrame, shape: _Shape) -> DataFrame:
    """(key, at, n, items) and the nodes of each level in an array ``h<level>``, one row by parent.

    From (key, pos, n, h, item): ``n`` nodes in the level of each key. Where a level has one node, it is that of
    all higher levels. Slots without a child are null.
    """
    slot = F.pmod("pos", F.lit(shape.width))
    spread = [F.max(F.when(slot == i, F.col(c))).alias(f"{c}_{i}") for c in ("h", "item") for i in range(shape.width)]
    parents = nodes.groupBy("key", _div(F.col("pos"), shape.width).alias("at")).agg(F.max("n").alias("n"), *spread)
    columns = {name: F.array(*[F.col(f"{c}_{i}") for i in range(shape.width)]) for name, c in (("h0", "h"), ("items", "item"))}
    parents = parents.select("key", "at", "n", *[column.alias(name) for name, column in columns.items()])
    for level in range(shape.levels):
        parents = parents.withColumn(f"h{level + 1}", F.when(shape.several(level), _hashed(shape, level)).otherwise(F.col(f"h{level}")))
    return parents


def _climb(nodes: DataFrame, shape: _Shape) -> list[DataFrame]:
    """The groupings from the leaves to the tops of all trees; the last one has one row by key."""
    tables = []
    while not tables or not tables[-1].filter(F.col("n") > shape.width).isEmpty():
        if tables:
            nodes = tables[-1].select(
                "key", F.col("at").alias("pos"), _div(F.col("n") + shape.width - 1, shape.width).alias("n"), _top(shape).alias("h")
            ).withColumn("item", F.lit(None).cast("boolean"))
        tables.append(written(_pivot(nodes, shape), "merkle-level"))
    return tables


def _top(shape: _Shape) -> Column:
    return F.get(f"h{shape.levels}", 0)


def _descend(tables: list[DataFrame], tops: DataFrame, shape: _Shape) -> DataFrame:
    """(key, h, item, path, end) of every leaf, from (key, at, path, end) of the tops.

    A path has the siblings to the left and to the right in each level, from the leaf up: the columns of a run
    before and after a node's own.
    """
    above = tops
    for table in reversed(tables):
        known = above.select("key", "at", "path", "end")
        wide = table.join(known, ["key", "at"]).select("*", F.posexplode("h0").alias("slot", "h")).filter(F.col("h").isNotNull())
        entries = []
        for level in range(shape.levels):
            own = _div(F.col("slot"), shape.fanout**level).cast("int")
            before = F.pmod(own, F.lit(shape.fanout))
            left = F.slice(F.col(f"h{level}"), own - before + 1, before)
            right = F.slice(F.col(f"h{level}"), own + 2, F.lit(shape.fanout - 1) - before)
            sides = F.struct(F.array_join(left, "").alias("left"), F.array_join(right, "").alias("right"))
            entries.append(F.when(shape.several(level), sides))
        above = wide.select(
            "key",
            (F.col("at") * shape.width + F.col("slot")).alias("at"),
            "h",
            F.get("items", F.col("slot")).alias("item"),
            F.concat(F.array_compact(F.array(*entries)), F.col("path")).alias("path"),
            "end",
        )
    return above


def manifest(
    docs: DataFrame,
    fields: list[str],
    *,
    id: str = "doc_id",
    group: str = "lang",
    fanout: int = FANOUT,
    carry: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: id, leaf, subroot, root, path, and the ``carry`` columns by their names.

    ``path`` is an array of (left, right), the siblings in each level from the leaf to the root as joined texts;
    ``fold`` recomputes a root from it and ``siblings`` lists it.
    """
    carry = dict(carry or {})
    shape = _Shape(fanout)
    item = F.struct(F.col(id).alias("id"), *[value.alias(f"carried_{i}") for i, value in enumerate(carry.values())])
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("key"),
        item.alias("item"),
        leaf_of(*[F.col(c) for c in fields]).alias("h"),
        F.monotonically_increasing_id().alias("row"),
    )
    placed = with_places(written(leaves, "merkle-leaves"), "key", [F.col("item.id").asc_nulls_first(), "h", "row"])
    trees = _climb(placed.select("key", "pos", "n", "h", "item"), shape)
    subroots = trees[-1].select("key", _top(shape).alias("h"))

    numbered = dense_key(subroots, ["key"], "pos")
    groups = numbered.count()
    over = numbered.select(
        F.lit("").alias("key"), (F.col("pos") - 1).alias("pos"), F.lit(groups).cast("long").alias("n"), "h", F.struct(F.col("key").alias("of")).alias("item")
    )
    top = _climb(over, shape)
    no_path = F.array().cast("array<struct<left:string,right:string>>")
    root = F.struct(_top(shape).alias("root"))
    ends = _descend(top, top[-1].select("key", F.lit(0).cast("long").alias("at"), no_path.alias("path"), root.alias("end")), shape)
    ends = ends.select(
        F.col("item.of").alias("key"), F.lit(0).cast("long").alias("at"), "path", F.struct(F.col("h").alias("subroot"), "end.root").alias("end")
    )
    found = _descend(trees, ends, shape)
    carried = [F.col(f"item.carried_{i}").alias(name) for i, name in enumerate(carry)]
    return found.select(F.col("item.id").alias("id"), F.col("h").alias("leaf"), "end.subroot", "end.root", "path", *carried)
