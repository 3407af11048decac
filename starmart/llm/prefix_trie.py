"""The trie of the prefixes that conversations share.

Every distinct turn has an id, a number from 1 over the cluster, and a conversation is the key of its turns' ids, 8
bytes each and big-endian. Equal conversations become one key first, so that copies cost nothing later. The distinct
keys are sorted and numbered over the cluster and cut into runs of ``RUN`` neighbours; a task builds the adaptive
radix tree of a run (``radix_tree``) and reports the nodes that are its own. What two runs may share lies on the paths
of their first and last keys; those paths, two for each run, are the keys of the next round, in which ``FAN`` runs make
one, until one run is left. So no task sees more than ``RUN`` conversations or ``2 * FAN`` paths, however many
conversations share a turn, and nothing is collected. Each round is written to the shared folder.

Rows with a null conversation take no part. Turns are ordered by their number (null first); turns with the same number
by the digest of role and text, and rows that repeat a turn are turns of their own. Null role or text counts as empty.
An empty table has no node, not even a root. A conversation must fit into a task with 12 bytes a turn. Other
columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.columns import join_groups
from starmart.llm.places import with_places, written
from starmart.llm.radix_tree import Border, Part, RadixTree
from starmart.operators.keys import dense_key

#: Keys in a run, and runs that make one in the next round.
RUN, FAN = 2048, 64
#: Ids of equal conversations are listed in chunks of neighbours: at most 2 ** CHUNK_BITS numbers each.
CHUNK_BITS = 16


def turn_table(conversations: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, pos, id, size) of every turn: its place from 0, the id of (role, text) and its code points."""
    who, what = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, what), 256))
    turns = conversations.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        digest.alias("digest"),
        F.char_length(what).alias("size"),
        F.monotonically_increasing_id().alias("row"),
    )
    turns = written(turns, "turns")
    distinct = turns.groupBy("digest").agg(F.count("*").alias("_turns"))
    ids = dense_key(distinct, ["digest"], "id")
    placed = with_places(turns, "conv_id", [F.col("turn").asc_nulls_first(), "digest", "row"])
    found = join_groups(placed, ids, ["digest"], "_turns", turns.count())
    return written(found.select("conv_id", "pos", "id", "size"), "turn-ids")


def key_of(turns: Column) -> Column:
    """The key of an array of turns (id, size)."""
    return F.unhex(F.array_join(F.transform(turns, lambda t: F.lpad(F.hex(t["id"]), 16, "0")), ""))


def sizes_of(turns: Column) -> Column:
    return F.transform(turns, lambda t: t["size"])


def _one_by_key(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row for each key of sorted (key, chunk) rows; a list of ids of any length is hashed as it comes."""
    now, listed = None, None
    for batch in batches:
        done = []
        for key, sizes, members, least, ids in zip(*(batch[c] for c in ("key", "sizes", "members", "least", "ids"))):
            if now is None or now[0] != key:
                if now is not None:
                    done.append((*now, listed.hexdigest()))
                now, listed = [key, sizes, 0, least], hashlib.sha256()
            elif now[2]:
                listed.update(b",")
            now[2] += members
            listed.update(ids.encode())
        yield pd.DataFrame(done, columns=["key", "sizes", "members", "least", "ends"])
    if now is not None:
        yield pd.DataFrame([(*now, listed.hexdigest())], columns=["key", "sizes", "members", "least", "ends"])


_KEYS = "key binary, sizes array<int>, members long, least long, ends string"


def distinct_keys(sequences: DataFrame) -> DataFrame:
    """(key, sizes, members, least, ends) from (conv_id, key, sizes).

    ``ends`` is the digest of the conversations' ids, ascending and joined by commas.
    """
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string")), ",")
    chunks = sequences.groupBy("key", F.shiftright("conv_id", CHUNK_BITS).alias("chunk")).agg(
        F.first("sizes").alias("sizes"), F.count("*").alias("members"), F.min("conv_id").alias("least"), ids.alias("ids")
    )
    ordered = chunks.repartition("key").sortWithinPartitions("key", "chunk")
    return ordered.mapInPandas(_one_by_key, _KEYS)


_LONGS = ("members", "least", "children", "leaves", "saved")
_NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends", "turn_id", "name", "parent_name")
_PATH = ("key", "sizes", *[f"p_{c}" for c in _LONGS], "p_ends")
_RESULT = (
    "run long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved long, ends string,"
    " turn_id long, name binary, parent_name binary, key binary, sizes array<int>, "
    + ", ".join(f"p_{c} array<long>" for c in _LONGS)
    + ", p_ends array<string>"
)


def _round(first: bool, last: bool):
    """The function that builds the tree of a run of keys, or of the paths of several runs."""

    def run(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        tree = RadixTree()
        for row in rows.itertuples(index=False):
            sizes = [int(n) for n in row.sizes]
            if first:
                tree.insert(bytes(row.key), sizes, Part(int(row.members), int(row.least), ends=row.ends))
            else:
                columns = zip(*(getattr(row, f"p_{c}") for c in _LONGS), row.p_ends)
                tree.insert_path(Border(bytes(row.key), sizes, [Part(*map(int, c[:-1]), c[-1]) for c in columns]))
        final, edges = tree.totals(last, not first)
        number = int(group[0])
        found = []
        for p in final:
            t = p.total
            node = (t.least, p.depth, p.parent, t.members, t.children, t.leaves, t.saved, t.ends, p.last_id, p.digest, p.open_parent)
            found.append((number, *node, *[None] * len(_PATH)))
        for e in edges:
            parts = [[getattr(p, c) for p in e.parts] for c in (*_LONGS, "ends")]
            found.append((number, *[None] * len(_NODE), e.key, e.weights, *parts))
        return pd.DataFrame(found, columns=["run", *_NODE, *_PATH], dtype=object)

    return run


def trie(sequences: DataFrame, run_keys: int = RUN, fan: int = FAN) -> DataFrame:
    """One row per node of the trie of (conv_id, key, sizes) rows, one for each conversation.

    conv_id (the least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (over the subtree,
    a node's members but one times the size of its last turn), ends_sha256, turn_id (of its last turn; 0 at the root).
    """
    keys = dense_key(distinct_keys(sequences), ["key"], "number")
    number = F.call_function("div", F.col("number") - 1, F.lit(run_keys))
    items = keys.select(number.alias("run"), "key", "sizes", "members", "least", "ends")
    runs = -(-items.count() // run_keys)
    first, nodes = True, []
    while first or runs:
        build = _round(first, runs <= 1)
        done = written(items.groupBy("run").applyInPandas(build, _RESULT), "trie-round")
        nodes.append(done.filter("key IS NULL").select(*_NODE))
        items = done.filter("key IS NOT NULL").select(F.call_function("div", F.col("run"), F.lit(fan)).alias("run"), *_PATH)
        first, runs = False, 0 if runs <= 1 else -(-runs // fan)
    found = nodes[0]
    for more in nodes[1:]:
        found = found.unionByName(more)
    settled = found.filter("parent_name IS NULL")
    if len(nodes) > 1:
        hanging = found.filter("parent_name IS NOT NULL")
        named = found.filter("name IS NOT NULL").select(F.col("name").alias("parent_name"), F.col("conv_id").alias("_of"), F.col("n_children").alias("_size"))
        joined = join_groups(hanging, named, ["parent_name"], "_size", hanging.count())
        settled = settled.unionByName(joined.withColumn("parent_conv_id", F.col("_of")).select(*_NODE))
    return settled.select(
        *["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves"],
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        "turn_id",
    )


def whole(turns: DataFrame) -> DataFrame:
    """(conv_id, key, sizes) of the conversations of a ``turn_table``, each as it is."""
    listed = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("pos", "id", "size"))).alias("turns"))
    return listed.select("conv_id", key_of(F.col("turns")).alias("key"), sizes_of(F.col("turns")).alias("sizes"))
