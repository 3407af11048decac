"""The prefix trie against a dictionary of prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from starmart.llm import prefix_trie, radix_tree
from starmart.llm.queries import QUERIES
from starmart.llm.radix_tree import Part, RadixTree

SCHEMA = "conv_id long, turn long, role string, text string, pos int, key string, id int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(sequences):
    """Rows of the trie from {conversation: list of (role, text)}."""
    members, ends = defaultdict(list), defaultdict(list)
    for conv, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
        ends[tuple(turns)].append(conv)
    children = defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    saved, leaves = defaultdict(int), defaultdict(int)
    for path, convs in members.items():
        for d in range(len(path) + 1):
            saved[path[:d]] += (len(convs) - 1) * len(path[-1][1]) if path else 0
            leaves[path[:d]] += children[path] == 0
    rows = [
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], sha(",".join(map(str, sorted(ends[p])))))
        for p, m in members.items()
    ]
    return sorted(rows, key=str)


def own_turns(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            who, what = role or "", text or ""
            turns[conv].append((turn is not None, turn or 0, sha(f"{len(who.encode())}:{who}{what}"), who, what))
    return {c: [t[3:] for t in sorted(ts)] for c, ts in turns.items()}


def rebuilt(rows):
    own = own_turns(rows)
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def some_rows(n, seed):
    draw = random.Random(seed)
    return [(c, t, draw.choice("ua"), draw.choice(["", "é", "x" * 9])) for c in range(n) for t in range(draw.choice([1, 2, 3, 3, 9]))]


ROWS = some_rows(230, 1) + [
    *[(5000, t, "u", f"own {t}") for t in range(120)],
    *[(5001, t, "u", f"own {t}") for t in range(90)],
    *[(6001, 1, "u", "alone"), (-5, 1, "u", "below"), (-5, 2, None, None), (0, None, "u", "null turn"), (7, 3, "u", "tie")],
    *[(7, 3, "u", "eit"), (7, 3, "u", "tie"), (None, 1, "u", "no conversation"), (2**62, 1, "u", "large" * 30000)],
    *[(2**62, 2, "a", None), (9100, 1, "u", "a"), (9142, 1, "u", "b")],
]


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(3)


def plain(df):
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in df.select(columns).collect()), key=str)


@pytest.mark.parametrize(("run_keys", "fan"), [(2048, 64), (7, 3)])
def test_trie_equals_brute_force(spark, run_keys, fan):
    turns = prefix_trie.turn_table(table(spark, ROWS))
    assert plain(prefix_trie.trie(prefix_trie.whole(turns), run_keys, fan)) == expected(own_turns(ROWS))


def test_query_equals_brute_force(spark, tmp_path):
    table(spark, ROWS).write.parquet(f"{tmp_path}/conversations.parquet")
    assert plain(QUERIES["op11_prefix_trie"](spark, str(tmp_path))) == expected(rebuilt(ROWS))


def test_empty_table(spark):
    turns = prefix_trie.turn_table(table(spark, ROWS).limit(0))
    assert prefix_trie.trie(prefix_trie.whole(turns)).count() == 0


def test_copies_beyond_a_chunk(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK_BITS", 2)
    rows = [(c, t, "u", "same") for c in range(300) for t in range(2)]
    turns = prefix_trie.turn_table(table(spark, rows))
    assert plain(prefix_trie.trie(prefix_trie.whole(turns))) == expected(own_turns(rows))


def in_runs(keys, size, fan):
    """Totals of keys {key: members} by trees of runs of this size, joined by fan until one is left."""
    items = sorted(keys.items())
    runs = [items[i : i + size] for i in range(0, len(items), size)]
    found, first = [], True
    while True:
        paths = []
        for run in runs:
            tree = RadixTree()
            for item in run:
                if first:
                    tree.insert(item[0], [1] * (len(item[0]) // 8), Part(len(item[1]), min(item[1])))
                else:
                    tree.insert_path(item)
            final, edges = tree.totals(len(runs) == 1, not first)
            found += final
            paths.append(edges)
        if len(runs) == 1:
            break
        runs = [[e for es in paths[i : i + fan] for e in es] for i in range(0, len(paths), fan)]
        first = False
    named = {p.digest: p.total.least for p in found if p.digest}
    parent = lambda p: named[p.open_parent] if p.open_parent else p.parent
    return sorted((p.depth, p.total.least, p.total.members, p.total.children, p.total.leaves, p.total.saved, parent(p) or 0) for p in found)


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_any_size_give_one_trie(seed):
    draw = random.Random(seed)
    ids = [draw.randrange(1, draw.choice([3, 300, 1 << 40])) for _ in range(draw.choice([2, 9, 600]))]
    keys = defaultdict(list)
    for member in range(900):
        path = [draw.choice(ids[: 1 + 600 // (d + 1) ** 3]) for d in range(draw.randrange(6))]
        keys[b"".join(i.to_bytes(8, "big") for i in path)].append(member)
    whole = in_runs(keys, 10**9, 2)
    assert whole[0][2] == 900 and all(in_runs(keys, size, fan) == whole for size, fan in ((1, 2), (3, 2), (50, 3)))


def test_layouts_grow():
    tree, kinds = RadixTree(), set()
    for n in range(256):
        tree.insert(n.to_bytes(8, "big") + n.to_bytes(8, "big"), [1, 1], Part(1, n))
        kinds.add(type(tree.root.children).__name__)
    assert kinds == {"NoneType", "Layout4", "Layout16", "Layout48", "Layout256"}
    assert tree.root.prefix == bytes(7) and radix_tree.WIDTH == 8
    final, edges = tree.totals(True, False)
    assert len(final) == 513 and not edges
