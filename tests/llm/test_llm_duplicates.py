"""Exact and near duplicates against brute force."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import oracle
import pytest

from starmart.llm import near_dedup
from starmart.llm.components import components
from starmart.llm.exact_dedup import DigestIndex, deduplicate, digests
from starmart.llm.near_dedup import near_duplicates
from starmart.llm.queries import ORACLES, QUERIES
from starmart.llm.shingles import as_bytes, shingle_sets, signatures
from starmart.llm.shipping import ship_package
from starmart.session import scratch_path

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, id string, kept string, node int, digest int"


def table(spark, rows):
    ship_package(spark)
    return spark.createDataFrame([(i, t, "x", "y", 1, 2) for i, t in rows], SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def connection():
    oracle.TABLES += [t for t in ("documents", "embeddings") if t not in oracle.TABLES]
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, connection, name):
    assert oracle.differences(QUERIES[name](spark, SF_DIR), connection, ORACLES[name]) is None


# Exact

ROWS = [(1, "Same Text"), (2, "same text"), (5, "SAME text"), (3, None), (4, ""), (6, "É"), (7, "é"), (8, " "), (9, "a" * 100000),
        (10, "A" * 100000), (None, "same text"), (None, "alone"), (11, "twice"), (11, "twice"), (11, "other")]


def expected_exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups["".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")].append(i)
    keep = {k: max((i for i in ids if i is not None), default=None) for k, ids in groups.items()}
    norm = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return sorted(
        (str(i), str(keep[norm(t)]), len(groups[norm(t)]), i == keep[norm(t)], groups[norm(t)].count(keep[norm(t)])) for i, t in rows
    )


def test_exact_groups(spark):
    got = deduplicate(table(spark, ROWS), DigestIndex.temporary(spark)).collect()
    assert sorted((str(r.id), str(r.keep_id), r.group_size, r.kept, r.keep_rows) for r in got) == expected_exact(ROWS)


def test_exact_hot_group(spark):
    rows = [(i, "hot" if i % 3 else f"text {i}") for i in range(3000)]
    got = deduplicate(table(spark, rows), DigestIndex.temporary(spark)).collect()
    assert sorted((str(r.id), str(r.keep_id), r.group_size, r.kept, r.keep_rows) for r in got) == expected_exact(rows)


def test_exact_empty_table(spark):
    index = DigestIndex.temporary(spark)
    assert deduplicate(table(spark, ROWS).limit(0), index).count() == 0


def test_index_persists_and_admits_once(spark):
    index = DigestIndex.temporary(spark)
    deduplicate(table(spark, [(1, "a"), (2, "b")]), index)
    later = deduplicate(table(spark, [(7, "A"), (8, "c"), (9, "C")]), DigestIndex(spark, index.name)).collect()
    assert {(r.id, r.keep_id, r.kept) for r in later} == {(7, 1, False), (8, 9, False), (9, 9, True)}
    index.admit(digests(table(spark, [(7, "A"), (8, "c")])))
    assert sorted(r.keep_id for r in index.read().collect()) == [1, 2, 9]
    assert sorted(r.keep_id for r in index.compact().read().collect()) == [1, 2, 9]


def test_anti_join_reads_the_index_in_buckets(spark):
    index = DigestIndex.temporary(spark)
    rows = digests(table(spark, [(1, "a"), (2, "b")]))
    index.admit(rows)
    plan = rows.join(index.read().hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1
    assert "Python" not in plan


# Near


def sets_of(rows, words):
    out = {}
    for i, t in rows:
        ws = as_bytes(t).split()
        out[i] = {tuple(ws[k : k + words]) for k in range(len(ws) - words + 1)} if len(ws) >= words else {tuple(ws)} if ws else set()
    return out


def expected_components(rows, words=2, percent=80):
    sets = sets_of(rows, words)
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                ra, rb = root(a), root(b)
                label[max(ra, rb)] = min(ra, rb)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def family(draw, first, size, length, changes):
    """Copies of one text, each with some words changed; pairs lie around the threshold."""
    base = [f"w{draw.randrange(10**6)}" for _ in range(length)]
    rows = []
    for k in range(size):
        words = list(base)
        for _ in range(draw.randrange(changes + 1)):
            words[draw.randrange(length)] = f"x{draw.randrange(10**6)}"
        rows.append((first + k, " ".join(words)))
    return rows


def result(df):
    return {r.id: (r.n, r.component, r.kept) for r in df.collect()}


@pytest.mark.parametrize("words", [2, 5])
def test_near_families(spark, words):
    draw = random.Random(words)
    rows = [r for k in range(12) for r in family(draw, 100 * k, draw.randrange(2, 12), draw.randrange(20, 120), 6)]
    draw.shuffle(rows)
    assert result(near_duplicates(table(spark, rows), words=words)) == expected_components(rows, words)


def test_a_large_family_in_many_blocks_and_rounds(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    monkeypatch.setattr(near_dedup, "HUBS", 2)
    rows = family(random.Random(5), 0, 300, 60, 9) + family(random.Random(6), 1000, 30, 60, 2) + [(2000, "one two three")]
    assert result(near_duplicates(table(spark, rows), words=2)) == expected_components(rows)


def test_near_edges(spark):
    long = " ".join(f"v{i % 977}-{i}" for i in range(30000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "One  Two"), (8, "two one"), (9, long),
            (10, long.replace("v5-", "z5-")), (11, "é É"), (12, "É É")]
    assert result(near_duplicates(table(spark, rows), words=2)) == expected_components(rows)


def test_near_nulls_repeats_and_empty_table(spark):
    rows = [(None, "a b c"), (3, "a b c"), (3, "a b c"), (2, "A b c"), (None, None), (5, "x y")]
    got = sorted((str(r.id), r.n, str(r.component), r.kept) for r in near_duplicates(table(spark, rows), words=2).collect())
    assert got == [("2", 2, "2", True), ("3", 2, "2", False), ("3", 2, "2", False), ("5", 1, "5", True), ("None", 0, "None", True), ("None", 2, "None", True)]
    assert near_duplicates(table(spark, rows).limit(0)).count() == 0


def test_an_id_with_several_texts(spark):
    rows = [(1, "a b c d"), (2, "a b c d"), (2, "p q r s"), (3, "p q r s"), (4, "u v"), (4, "w x")]
    got = sorted((r.id, r.component) for r in near_duplicates(table(spark, rows), words=2).collect())
    assert got == [(1, 1), (2, 1), (2, 2), (3, 2), (4, 4), (4, 4)]


def test_posterior_bounds():
    needed = near_dedup.least_matches(80, 128)
    assert (np.diff(needed) > 0).all() and needed[-1] < 0.8 * 128
    rng = np.random.default_rng(1)
    same = rng.random((20000, 128)) < 0.8
    left = np.zeros((20000, 128), np.uint32)
    assert near_dedup.similar_enough(left, np.where(same, 0, 1).astype(np.uint32), needed).mean() > 0.9999
    apart = rng.random((20000, 128)) < 0.4
    assert near_dedup.similar_enough(left, np.where(apart, 0, 1).astype(np.uint32), needed).mean() < 0.01


def test_a_unit_connects_what_is_not_given_up():
    rng = np.random.default_rng(3)
    needed = near_dedup.least_matches(80, 128)
    base = rng.integers(0, 2**32, (6, 128), dtype=np.uint32)
    marks = np.concatenate([np.where(rng.random((9, 128)) < 0.9, b, rng.integers(0, 2**32, (9, 128), dtype=np.uint32)) for b in base])
    nodes, n = np.arange(100, 154), np.full(54, 50)
    x = rng.random(54) < 0.5
    labels = [int(i) if i % 3 else 100 for i in nodes]
    links = near_dedup.compare_unit(nodes, labels, n, x, ~x | (nodes % 2 == 0), marks, 80, needed)
    label = dict(zip(nodes.tolist(), labels))

    def spread(pairs):
        own = dict(label)
        for _ in range(60):
            for a, b in pairs:
                low, high = sorted((own[a], own[b]))
                own = {k: low if v == high else v for k, v in own.items()}
        return own

    y = ~x | (nodes % 2 == 0)
    brute = [
        (int(nodes[i]), int(nodes[j]))
        for i in range(54)
        for j in range(54)
        if i != j and x[i] and y[j] and near_dedup.similar_enough(marks[[i]], marks[[j]], needed)[0]
    ]
    assert spread(links) == spread(brute) and len(links) < len(label)


def test_signatures_estimate_similarity():
    a = " ".join(map(str, range(1000)))
    b = " ".join(map(str, range(100, 1100)))
    sets = shingle_sets([a.encode(), b.encode(), b""], 2)
    marks = signatures(sets, 128)
    true = len(np.intersect1d(sets.of(0), sets.of(1))) / len(np.union1d(sets.of(0), sets.of(1)))
    assert abs((marks[0] == marks[1]).mean() - true) < 0.15 and (marks[2] == 0xFFFFFFFF).all()


def test_components(spark):
    draw = random.Random(7)
    links = [(draw.randrange(400), draw.randrange(400)) for _ in range(300)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    label = {n: n for e in links for n in e}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in links:
        ra, rb = root(a), root(b)
        label[max(ra, rb)] = min(ra, rb)
    found = components(spark.createDataFrame(links, "a long, b long"), scratch_path(spark, "c"))
    assert {r.node: r.label for r in found.collect()} == {n: root(n) for a, b in links if a != b for n in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long"), scratch_path(spark, "c")).count() == 0


def test_no_step_pairs_everything(spark):
    plan = near_duplicates(table(spark, [(1, "a b"), (2, "a b")]))._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("length", [512, 1024, 4096])
def test_words_that_a_polynomial_hash_confuses(spark, length):
    word = "a"
    while len(word) < length:
        word += word.translate(str.maketrans("ab", "ba"))
    rows = [(1, word), (2, word.translate(str.maketrans("ab", "ba"))), (3, f"x {word}"), (4, f"x {word[::-1]}z"), (5, word.upper())]
    assert result(near_duplicates(table(spark, rows), words=2)) == expected_components(rows)


def test_links_do_not_rest_on_hashes(monkeypatch):
    from starmart.llm import arrays, shingles

    draw = random.Random(4)
    texts = [b" ".join(b"%d" % draw.randrange(60) for _ in range(40)) for _ in range(30)] + [b"one", b"two three", b""]
    assert all(shingles.told_apart([a, b], 2) for a in texts for b in texts[:3])
    for a, b in zip(texts, texts[1:]):
        for words in (2, 5):
            x, y = shingles.true_set(a, words), shingles.true_set(b, words)
            sets = shingle_sets([a, b], words)
            assert [len(x), len(y)] == sets.sizes().tolist()
            assert len(x & y) == len(np.intersect1d(sets.of(0), sets.of(1)))
    monkeypatch.setattr(arrays.Words, "hashes", lambda self: np.zeros(len(self.start), np.uint64))
    assert not shingles.told_apart([b"a b c d", b"p q r s"], 2)
    assert shingles.told_apart([b"a a a a", b"a a"], 2)
    assert near_dedup._linked(*[shingle_sets([t], 2).values for t in (b"a b c d", b"p q r s")], 80)
    for limit in (0, 1 << 20):
        monkeypatch.setattr(near_dedup, "LONG_BYTES", limit)
        assert not near_dedup._really_linked(b"a b c d", b"p q r s", 2, 80)
        assert near_dedup._really_linked(b"a b c d e f", b"a b c d e f", 2, 80)


def test_batches_by_falling_id(spark):
    from starmart.llm.exact_dedup import falling_batches

    rows = [(i, f"t{i % 7}" if i % 2 else "Hot") for i in range(200)] + [(None, "t1"), (None, "alone"), (199, "t3")]
    parts = falling_batches(digests(table(spark, rows)), 4)
    ids = [[r.id for r in p.collect()] for p in parts]
    assert sorted(map(str, sum(ids, []))) == sorted(str(i) for i, _ in rows)
    known = [[i for i in part if i is not None] for part in ids]
    assert all(min(a) > max(b) for a, b in zip(known, known[1:])) and [None in part for part in ids] == [False] * 3 + [True]
    for batches in (1, 2, 5):
        index = DigestIndex.temporary(spark)
        got = deduplicate(table(spark, rows), index, batches=batches).collect()
        assert sorted((str(r.id), str(r.keep_id), r.group_size, r.kept, r.keep_rows) for r in got) == expected_exact(rows)
        assert index.read().count() == len({digest for _, digest in digests(table(spark, rows)).collect()})


def test_an_index_keeps_its_buckets(spark):
    index = DigestIndex(spark, DigestIndex.temporary(spark).name, buckets=3, path=scratch_path(spark, "index"))
    index.admit(digests(table(spark, [(1, "a"), (2, "b")])))
    later = DigestIndex(spark, index.name)
    later.admit(digests(table(spark, [(3, "A"), (4, "c")])))
    assert sorted(r.keep_id for r in later.read().collect()) == [1, 2, 4]
