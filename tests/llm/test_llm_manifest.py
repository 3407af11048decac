"""The Merkle manifest against a tree built in memory."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from starmart.llm import merkle
from starmart.llm.places import with_places
from starmart.llm.queries import QUERIES

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, key string, pos int, h string"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(leaves, fanout):
    """The top, and the siblings of each leaf as a list of (left, right) by level."""
    paths, at, level = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(level) > 1:
        for path, i in zip(paths, at):
            first = i - i % fanout
            path.append(("".join(level[first:i]), "".join(level[i + 1 : first + fanout])))
        at = [i // fanout for i in at]
        level = [sha("".join(level[i : i + fanout])) for i in range(0, len(level), fanout)]
    return level[0], paths


def expected(rows, fanout):
    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append(row)
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    found, subroots = [], []
    for lang in langs:
        ordered = sorted(groups[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        top, paths = tree([leaf_of(r) for r in ordered], fanout)
        subroots.append(top)
        found += [(r[0], leaf_of(r), lang, top, path) for r, path in zip(ordered, paths)]
    root, over = tree(subroots, fanout) if subroots else (None, [])
    return [(i, leaf, top, root, path + over[langs.index(lang)]) for i, leaf, lang, top, path in found]


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1, "z") for r in rows], SCHEMA).repartition(3)


ROWS = [(i, "web", "en", 5, f"text {i}") for i in range(77)]
ROWS += [(i, None, "de", None, "é" * i) for i in range(100, 117)]
ROWS += [(200, "a", None, 1, None), (None, "a", None, 2, ""), (201, "a", "", 1, "long " * 20000), (-3, "b", "z", 2**63 - 1, "x")]
ROWS += [(300, "s", "fr", 1, "twice"), (300, "s", "fr", 1, "twice"), (300, "s", "fr", 1, "other"), (5, "web", "en", 5, "other")]


@pytest.mark.parametrize("fanout", [2, 3, 20])
def test_manifest_equals_brute_force(spark, fanout):
    got = merkle.manifest(table(spark, ROWS), FIELDS, fanout=fanout, carry={"leaf2": F.col("leaf")}).collect()
    mine = [(r.id, r.leaf, r.subroot, r.root, [tuple(p) for p in r.path]) for r in got]
    assert sorted(mine, key=str) == sorted(expected(ROWS, fanout), key=str)
    assert {r.leaf2 for r in got} == {"x"}


def test_one_row_and_no_row(spark):
    (one,) = merkle.manifest(table(spark, ROWS[:1]), FIELDS).collect()
    assert one.leaf == one.subroot == one.root == leaf_of(ROWS[0]) and one.path == []
    assert merkle.manifest(table(spark, ROWS).limit(0), FIELDS).count() == 0


def test_fold_finds_what_was_changed(spark):
    rows = merkle.manifest(table(spark, ROWS), FIELDS)
    folded = rows.select("root", merkle.fold(F.col("leaf"), F.col("path")).alias("same"), merkle.fold(F.lit("0" * 64), F.col("path")).alias("other"))
    assert all(r.same == r.root != r.other for r in folded.collect())


def test_places_in_a_hot_group(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(7).cast("string").alias("g"), (-F.col("id")).alias("o"))
    groups = defaultdict(list)
    for r in rows.collect():
        groups[r.g].append(r.o)
    for r in with_places(rows, "g", ["o"]).collect():
        assert r.n == len(groups[r.g]) and sorted(groups[r.g])[r.pos] == r.o


def test_query_on_nulls_and_the_largest_number(spark, tmp_path):
    table(spark, ROWS).write.parquet(f"{tmp_path}/documents.parquet")
    for r in QUERIES["op12_merkle"](spark, str(tmp_path)).collect():
        assert r.verified == (r.folded_root == r.root)
    ids = {r[0] for r in ROWS if r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0}
    got = {r.doc_id for r in QUERIES["op12_merkle"](spark, str(tmp_path)).collect() if not r.verified}
    assert got == ids and ids
