"""Benchmark windows in documents against a search word by word."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from starmart.llm import decontamination, wu_manber
from starmart.llm.decontamination import find_windows, n_hit, window_table
from starmart.llm.queries import QUERIES
from starmart.llm.shipping import ship_package
from starmart.llm.wu_manber import PADDING, WuManber

ITEM = "item_id string, text string, window string, block int"
DOC = "doc_id long, text string, item string, window string, block int, before int"


def words_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def expected(docs, items, size=10):
    windows = defaultdict(set)
    for item, text in items:
        ws = words_of(text)
        for k in range(max(1, len(ws) - size + 1) if ws else 0):
            windows[tuple(ws[k : k + size])].add(item or "")
    found = []
    for doc, text in docs:
        ws, hit, names = words_of(text), set(), set()
        for n in {len(w) for w in windows}:
            for k in range(len(ws) - n + 1):
                if tuple(ws[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    names |= windows[tuple(ws[k : k + n])]
        found.append((doc, len(ws), sorted(hit), sorted(names)))
    return sorted(found, key=str)


def plain(df):
    rows = df.select("doc_id", "found", n_hit(F.col("found")).alias("n")).collect()
    out = [(r.doc_id, r.found.n_words, [w for a, b in zip(r.found.first, r.found.last) for w in range(a, b + 1)], r.found["items"]) for r in rows]
    assert [len(o[2]) for o in out] == [r.n for r in rows]
    return sorted(out, key=str)


def prose(draw, n, vocabulary):
    return "".join(draw.choice(vocabulary) + draw.choice([" ", " ", ", ", ".\n", "\t-- "]) for _ in range(n))


def some(seed):
    draw = random.Random(seed)
    vocabulary = ["the", "of", "Émile", "ñ", "a1", "日本", "x" * 40, "and", "b", "Or"]
    items = [(str(i), prose(draw, draw.choice([1, 3, 9, 10, 11, 30]), vocabulary[3 * (i % 2) :])) for i in range(20)]
    items += [("7", "a second text of item seven which is quite another one"), (None, "no id has this item but it has its words"), ("e", ""), ("n", None), ("s", " .\x00- ")]
    docs = []
    for i in range(60):
        text = prose(draw, draw.choice([0, 1, 5, 40]), vocabulary)
        if i % 3:
            ws = words_of(draw.choice(items)[1])
            a = draw.randrange(max(1, len(ws) - 9))
            text += " ".join(w.upper() if w.isascii() else w for w in ws[a : a + draw.choice([9, 10, 25])]) + "!" + prose(draw, 3, vocabulary)
        docs.append((i, text))
    docs += [(60, None), (61, ""), (62, "\x00\x7f @ \n"), (62, docs[1][1]), (None, docs[1][1]), (63, "w " * 3000 + docs[2][1] + " v" * 3000), (64, "x" * 300000)]
    return docs, items


def tables(spark, docs, items):
    ship_package(spark)
    return (
        spark.createDataFrame([(i, t, "x", "y", 1, 2) for i, t in docs], DOC).repartition(3),
        spark.createDataFrame([(i, t, "z", 3) for i, t in items], ITEM).repartition(2),
    )


@pytest.mark.parametrize(("seed", "block_bytes"), [(1, 1 << 20), (2, 1500)])
def test_windows_equal_brute_force(spark, seed, block_bytes):
    docs, items = some(seed)
    documents, benchmark = tables(spark, docs, items)
    found = find_windows(documents, window_table(benchmark), block_bytes=block_bytes)
    assert plain(found) == expected(docs, items)
    assert set(documents.columns) < set(found.columns)


def test_nothing_to_search_for(spark):
    docs, items = some(3)
    documents, benchmark = tables(spark, docs, items)
    assert plain(find_windows(documents, window_table(benchmark.limit(0)))) == expected(docs, [])
    assert find_windows(documents.limit(0), window_table(benchmark)).count() == 0


def test_query_on_its_edge_rows(spark, tmp_path):
    docs, items = some(4)
    documents, benchmark = tables(spark, docs, items)
    documents.write.parquet(f"{tmp_path}/documents.parquet")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = QUERIES["op13_decontamination"](spark, str(tmp_path)).collect()
    mine = sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.contaminated) for r in rows)
    assert mine == sorted((str(d), n, len(hit), len(names), bool(hit)) for d, n, hit, names in expected(docs, items))


@pytest.mark.parametrize("seed", range(8))
def test_search_equals_find(monkeypatch, seed):
    draw = random.Random(seed)
    monkeypatch.setattr(wu_manber, "LANE", draw.choice([1, 16, 1024]))
    monkeypatch.setattr(wu_manber, "PAIRS", draw.choice([3, 1 << 16]))
    letters = b"ab" if seed % 2 else bytes(range(256))
    text = bytes(draw.choice(letters) for _ in range(5000))
    strings = [text[a : a + draw.choice([1, 2, 5, 9, 33, 300])] for a in (draw.randrange(5000) for _ in range(80))]
    strings = sorted({*strings, *(bytes(draw.choice(letters) for _ in range(draw.choice([3, 20]))) for _ in range(20)), text[-40:] + b"a"} - {b""})
    place, string = WuManber(strings).find(np.frombuffer(text + bytes(PADDING), np.uint8))
    got = sorted(zip(place.tolist(), string.tolist()))
    want = [(m.start(), i) for i, s in enumerate(strings) for m in re.finditer(b"(?=" + re.escape(s) + b")", text, re.S)]
    assert got == sorted(want) and len(set(got)) == len(got)


def test_windows_of_an_item():
    assert decontamination.windows_of("A b-C") == [b" a b c "]
    assert len(decontamination.windows_of(" ".join(map(str, range(12))))) == 3
    assert decontamination.windows_of("--") == decontamination.windows_of(None) == []
