"""Mixing, classifiers, search and the pipeline against brute force, held-out accuracy and edge rows."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from starmart.llm import byte_bpe, language_id, mixing, pu_learning, quality, topk, toxicity
from starmart.llm.columns import free_name, in_class
from starmart.llm.queries import ORACLES, QUERIES
from starmart.llm.shipping import ship_package
from starmart.session import scratch_path

SF_DIR = "/root/testdata/sf0.001"


# Mixing


def draw(*parts):
    return int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:8], 16)


def brute_mix(rows, plan):
    """Copies of each (source, id), by going through every source's permutation row by row."""
    out = Counter()
    for s in plan.sources:
        docs = defaultdict(int)
        for i, source, tokens in rows:
            if ("null" if source is None else "=" + source) == s.key:
                docs["null" if i is None else str(i)] += tokens
        for i in docs:
            out[s.key, i] += s.passes
        room = s.budget - s.passes * s.tokens if s.tokens else 0
        blocks = defaultdict(list)
        for i in docs:
            blocks[draw("block", i) % s.blocks].append(i)
        for b in sorted(blocks, key=lambda b: (draw("order", s.key, b, s.passes), b)):
            if room <= 0:
                break
            total = sum(docs[i] for i in blocks[b])
            if total <= room:
                out.update((s.key, i) for i in blocks[b])
                room -= total
                continue
            for i in sorted(blocks[b], key=lambda i: (draw("order", i, s.passes), i)):
                room -= docs[i]
                if room < 0:
                    break
                out[s.key, i] += 1
            break
    return out


@pytest.mark.parametrize("repeats, budget", [(2.0, None), (100.0, None), (1.0, None), (3.0, 4000)])
def test_mix_equals_brute_force(spark, repeats, budget):
    rng = random.Random(1)
    rows = [(i, "abcd"[min(3, int(rng.expovariate(1)))] if i % 50 else None, rng.randrange(0, 40)) for i in range(700)]
    rows += [(9000, "zero", 0), (None, "a", 5), (1, "a", 7), (1, "a", 7)]
    df = spark.createDataFrame([(i, s, t, "x") for i, s, t in rows], "doc_id long, source string, tokens int, k string")
    plan = mixing.plan_mix(df, F.col("tokens"), max_repeats=repeats, budget=budget)
    got = Counter()
    for r in plan.apply(df.select("doc_id", "source", "k").distinct()).collect():
        got["null" if r.source is None else "=" + r.source, str(r.doc_id) if r.doc_id is not None else "null"] += 1
    expected = {k: v for k, v in brute_mix(rows, plan).items() if v}
    assert got == expected
    if budget is None:
        assert min(got.values()) >= 1 and len(got) == len({(s, i) for i, s, _ in rows})
    rates = [s.budget / s.tokens for s in plan.sources if s.tokens]
    assert max(rates) / min(rates) <= repeats * 1.01 + 0.05


def test_exponent():
    assert mixing.exponent_for([10, 10, 10], 1.0, 10) == pytest.approx(1.0)
    assert mixing.exponent_for([5], 0.9, 2) == 1.0 and mixing.exponent_for([0, 7], 0.9, 2) == 1.0
    x = mixing.exponent_for([1000, 10, 10], 0.9, 1e9)
    assert mixing.entropy(mixing.tempered([1000, 10, 10], x)) == pytest.approx(0.9 * math.log(3), abs=1e-6)
    y = mixing.exponent_for([1000, 10, 10], 0.9, 3)
    assert y > x and (1000 / 10) ** (1 - y) == pytest.approx(3, rel=1e-6)


def test_mix_of_nothing_and_of_no_tokens(spark):
    df = spark.createDataFrame([(1, "a", 0), (2, None, 0)], "doc_id long, source string, tokens int")
    assert sorted(r.doc_id for r in mixing.plan_mix(df, F.col("tokens")).apply(df).collect()) == [1, 2]
    none = df.limit(0)
    assert mixing.plan_mix(none, F.col("tokens")).apply(none).count() == 0


def test_more_sources_than_the_bound_are_refused(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"s{i}", 3) for i in range(5)], "doc_id long, source string, tokens int")
    monkeypatch.setattr(mixing, "MOST_SOURCES", 5)
    assert len(mixing.plan_mix(df, F.col("tokens")).sources) == 5
    monkeypatch.setattr(mixing, "MOST_SOURCES", 4)
    with pytest.raises(ValueError, match="more than 4 sources"):
        mixing.plan_mix(df, F.col("tokens"))


def test_samples_are_bounded_for_an_id_of_many_texts(spark):
    texts = [(1, f"words number {i}", "en") for i in range(200)] + [(2, "other words", "en"), (3, None, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    rows, _ = pu_learning.training_rows(
        docs, labels, "toxic", F.lit(True), positives=5, unlabelled=500, id="doc_id", text=F.col("text")
    )
    got = sorted((r.positive, r.text) for r in rows.collect())
    assert got == [(False, ""), (False, "other words"), (False, "words number 0"), (True, "words number 0")]
    ((lang, sample),) = language_id.fit(docs, F.lit(True)).samples
    assert lang == "en" and sorted(sample.split()) == sorted("words number 0 other words".split())


def test_word_count(spark):
    rows = [(None,), ("",), (" \n",), ("a",), (" a  b\x0bc d ",)]
    assert [r[0] for r in spark.createDataFrame(rows, "t string").select(mixing.word_count(F.col("t"))).collect()] == [0, 0, 0, 1, 3]


def test_mix_query_spends_every_document(spark):
    got = QUERIES["op1_mixing"](spark, SF_DIR)
    assert got.select("doc_id").distinct().count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()


# Classifiers


def test_non_negative_risk_learns_from_positives():
    rng = np.random.default_rng(1)
    good, bad = rng.normal(1.5, 1, (600, 3)), rng.normal(-1.5, 1, (1400, 3))
    model = pu_learning.fit(good[:300], np.concatenate([good[300:], bad[:900]]), 0.25)
    assert (model.probability(good) > 0.5).mean() > 0.95 and (model.probability(bad) < 0.5).mean() > 0.95


def test_no_positives_gives_the_prior():
    model = pu_learning.fit(np.zeros((0, 2)), np.ones((5, 2)), 0.2)
    assert model.probability(np.ones((1, 2)))[0] == pytest.approx(0.2)


@pytest.mark.parametrize("name, label, least", [("op7_quality", "quality", 0.95), ("op10_toxicity", "toxic", 0.93)])
def test_held_out_accuracy(spark, name, label, least):
    sf_dir = "/root/testdata/sf0.01"
    got = QUERIES[name](spark, sf_dir)
    assert got.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    rows = got.join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").filter("held_out")
    right = rows.agg(F.avg((F.col("predicted") == F.col(label)).cast("int"))).first()[0]
    assert right > least
    assert got.filter("score IS NULL OR score < 0 OR score > 1").isEmpty()


EDGES = [None, "", " ", "\n", "a", "12 !!", "IDIOT!", "é ß", "the the the the", "word " * 20000, "%%% *** $$$", "A" * 3000]


@pytest.mark.parametrize("module", [quality, toxicity])
def test_scores_of_edge_texts(spark, module):
    ship_package(spark)
    docs = spark.createDataFrame([(i, t, 1, 0.0) for i, t in enumerate(EDGES * 8)], "doc_id long, text string, positive int, score double")
    label = "quality" if module is quality else "toxic"
    rows = [(i, i % 2, i % 12 == 6) for i in range(90)] + [(None, 1, True), (3, None, None), (5, 0, False), (5, 1, True)]
    labels = spark.createDataFrame([(i, q, None if x is None else int(x)) for i, q, x in rows], "doc_id long, quality int, toxic int")
    model = module.fit(docs, labels, ~in_class(F.col("doc_id"), 5, 0), label=label)
    got = {r.doc_id: r.s for r in docs.select("doc_id", module.score(model)("text").alias("s")).collect()}
    assert len(got) == len(EDGES) * 8 and all(0 <= s <= 1 for s in got.values())
    assert all(got[i] == got[i + len(EDGES)] for i in range(len(EDGES)))
    assert got[0] == got[1] == got[2]
    none = module.fit(docs, labels.limit(0), F.lit(True), label=label)
    assert docs.limit(3).select(module.score(none)("text")).count() == 3
    empty = module.fit(docs.limit(0), labels, F.lit(True), label=label)
    assert docs.limit(0).select(module.score(empty)("text")).count() == 0


def test_scores_do_not_depend_on_the_slice():
    texts = [(t or "").encode() for t in EDGES]
    whole = quality.describe(texts)
    for i, t in enumerate(texts):
        assert np.allclose(quality.describe([t])[0], whole[i])
    owner, marks = toxicity.marks_of([t or "" for t in EDGES])
    for i, t in enumerate(EDGES):
        assert list(marks[owner == i]) == list(toxicity.marks_of([t or ""])[1])
    assert len(toxicity.marks_of(["Idiot!"])[1]) == 2 and set(toxicity.marks_of(["idiot"])[1]) == set(toxicity.marks_of(["(IDIOT,"])[1])


# Search


def brute_top(rows, asks, k):
    ints = {}
    listed = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        listed.append((i, [math.floor(256 * x) for x in v]))
    for i, v in listed:
        ints[i] = min(ints.get(i, v), v)
    out = set()
    for q, vector in ints.items():
        if not asks(q):
            continue
        best = sorted((-sum(a * b for a, b in zip(vector, v)), i) for i, v in listed if i != q)[:k]
        out |= {(q, r, i, -s) for r, (s, i) in enumerate(best, 1)}
    return out


@pytest.mark.parametrize("cell", [8, 4096])
def test_search_equals_brute_force(spark, monkeypatch, cell):
    ship_package(spark)
    monkeypatch.setattr(topk, "CELL", cell)
    monkeypatch.setattr(topk, "BLOCK", 7)
    rng = random.Random(3)
    rows = [(i, [rng.gauss(i % 5, 0.3) for _ in range(6)]) for i in range(400)]
    rows += [(1000 + i, [0.5, 0.5, 0.5, 0.0, 0.0, 0.0]) for i in range(60)]
    rows += [(2000, None), (2001, []), (2002, [1.0, None]), (2003, [float("nan")] * 6), (2004, [float("inf")] * 6), (None, [1.0] * 6),
             (2010, [3.0, 3.0]), (20, [9.0] * 6), (20, [9.0] * 6), (2020, []), (2005, [1e300] * 2)]
    df = spark.createDataFrame([(i, v, 1, 1.0) for i, v in rows], "vec_id long, embedding array<double>, id int, score double")
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, k=5)
    rows = [r for r in rows if r[0] != 2005]  # beyond what the integers hold
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute_top(rows, lambda i: i % 20 == 0, 5))


def test_large_products_are_exact():
    rng = random.Random(8)
    for bits in (20, 28, 30, 31, 40, 63):
        a, b = ([[rng.randrange(-(2**bits), 2**bits) for _ in range(5)] for _ in range(40)] for _ in range(2))
        a[0], b[0] = [-(2**bits)] * 5, [1, -1, 0, 0, 0]
        got = topk._products(np.array(a, np.int64), np.array(b, np.int64))
        for x, row in zip(a, got.tolist()):
            assert row == [max(-topk.BEYOND, min(topk.BEYOND, sum(p * q for p, q in zip(x, y)))) for y in b]
    wide = np.full((1, 1500), 2**26, np.int64)
    assert topk._large_products(wide, wide)[0, 0] == 1500 * 2**52


def test_search_of_large_vectors(spark, monkeypatch):
    ship_package(spark)
    monkeypatch.setattr(topk, "CELL", 8)
    rng = random.Random(9)
    rows = [(i, [rng.gauss(i % 5, 0.3) * 3e5 for _ in range(4)]) for i in range(60)] + [(101, [300000.0] * 4), (102, [-300000.0] * 4)]
    rows += [(i, [rng.gauss(0, 1) * 1e6 for _ in range(4)]) for i in range(200, 240)] + [(301, [2.0**24, 0.0, 0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, k=5)
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute_top(rows, lambda i: i % 20 == 0, 5))
    with pytest.raises(Exception, match="the score is no long"):
        topk.top_k(spark.createDataFrame([(0, [2.0**40]), (1, [2.0**40])], df.schema), F.col("vec_id") == 0).collect()


def test_search_of_few_rows(spark):
    ship_package(spark)
    df = spark.createDataFrame([(0, [1.0, 2.0]), (3, [0.0, 0.0]), (4, [1.0, 1.0])], "vec_id long, embedding array<float>")
    got = topk.top_k(df, F.col("vec_id") == 0, k=5)
    assert sorted((r.rank, r.id) for r in got.collect()) == [(1, 4), (2, 3)]
    assert topk.top_k(df.limit(0), F.col("vec_id") == 0).count() == 0
    assert topk.top_k(df.filter("vec_id = 0"), F.col("vec_id") == 0).count() == 0


def test_search_of_empty_vectors(spark):
    ship_package(spark)
    rows = [(0, []), (1, []), (2, [-1.0, 0.0]), (3, [2.0, 1.0]), (20, [-3.0, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for some in (df, df.filter("vec_id < 2")):
        got = topk.top_k(some, F.col("vec_id") % 20 == 0, k=3)
        listed = [tuple(r) for r in some.collect()]
        assert sorted(tuple(r) for r in got.collect()) == sorted(brute_top(listed, lambda i: i % 20 == 0, 3))
    frame = df.toPandas()
    con = duckdb.connect()
    con.register("embeddings", frame)
    sql = ORACLES["op8_top_k"].replace("% 50", "% 20")
    assert sorted(con.execute(sql).fetchall()) == sorted(brute_top(rows, lambda i: i % 20 == 0, 5))


def test_bounds_hold():
    rng = np.random.default_rng(2)
    points, pivots = rng.normal(size=(300, 4)), rng.normal(size=(3, 4))
    away = topk._distances(points, pivots)
    near, distance = away.argmin(axis=1), away.min(axis=1)
    annuli = [(p, 0, distance[near == p].min(), distance[near == p].max()) for p in range(3)]
    queries = rng.normal(size=(50, 4))
    real = topk._distances(queries, points)
    bound = topk._bounds(queries, pivots, annuli)
    for p in range(3):
        assert (bound[:, [p]] <= real[:, near == p] + 1e-6).all()


# Pipeline


def test_free_name(spark):
    assert free_name(spark.createDataFrame([(1, 2)], "Id int, _id int"), "id") == "__id"


def write(df, spark):
    path = scratch_path(spark, "stage")
    df.write.parquet(path)
    return spark.read.parquet(path)


EXTRA = "doc_id long, text string, lang string, source string, n_chars long, id int, digest int, bpe int, k string, pass int"


def test_stages_on_edge_rows(spark):
    long = " ".join(f"word{i % 91}x{i}" for i in range(5000))
    texts = ["the cat sat on the mat today", "The cat sat on the mat today", None, "", "12 34", "der hund und die katze hier",
             "привет мир тут", long, long.replace("word5x5 ", "other "), "only one of these here now", "twice", "twice"]
    ids = [1, 2, 3, 4, 5, 6, 7, 8, 9, None, 11, 11]
    langs = ["en", "en", None, "en", None, "de", None, "en", "en", "en", "en", "en"]
    rows = [(i, t, g, None if i == 6 else "s", 1, 7, 8, 9, "k", 3) for i, t, g in zip(ids, texts, langs)]
    docs = spark.createDataFrame(rows, EXTRA)
    kept = {"language": {1, 2, 6, 8, 9, None, 11}, "exact": {2, 6, 8, 9, None, 11}, "near": {2, 6, 8, None, 11}}
    for name, stage in corpus_pipeline.STAGES:
        docs = write(stage(spark, docs, SF_DIR), spark)
        assert name not in kept or {r.doc_id for r in docs.collect()} == kept[name], name
        if name != "encoded":
            assert docs.columns == [f.split()[0] for f in EXTRA.split(", ")]
        if name in ("exact", "near"):
            assert docs.count() == len(kept[name])
    assert {"n_tokens", "ids", "decoded_sha256"} <= set(docs.columns) and "text" not in docs.columns
    assert {r.doc_id for r in docs.collect()} == kept["near"]


def test_language_stage_keeps_languages_of_many_letters(spark):
    rng = random.Random(4)
    text = lambda first, letters: "".join(chr(first + rng.randrange(letters)) for _ in range(1500))
    rows = [(i, text(*part), lang) for i in range(60) for part, lang in [[((97, 26), "en"), ((0x4E00, 2500), "zh"), ((0xAC00, 2000), "ko")][i % 3]]]
    docs = spark.createDataFrame(rows + [(99, text(0x3041, 80), None)], "doc_id long, text string, lang string")
    assert {r.doc_id for r in corpus_pipeline.language(spark, docs, SF_DIR).collect()} == set(range(60))


def test_near_stage_judges_each_text_of_an_id(spark):
    long = lambda name: " ".join(f"{name}{i}" for i in range(60))
    rows = [(1, "a b c d"), (2, "a b c d"), (2, "p q r s"), (3, "p q r s"), (4, "u v"), (4, "w x"),  # one shingle each
            (11, long("n")), (12, long("n") + " more"), (12, long("alone")), (12, long("m")), (13, long("m") + " more"),
            (None, long("n")), (12, None)]
    docs = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id long, text string, digest int")
    got = corpus_pipeline.near(spark, docs, SF_DIR)
    assert got.columns == docs.columns
    expected = [(1, "a b c d"), (2, "p q r s"), (4, "u v"), (4, "w x"), (11, long("n")), (12, long("alone")), (12, long("m")),
                (12, None), (None, long("n"))]
    assert sorted(map(str, [(r.doc_id, r.text) for r in got.collect()])) == sorted(map(str, expected))


def test_stages_on_an_empty_table(spark):
    docs = spark.createDataFrame([], EXTRA)
    for _, stage in corpus_pipeline.STAGES:
        docs = write(stage(spark, docs, SF_DIR), spark)
        assert docs.count() == 0


def test_pipeline_equals_brute_force(spark):
    from test_llm_duplicates import expected_components

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    texts = {r.doc_id: r.text for r in docs if any(map(str.isalpha, r.text or ""))}
    lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    last = {}
    for i in sorted(texts):
        last[lower(texts[i])] = i
    rest = [(i, texts[i]) for i in sorted(last.values())]
    kept = {i for i, (_, _, keep) in expected_components(rest, words=5).items() if keep}
    got = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id for r in got} == kept
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    public = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in got:
        ids = public.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids) == (len(ids), ",".join(map(str, ids)))
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert max(Counter(r.doc_id for r in got).values()) <= 2
