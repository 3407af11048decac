"""What the two classifiers see, against plain loops over words, and how well they tell held-out rows apart."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest

from starmart.llm import quality, toxicity
from starmart.llm.queries import QUERIES

PIECES = [
    "the", "The", "THE", "a", "A", "Idiot", "idiot!", "(idiots)", "x1y2", "42", "...", "%%%", "*!*", "don't", "é", "Süßes",
    "\x7f", "#tag", "&amp;", "日本語", "longerwords", "longerword", "aB", "ABc", "-", "@", "a@b", "~a~",
]
GAPS = [" ", " ", " ", "\n", "\t", "  ", "\r\n", "\x0b", "\x0c ", " ", "\x00"]
PLAIN = b".,;:'\"-()?"


def some_texts(seed, count=120):
    random.seed(seed)
    texts = ["", " ", "\n\t", "a", "%", "THE THE", "x" * 5000, "A" * 300 + " " + "%" * 300]
    for _ in range(count):
        words = random.choices(PIECES, k=random.randrange(1, random.choice([3, 12, 260])))
        texts.append("".join(w + random.choice(GAPS) for w in words))
    random.shuffle(texts)
    return texts


def is_upper(b):
    return 0x41 <= b <= 0x5A


def is_symbol(b):
    return b > 0x20 and not (is_upper(b) or 0x61 <= b <= 0x7A or b >= 0x80 or 0x30 <= b <= 0x39 or b in PLAIN)


def brute_describe(text):
    words = re.findall(rb"[^\x20\x09-\x0d]+", text)
    n, some = len(words), max(len(words), 1)
    shown = sum(map(len, words))
    chars = max(shown, 1)
    share = lambda test: sum(map(bool, map(test, words))) / some
    of_bytes = lambda test: sum(map(test, b"".join(words))) / chars
    again = sum(a == b for a, b in zip(words, words[1:])) / some
    shares = [
        of_bytes(is_upper),
        of_bytes(is_symbol),
        of_bytes(lambda b: 0x30 <= b <= 0x39),
        of_bytes(lambda b: b in PLAIN),
        again,
        share(lambda w: any(map(is_symbol, w))),
        share(lambda w: all(map(is_symbol, w))),
        share(lambda w: len(w) > 1 and 2 * sum(map(is_upper, w)) >= len(w)),
        min(some, 200) / 200 * (1 - len(set(words)) / some) if n else 0.0,
        min(shown / some, 20) / 20,
    ]
    there = [min(shares[i], 0.1) * 10 for i in (0, 1, 4, 5, 6, 7)]
    return [*shares, *there, math.log1p(n) / 10, min(n, 8) / 8]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_description_equals_brute_force(seed):
    texts = [t.encode() for t in some_texts(seed)]
    assert np.allclose(quality.describe(texts), [brute_describe(t) for t in texts])


def brute_marks(text):
    marks = set()
    for word in re.findall(rb"[^\x20\x09-\x0d]+", text.lower().encode()):
        inner = re.sub(rb"^[^0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff]+$", b"", word)
        if inner:
            marks.add((inner, 0))
            marks |= {(inner[:size], size) for size in toxicity.PREFIXES if len(inner) > size}
    return marks


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_marks_equal_brute_force(seed):
    """Hashes stand for marks one to one: each text has as many, and each two texts share as many."""
    texts = some_texts(seed, 60)
    owner, found = toxicity.marks_of(texts)
    hashes = [set(found[owner == i].tolist()) for i in range(len(texts))]
    marks = [brute_marks(t) for t in texts]
    assert len(found) == sum(map(len, marks))
    for i in range(len(texts)):
        for j in range(i, len(texts)):
            assert len(hashes[i] & hashes[j]) == len(marks[i] & marks[j])


def area_under_curve(scores, labels):
    """The share of pairs of a positive and a negative row in which the positive has the higher score, ties by half."""
    wins = [(p > n) + 0.5 * (p == n) for p, x in zip(scores, labels) if x for n, y in zip(scores, labels) if not y]
    return sum(wins) / len(wins)


@pytest.mark.parametrize(
    "name, label, positive, recall, precision, area",
    [("op7_quality", "quality", 1, 0.95, 0.95, 0.95), ("op10_toxicity", "toxic", 1, 0.8, 0.9, 0.92)],
)
def test_held_out_rows_by_recall(spark, name, label, positive, recall, precision, area):
    """Figures that a classifier of one answer for all rows can't reach."""
    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = QUERIES[name](spark, sf_dir).join(labels, "doc_id").filter(f"held_out AND {label} IS NOT NULL")
    rows = rows.select("score", "predicted", label).collect()
    true = [r for r in rows if r[label] == positive]
    hit = [r for r in true if r.predicted == positive]
    said = [r for r in rows if r.predicted == positive]
    assert 0 < len(true) < len(rows)
    assert len(hit) >= recall * len(true) and len(hit) >= precision * len(said)
    assert area_under_curve([r.score for r in rows], [r[label] == positive for r in rows]) >= area
