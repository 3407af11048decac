"""Language identification by cross-parsing.

A suffix automaton is built from labelled text of each language. A text is cut greedily into the longest
phrases that occur in that labelled text; the language whose text explains it in the fewest phrases, each
weighed by the logarithm of the size of its labelled text, wins.

Texts are compared as lower-case letters with one space for every run of other characters. Phrases end at
every ``BLOCK`` characters, for every language alike, so that all blocks of all texts are parsed in step.

Nulls, empty texts and texts without any letter get ``und`` and the score 0. Ties go to the language whose
name sorts first. Repeated rows are answered one by one; columns other than the text are never read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.arrays import slices
from starmart.llm.resident import hold, trim

UNKNOWN = "und"
#: Labelled rows taken of each language, characters taken of each of them, and characters kept of a language.
SAMPLE_ROWS, SAMPLE_ROW_CHARS, SAMPLE_CHARS = 64, 2048, 32768
#: Letters, the most frequent ones, whose transitions are a dense table; those of all others are looked up. Speed only.
LETTERS = 250
BLOCK = 2048
SLICE_BYTES = 1 << 20


@dataclass(frozen=True)
class LanguageModel:
    """Labelled text of each language, by name."""

    samples: tuple[tuple[str, str], ...]


def fit(docs: DataFrame, train: Column, *, text: str = "text", lang: str = "lang", id: str = "doc_id") -> LanguageModel:
    """Labelled text from a bounded sample of the rows for which ``train`` holds.

    Of each language it takes the row with the least hash of each of ``SAMPLE_ROWS`` classes of ids, so each
    task reduces its rows before the shuffle. Of several texts with one id and language it takes the least, so no id
    brings more than one row per language to the driver. Rows without id, text or language are not used.
    """
    seed = F.xxhash64(F.col(id).cast("string"))
    rows = docs.filter(train & F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}") & F.col(id).isNotNull())
    chosen = (
        rows.groupBy(F.col(lang).alias("lang"), F.pmod(seed, F.lit(SAMPLE_ROWS)).alias("slot"))
        .agg(F.min(seed).alias("seed"))
        .collect()
    )
    if not chosen:
        return LanguageModel(())
    wanted = sorted({r["seed"] for r in chosen})
    texts = (
        rows.filter(seed.isin(wanted))
        .groupBy(F.col(lang).alias("lang"), seed.alias("seed"))
        .agg(F.min(F.substring(text, 1, SAMPLE_ROW_CHARS)).alias("text"))
        .collect()
    )
    by_lang: dict[str, list[tuple[int, str]]] = {}
    for r in texts:
        by_lang.setdefault(r["lang"], []).append((r["seed"], r["text"]))
    return LanguageModel(
        tuple((name, " ".join(t for _, t in sorted(parts))[:SAMPLE_CHARS]) for name, parts in sorted(by_lang.items()))
    )


def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _automaton(symbols: list[int]) -> tuple[list[dict[int, int]], int]:
    """Transitions of the suffix automaton of a sequence; state 0 is its start."""
    out: list[dict[int, int]] = [{}]
    link, longest = [-1], [0]
    last = 0
    for symbol in symbols:
        new = len(out)
        out.append({})
        longest.append(longest[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and symbol not in out[at]:
            out[at][symbol] = new
            at = link[at]
        if at >= 0:
            target = out[at][symbol]
            if longest[target] == longest[at] + 1:
                link[new] = target
            else:
                copy = len(out)
                out.append(dict(out[target]))
                longest.append(longest[at] + 1)
                link.append(link[target])
                while at >= 0 and out[at].get(symbol) == target:
                    out[at][symbol] = copy
                    at = link[at]
                link[target] = link[new] = copy
        last = new
    return out, len(out)


class CrossParser:
    """The automata of all languages as one table, walked by many texts at once.

    An entry of the table holds the next row's offset times two, plus one if the symbol starts a new phrase. Every
    letter of the labelled text is a symbol of its own. Symbols from ``width`` on are the letters without a column:
    ``keys`` has their transitions, sorted by state and symbol, and ``starts`` the first ones of each language.
    """

    def __init__(self, model: LanguageModel):
        self.names = [name for name, _ in model.samples]
        letter = _letters()
        counts: dict[str, int] = {}
        for _, text in model.samples:
            for c in text.lower():
                if letter[ord(c)]:
                    counts[c] = counts.get(c, 0) + 1
        seen = sorted(counts, key=lambda c: (-counts[c], c))
        kept, rare = seen[:LETTERS], seen[LETTERS:]
        self.unknown = len(kept) + 1
        self.width = len(kept) + 2
        self.size = self.width + len(rare)
        self.symbol = np.where(letter, self.unknown, 0).astype(np.uint8 if self.size <= 2**8 else np.int32)
        for i, c in enumerate(kept):
            self.symbol[ord(c)] = i + 1
        for i, c in enumerate(rare):
            self.symbol[ord(c)] = self.width + i
        tables, roots, self.bits, base = [], [], [], 0
        starts, keys, targets = [], [], []
        for _, text in model.samples:
            symbols, _ = self._normalised([text])
            out, states = _automaton(symbols.tolist())
            start = np.full(self.size, base * self.width * 2 + 1, np.int64)
            for s, t in out[0].items():
                start[s] = (base + t) * self.width * 2 + 1
            table = np.tile(start[: self.width], (states, 1))
            for at in range(1, states):
                for s, t in out[at].items():
                    if s < self.width:
                        table[at, s] = (base + t) * self.width * 2
                    else:
                        keys.append((base + at) * self.size + s)
                        targets.append((base + t) * self.width * 2)
            table[:, self.unknown] = base * self.width * 2 + 1
            tables.append(table)
            starts.append(start[self.width :])
            roots.append(base * self.width * 2)
            self.bits.append(math.log2(len(symbols) + 2))
            base += states
        self.roots = np.array(roots, np.int64)
        kind = np.int32 if base * self.width * 2 < 2**31 - 2 * self.width else np.int64
        self.table = np.concatenate(tables).ravel().astype(kind) if tables else np.zeros(0, kind)
        order = np.argsort(np.array(keys, np.int64))
        # The last key is above all others, so that every search ends at one.
        self.keys = np.append(np.array(keys, np.int64)[order], np.iinfo(np.int64).max)
        self.targets = np.append(np.array(targets, kind)[order], kind(0))
        self.starts = np.array(starts, kind).reshape(len(starts), len(rare))

    def _moved(self, state: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The entries that texts in these states (by language and text) reach with one symbol each."""
        rare = np.flatnonzero(symbols >= self.width)
        if not len(rare):
            return self.table.take((state >> 1) + symbols)
        moved = self.table.take((state >> 1) + np.where(symbols < self.width, symbols, self.unknown))
        wanted = (state[:, rare] >> 1).astype(np.int64) // self.width * self.size + symbols[rare]
        at = np.searchsorted(self.keys, wanted)
        moved[:, rare] = np.where(self.keys[at] == wanted, self.targets[at], self.starts[:, symbols[rare] - self.width])
        return moved

    def _normalised(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all texts after one another, and where each text begins."""
        lowered = [t.lower() for t in texts]
        codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
        symbols = self.symbol[codes]
        bounds = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, lowered), np.int64, len(texts)), out=bounds[1:])
        keep = symbols != 0
        keep[1:] |= symbols[:-1] != 0
        begins = bounds[:-1][bounds[:-1] < bounds[1:]]
        keep[begins] = symbols[begins] != 0
        before = np.zeros(len(keep) + 1, np.int64)
        np.cumsum(keep, out=before[1:])
        return symbols[keep], before[bounds]

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases of each text (row) by each language (column), and the length of each normalised text."""
        symbols, bounds = self._normalised(texts)
        sizes = np.diff(bounds)
        blocks = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(texts)), blocks)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        begin = bounds[owner] + nth * BLOCK
        length = np.minimum(bounds[owner + 1] - begin, BLOCK)
        order = np.argsort(-length, kind="stable")
        owner, begin, length = owner[order], begin[order], length[order]
        found = np.zeros((len(texts), len(self.names)), np.int64)
        if not len(owner):
            return found, sizes
        steps = int(length[0])
        at = np.minimum(begin[None, :] + np.arange(steps)[:, None], len(symbols) - 1)
        lanes = symbols[at]
        del at
        active = np.searchsorted(-length, -np.arange(steps), side="left")
        state = np.repeat(self.roots[:, None], len(owner), axis=1).astype(self.table.dtype)
        count = np.zeros(state.shape, np.int32)
        for step in range(steps):
            n = active[step]
            moved = self._moved(state[:, :n], lanes[step, :n])
            count[:, :n] += moved & 1
            state[:, :n] = moved
        np.add.at(found, owner, count.T)
        return found, sizes

    def known_share(self, texts: list[str]) -> np.ndarray:
        """Share of each text's letters that the labelled text has; 0 without letters."""
        symbols, bounds = self._normalised(texts)
        unknown = np.concatenate([[0], np.cumsum(symbols == self.unknown)])
        letters = np.concatenate([[0], np.cumsum(symbols != 0)])
        of_text = letters[bounds[1:]] - letters[bounds[:-1]]
        return 1.0 - np.where(of_text > 0, unknown[bounds[1:]] - unknown[bounds[:-1]], 1) / np.maximum(of_text, 1)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """The language of each text and its score: the share of 2 ** -phrases that the language holds."""
        found, sizes = self.phrases(texts)
        if not self.names:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        weighed = found * np.array(self.bits)
        best = weighed.argmin(axis=1)
        behind = (weighed - weighed.min(axis=1, keepdims=True)) / max(self.bits)
        score = 1.0 / np.exp2(-behind).sum(axis=1)
        known = sizes > 1
        known[~known] = [bool(t) and any(map(str.isalpha, t)) for t in np.array(texts, object)[~known]]
        return [self.names[b] if k else UNKNOWN for b, k in zip(best, known)], np.where(known, score, 0.0)


def _parser(model: LanguageModel) -> CrossParser:
    """Built once in each Python worker."""
    return hold(("language_id", model), lambda: CrossParser(model))


def identify(model: LanguageModel) -> Callable[[Column], Column]:
    """A function from a text column to a struct of ``lang``, ``score`` and ``known``.

    ``known`` is the share of the text's letters that occur in the labelled text of any language.
    """

    @F.pandas_udf("lang string, score double, known double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        parser = _parser(model)
        for batch in batches:
            texts = ["" if t is None else t for t in batch]
            langs, scores, known = [], [np.zeros(0)], [np.zeros(0)]
            for a, b in slices(texts, SLICE_BYTES):
                lang, score = parser.predict(texts[a:b])
                langs += lang
                scores.append(score)
                known.append(parser.known_share(texts[a:b]))
            yield pd.DataFrame({"lang": langs, "score": np.concatenate(scores), "known": np.concatenate(known)})
        trim()

    return run
