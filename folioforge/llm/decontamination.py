"""Benchmark items in documents, allowing edits.

Words are symbols. A random walk reads a window of an item's size and repeats or skips symbols by random bits
of (step, symbol); two windows a few edits apart give walks that agree in most steps (the CGK embedding: edit
distance becomes Hamming distance). Each repetition draws a walk and samples a few of its steps; windows that
agree with an item there are candidates, which are compared by exact edit distance. The number of
repetitions is set so that, at each length, an item with the largest allowed number of edits is found with the
target probability; an unedited item always is.

Long items are cut into pieces of ``PIECE`` to ``2 * PIECE - 1`` words, and the pieces are walked: if an item has at
most its share of edits, so has one of its pieces. Whole items are compared around each piece that is found. Items so
short that no edit is allowed are found exactly, by hashes of windows of their length and then word by word.

Windows start at every word. Before they are walked, those that cannot hold an item are left out: a window
within ``d`` edits of an item of ``n`` words has at least ``n - d`` words of the items' vocabulary.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Allowed edits as a share of an item's words.
EDITS = 0.15
TARGET_RECALL, SAMPLES, MOST_REPEATS = 0.95, 3, 64
#: Items of twice as many words or more are searched by pieces.
PIECE = 32
#: Trial edits for each length of an item or piece.
TRIALS = 200
#: Words that are walked at once.
CHUNK = 200_000
#: Bytes of items that are sent to the tasks at once; larger benchmarks are searched in blocks.
BLOCK_BYTES = 8 << 20

_WORD = re.compile(r"\w+")
RESULT = "array<struct<item_id: long, edits: int, item_words: int, end_word: int>>"


def _symbol(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), seed=5) | 1


def tokens(text: str | None) -> list[str]:
    """Lower-case words of letters, digits and underscores."""
    return _WORD.findall((text or "").lower())


def allowed(n: int) -> int:
    return math.floor(EDITS * n)


def best_alignment(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least edit distance of ``item`` to any part of ``text``, and where the first such part ends."""
    steps = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for i, word in enumerate(item):
        new = np.empty_like(row)
        new[0] = i + 1
        new[1:] = np.minimum(row[:-1] + (text != word), row[1:] + 1)
        row = np.minimum.accumulate(new - steps) + steps
    end = int(row.argmin())
    return int(row[end]), end


class Index:
    """Sampled walks of a block of items."""

    def __init__(self, items: list[tuple[int, str]]):
        self.other, self.pad = _symbol("\x00other"), _symbol("\x00end")
        known = [(i, tokens(t)) for i, t in items]
        known = [(i, w) for i, w in known if w]
        self.symbols = {w: _symbol(w) for _, ws in known for w in ws}
        self.items = [(i, np.array([self.symbols[w] for w in ws], np.uint64)) for i, ws in known]
        # (item, place of the piece in it, words of the piece)
        self.pieces = []
        for k, (_, words) in enumerate(self.items):
            if allowed(len(words)) > 0:
                n = max(1, len(words) // PIECE)
                cuts = [len(words) * c // n for c in range(n + 1)]
                self.pieces += [(k, a, words[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
        draw = np.random.default_rng(20240613)
        self.longest = max((len(w) for _, _, w in self.pieces), default=0)
        steps = 2 * self.longest + 1
        self.walks = draw.integers(0, 1 << 63, (MOST_REPEATS, steps), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.classes = []
        order = sorted(range(len(self.pieces)), key=lambda k: len(self.pieces[k][2]))
        while order:
            low = len(self.pieces[order[0]][2])
            group = [k for k in order if len(self.pieces[k][2]) <= low + max(3, low // 4)]
            order = order[len(group) :]
            self.classes.append(self._class(low, group, draw))
        self.short = []
        for n in sorted({len(w) for _, w in self.items if allowed(len(w)) == 0}):
            own = np.array([k for k, (_, w) in enumerate(self.items) if len(w) == n])
            words = np.stack([self.items[k][1] for k in own])
            keys = self._window_keys(words.reshape(-1), n)[::n]
            by = np.argsort(keys, kind="stable")
            self.short.append((n, keys[by], own[by], words[by]))

    @staticmethod
    def _window_keys(symbols: np.ndarray, n: int) -> np.ndarray:
        """A hash of the ``n`` symbols from each place on."""
        key = np.zeros(len(symbols) - n + 1, np.uint64)
        for i in range(n):
            key = (key + symbols[i : i + len(key)]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(31)
        return key

    def _class(self, low: int, group: list[int], draw) -> dict:
        span = max(SAMPLES, low * 3 // 2)
        samples = np.array([np.sort(draw.choice(span, SAMPLES, replace=False)) for _ in range(MOST_REPEATS)])
        sizes = [len(self.pieces[k][2]) for k in group]
        most = max(sizes)
        own = {"low": low, "most": most, "edits": allowed(most), "samples": samples}
        starts, flat = self._flat([self.pieces[k][2] for k in group])
        keys = [self._keys(flat, starts, r, samples[r]) for r in range(MOST_REPEATS)]
        # trial edits of the items themselves give the chance that one repetition finds one; it depends on the length
        edited, of = [], []
        for at_group, k in enumerate(group):
            word = self.pieces[k][2]
            for _ in range(math.ceil(TRIALS / sizes.count(len(word)))):
                copy = list(word)
                for _ in range(allowed(len(word))):
                    at, kind = int(draw.integers(0, len(copy))), draw.integers(0, 3)
                    copy[at : at + (kind != 0)] = [] if kind == 1 else [self.other]
                edited.append(np.array(copy, np.uint64))
                of.append(at_group)
        places, text = self._flat(edited)
        of = np.array(of)
        hit = np.zeros(len(edited), bool)
        length = np.array(sizes)[of]
        trials = np.maximum(np.bincount(length), 1)
        own["repeats"] = MOST_REPEATS
        for r in range(MOST_REPEATS):
            hit |= self._keys(text, places, r, samples[r]) == keys[r][of]
            if (np.bincount(length[~hit], minlength=most + 1) <= (1 - TARGET_RECALL) * trials).all():
                own["repeats"] = r + 1
                break
        own["sorted"] = []
        for r in range(own["repeats"]):
            by = np.argsort(keys[r], kind="stable")
            own["sorted"].append((keys[r][by], np.array(group)[by]))
        return own

    def _flat(self, parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Parts one after another, each followed by padding, and their starts."""
        gap = np.full(2 * self.longest + math.ceil(1 / EDITS), self.pad, np.uint64)
        sizes = np.array([len(p) + len(gap) for p in parts])
        return np.concatenate(([0], np.cumsum(sizes)[:-1])), np.concatenate([x for p in parts for x in (p, gap)])

    def _keys(self, symbols: np.ndarray, starts: np.ndarray, repeat: int, samples: np.ndarray) -> np.ndarray:
        """The sampled steps of the walk from each start, as one number."""
        at, key, taken = starts.copy(), np.zeros(len(starts), np.uint64), 0
        for step in range(int(samples[-1]) + 1):
            here = symbols[at]
            if step == samples[taken]:
                key = (key ^ here) * np.uint64(0x9E3779B97F4A7C15)
                key ^= key >> np.uint64(29)
                taken += 1
                if taken == len(samples):
                    break
            at += ((here * self.walks[repeat, step]) >> np.uint64(63)).astype(np.int64)
        return key

    def candidates(self, symbols: np.ndarray, group: dict) -> tuple[np.ndarray, np.ndarray]:
        """Pieces and starts of windows of ``symbols`` that agree with a piece in a repetition."""
        low = group["low"]
        need = low - group["edits"]
        seen = np.concatenate(([0], np.cumsum((symbols != self.other) & (symbols != self.pad))))
        starts = np.arange(len(symbols) - 2 * self.longest)
        starts = starts[seen[starts + low] - seen[starts] >= need]
        items, places = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for repeat, (keys, owners) in enumerate(group["sorted"]):
            own = self._keys(symbols, starts, repeat, group["samples"][repeat])
            first, last = np.searchsorted(keys, own, "left"), np.searchsorted(keys, own, "right")
            while (hit := first < last).any():  # items with equal keys
                items.append(owners[first[hit]])
                places.append(starts[hit])
                first = first + 1
        pairs = np.unique(np.stack((np.concatenate(items), np.concatenate(places))), axis=1)
        return pairs[0], pairs[1]

    def leaks(self, texts: list[str | None]) -> list[list[tuple[int, int, int, int]]]:
        """Per text (item_id, edits, words of the item, word after its end) for each item in it, best place."""
        found: list[list] = [[] for _ in texts]
        first = 0
        while first < len(texts) and self.items:
            last, size, parts = first, 0, []
            while last < len(texts) and (last == first or size < CHUNK):
                names = tokens(texts[last])
                parts.append(np.fromiter((self.symbols.get(w, self.other) for w in names), np.uint64, len(names)))
                size += len(names)
                last += 1
            for place, leak in self._in_parts(parts):
                found[first + place].append(leak)
            first = last
        return found

    def _in_parts(self, parts: list[np.ndarray]) -> Iterator[tuple[int, tuple[int, int, int, int]]]:
        offsets, flat = self._flat(parts)
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for group in self.classes:
            items, starts = self.candidates(flat, group)
            owners = np.searchsorted(offsets, starts, "right") - 1
            near: dict[tuple[int, int], list[int]] = {}
            for piece, start, owner in zip(items.tolist(), starts.tolist(), owners.tolist(), strict=True):
                item, before, _ = self.pieces[piece]
                near.setdefault((owner, item), []).append(start - int(offsets[owner]) - before)
            for (owner, item), at in near.items():
                self._compare(parts[owner], item, sorted(at), best, (owner, item))
        for n, keys, owned, words in self.short:
            own = self._window_keys(flat, n)
            first, last = np.searchsorted(keys, own, "left"), np.searchsorted(keys, own, "right")
            while (hit := first < last).any():  # items with equal keys
                at, which = np.flatnonzero(hit), first[hit]
                same = (flat[at[:, None] + np.arange(n)] == words[which]).all(axis=1)
                at, which = at[same], owned[which[same]]
                owners = np.searchsorted(offsets, at, "right") - 1
                _, earliest = np.unique(np.stack((owners, which)), axis=1, return_index=True)
                for k in earliest.tolist():
                    owner = int(owners[k])
                    found = (0, int(at[k]) - int(offsets[owner]) + n)
                    best[owner, int(which[k])] = min(best.get((owner, int(which[k])), found), found)
                first = first + 1
        for (owner, item), (edits, end) in sorted(best.items()):
            yield owner, (self.items[item][0], edits, len(self.items[item][1]), end)

    def _compare(self, symbols: np.ndarray, item: int, starts: list[int], best: dict, name: tuple[int, int]) -> None:
        word = self.items[item][1]
        slack = allowed(len(word))
        while starts:
            # windows that overlap are compared in one go; a start can lie before the text
            size = next((i for i in range(1, len(starts)) if starts[i] > starts[i - 1] + len(word)), len(starts))
            first, last = max(0, starts[0] - slack), starts[size - 1] + len(word) + slack
            part = symbols[first:last]
            starts = starts[size:]
            if np.isin(part, word).sum() >= len(word) - slack:
                edits, end = best_alignment(word, part)
                if edits <= slack:
                    best[name] = min(best.get(name, (edits, first + end)), (edits, first + end))


def _finder(items: list[tuple[int, str]]):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = Index(items)
        for batch in batches:
            yield pd.Series([[dict(zip(NAMES, x, strict=True)) for x in found] for found in index.leaks(list(batch))])

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, RESULT)


NAMES = ("item_id", "edits", "item_words", "end_word")


def leaks_in(text: Column, benchmark: DataFrame, item: str = "item_id", words: str = "text") -> list[Column]:
    """For each block of the benchmark a column with the items found in ``text``.

    Null and empty texts, and texts without a word, hold nothing. Items without id, text or
    word are not searched; equal items are each reported, repeated rows of the benchmark once each. An empty benchmark has no
    block.
    """
    given = benchmark.filter(F.col(item).isNotNull() & F.col(words).isNotNull())
    total = given.agg(F.sum(F.octet_length(words)).alias("b")).first()["b"] or 0
    blocks = math.ceil(total / BLOCK_BYTES)
    place = F.pmod(F.xxhash64(item, words), F.lit(max(blocks, 1)))
    columns = []
    for block in range(blocks):
        # about BLOCK_BYTES of text
        rows = given.filter(place == block).select(item, words).orderBy(item, words).collect()
        columns.append(_finder([(r[0], r[1]) for r in rows])(text))
    return columns


def find_leaks(df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, item_id, edits, item_words, end_word): each item in each row of ``df``, at its best place."""
    own = df.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    columns = leaks_in(F.col("text"), benchmark) or [F.array().cast(RESULT)]
    found = own.select("doc_id", F.explode(F.concat(*columns)).alias("leak"))
    return found.select("doc_id", "leak.*")


def drop_leaking(df: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``df`` whose text holds no item of the benchmark.

    Rows with a null or empty text stay, repeated rows stay or go together, and an empty benchmark drops nothing.
    """
    for column in leaks_in(F.col(f"`{text}`"), benchmark):
        df = df.filter(F.size(column) == 0)
    return df
