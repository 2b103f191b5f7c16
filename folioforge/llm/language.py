"""Language identification with hyperdimensional profiles.

Every letter has a fixed random vector of plus and minus ones. The vectors of three neighbouring letters,
permuted by their place, are multiplied into the vector of a letter triple; a text is the sum of its triples.
A language's prototype is the sum of its learning texts, each scaled by its number of triples. A text gets the
language whose prototype has the largest cosine with it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Length of the vectors, and number of letter slots; slot 0 is the gap between words.
WIDTH, SLOTS = 1024, 1024
#: Characters that are worked on at once.
CHUNK = 400_000
UNKNOWN = "und"

_LETTERS = (np.random.default_rng(20240611).integers(0, 2, (SLOTS, WIDTH)) * 2 - 1).astype(np.int8)


@cache
def _slots() -> np.ndarray:
    """Slot of every code point: letters by their lower case, spread over the slots; all else is a gap."""
    table = np.zeros(0x110000, np.int32)
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha():
            table[point] = ord(c.lower()[0]) % (SLOTS - 1) + 1
    return table


def _triples(texts: list[str], slots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place of the text, triple and count, for each distinct triple of each text."""
    parts = []
    for text in texts:
        points = np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), np.uint32)
        s = slots[points]
        s = s[np.concatenate(([True], (s[1:] != 0) | (s[:-1] != 0)))]  # one gap for a run of them
        parts.append((s[:-2] * SLOTS + s[1:-1]).astype(np.int64) * SLOTS + s[2:])
    sizes = [len(p) for p in parts]
    owner = np.repeat(np.arange(len(parts), dtype=np.int64), sizes)
    both, counts = np.unique((owner << 30) | np.concatenate(parts), return_counts=True)
    return both >> 30, both & ((1 << 30) - 1), counts


def _vectors(triples: np.ndarray) -> np.ndarray:
    a, b, c = triples // (SLOTS * SLOTS), triples // SLOTS % SLOTS, triples % SLOTS
    return np.roll(_LETTERS, 2, axis=1)[a] * np.roll(_LETTERS, 1, axis=1)[b] * _LETTERS[c]


def _profiles(texts: list[str], slots: np.ndarray) -> np.ndarray:
    """One vector per text, zero where it has no letter."""
    place, triple, count = _triples(texts, slots)
    out = np.zeros((len(texts), WIDTH), np.float32)
    known, column = np.unique(triple, return_inverse=True)
    for first in range(0, len(known), 8192):
        here = (column >= first) & (column < first + 8192)
        grid = np.zeros((len(texts), min(8192, len(known) - first)), np.float32)
        grid[place[here], column[here] - first] = count[here]
        out += grid @ _vectors(known[first : first + 8192]).astype(np.float32)
    return out


def _chunks(texts: list[str]) -> Iterator[slice]:
    first, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > CHUNK:
            yield slice(first, i)
            first, size = i, 0
        size += len(text) + 2
    if texts:
        yield slice(first, len(texts))


def _has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def prototypes(labelled: DataFrame, text: str = "text", label: str = "lang") -> dict[str, np.ndarray]:
    """Unit prototype of each label, learned from all rows with a label.

    Each task gives one vector per label, so what is brought together are (tasks x labels) vectors, summed
    before they reach the driver, which gets one per label. Null texts, and texts without a letter, add
    nothing; a label with no other text has no prototype.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slots, sums = _slots(), {}
        for batch in batches:
            for name, rows in batch.dropna().groupby("label"):
                texts = [t for t in rows["text"] if _has_letter(t)]
                for part in _chunks(texts):
                    place, triple, count = _triples(texts[part], slots)
                    share = count / np.bincount(place, weights=count)[place]
                    known, column = np.unique(triple, return_inverse=True)
                    weight = np.bincount(column, weights=share).astype(np.float32)
                    for first in range(0, len(known), 8192):
                        piece = slice(first, first + 8192)
                        vector = weight[piece] @ _vectors(known[piece]).astype(np.float32)
                        sums[name] = sums.get(name, 0) + vector.astype(np.float64)
        if sums:
            at = np.tile(np.arange(WIDTH, dtype=np.int32), len(sums))
            names = np.repeat(np.array(list(sums), dtype=object), WIDTH)
            yield pd.DataFrame({"label": names, "at": at, "value": np.concatenate(list(sums.values()))})

    given = labelled.filter(F.col(label).isNotNull()).select(F.col(label).alias("label"), F.col(text).alias("text"))
    summed = given.mapInPandas(run, "label string, at int, value double").groupBy("label", "at").agg(F.sum("value").alias("value"))
    found: dict[str, np.ndarray] = {}
    for row in summed.collect():
        found.setdefault(row["label"], np.zeros(WIDTH))[row["at"]] = row["value"]
    return {name: v / np.linalg.norm(v) for name, v in sorted(found.items()) if np.linalg.norm(v) > 0}


RESULT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def predictor(learned: dict[str, np.ndarray]):
    """A column function: text to (lang_pred, score), the cosine with the language's prototype, 0 at least.

    Null texts, and texts without a letter, are ``und`` with score 0, and so are all if nothing was learned.
    Equal cosines go to the label that comes first in order.
    """
    names = list(learned)
    matrix = np.array([learned[n] for n in names], np.float32).reshape(len(names), WIDTH)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        slots = _slots()
        for batch in batches:
            texts = ["" if t is None else t for t in batch]
            known = np.array([_has_letter(t) for t in texts], bool)
            pred, score = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
            for part in _chunks(texts) if names else ():
                vectors = _profiles(texts[part], slots)
                norms = np.linalg.norm(vectors, axis=1)
                cosine = (vectors @ matrix.T) / np.maximum(norms, 1e-9)[:, None]
                best = cosine.argmax(axis=1)
                at = np.flatnonzero(known[part] & (norms > 0))
                pred[part.start + at] = np.array(names, object)[best[at]]
                score[part.start + at] = np.clip(cosine[at, best[at]], 0.0, 1.0)
            yield pd.DataFrame({"lang_pred": pred, "score": score})

    # the kind of the function is read from its hints, which are text in this module
    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, RESULT)
