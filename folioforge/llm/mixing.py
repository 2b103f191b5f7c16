"""Sampling rates that mix documents to target token totals per domain, with soft domain membership.

A naive Bayes classifier on words, learned from a labelled table, gives every document a posterior over the
domains. Rates are the nonnegative least squares solution of: expected tokens per domain (rate x tokens x
posterior, summed over documents) = target. Documents whose posteriors round to the same cell of a grid with steps
of 1/32 have one rate, and Spark sums their unrounded posteriors once, so totals are exact. Projected gradient steps
over these at most 561 cells, each domain scaled by its own mass, run until no rate moves.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import boxed, of, unboxed, words
from folioforge.session import materialize

DOMAINS = ("clean", "noisy", "toxic")
#: Labelled documents that the classifier learns from, in expectation.
SAMPLE = 20_000
#: Least evidence for a word: twice the log likelihood ratio of its counts.
LEAST_EVIDENCE = 30.0
#: Steps of the grid, and the move of a rate at which the fit has ended.
GRID, CLOSE = 32, 1e-9

#: Parts of a lower-case text: split at blanks and marks, and between letters and signs that follow.
_PARTS = r"[\x20\x09-\x0D.,;:!?]+|(?<=\p{L})(?=[^\p{L}\x20\x09-\x0D.,;:!?])"


def features_of(text: Column) -> Column:
    """64-bit hashes of the distinct words of a text."""
    found = F.split(F.lower(F.coalesce(text, F.lit(""))), _PARTS)
    return F.array_distinct(F.transform(found, lambda w: F.xxhash64(w)))


class Weights:
    """Log priors of the domains, and log weights of the words with evidence in a table where each has one of two slots.

    As an array column it gives a word's weight by its hash alone, so documents meet no join and stay one row each.
    """

    def __init__(self, prior: list[float], words: dict[int, tuple[float, ...]]):
        self.prior, self.size = prior, 8
        while not self._placed(words):
            self.size *= 2

    def _slots(self, word: int) -> tuple[int, int]:
        return word & (self.size - 1), (word >> 32) & (self.size - 1)

    def _placed(self, words: dict[int, tuple[float, ...]]) -> bool:
        """Each word in one of its slots; a word that finds both taken drives one out, which moves to its other slot."""
        if self.size < 4 * len(words):
            return False
        held: list[int | None] = [None] * self.size
        for word in sorted(words):
            slot = self._slots(word)[0]
            for _ in range(self.size):
                word, held[slot] = held[slot], word
                if word is None:
                    break
                one, other = self._slots(word)
                slot = other if slot == one else one
            else:
                return False
        none = (0.0,) * len(DOMAINS)
        self.words = [0 if w is None else w for w in held]
        self.table = [[words[w][d] if w is not None else none[d] for w in held] for d in range(len(DOMAINS))]
        return True

    def slots_of(self, features: Column) -> Column:
        """Places in the table of those hashes that it holds."""
        known, low = _constant(self.words, "bigint"), F.lit(self.size - 1).cast("long")

        def place(h: Column) -> Column:
            one, other = (x.bitwiseAND(low).cast("int") for x in (h, F.shiftright(h, 32)))
            return F.when(F.get(known, one) == h, one).when(F.get(known, other) == h, other)

        return F.array_compact(F.transform(features, place))

    def score(self, slots: Column, domain: int) -> Column:
        weights = _constant(self.table[domain], "double")
        return F.aggregate(slots, F.lit(self.prior[domain]), lambda total, x: total + F.get(weights, x))


def _constant(values: list, kind: str) -> Column:
    """An array column of constants, folded to one literal when the plan is made."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")


def domain_of(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, domain) of labels with quality and toxic flags, one row per key; rows without key or flags are left out.

    A key with different labels counts as toxic if one of them says so, else as noisy if one does.
    """
    known = labels.filter(F.col(key).isNotNull() & F.col("toxic").isNotNull() & F.col("quality").isNotNull())
    flags = known.groupBy(F.col(key).alias("_label_of")).agg(F.max(F.col("toxic") == 1).alias("bad"), F.min(F.col("quality") == 1).alias("good"))
    return flags.select("_label_of", F.when(F.col("bad"), "toxic").when(F.col("good"), "clean").otherwise("noisy").alias("domain"))


def _sampled(df: DataFrame, labelled: DataFrame, key: str, text: str) -> DataFrame:
    """(_key, _text, domain) of about ``SAMPLE`` labelled documents."""
    total = labelled.count()
    parts = 1 << 30
    taken = labelled.filter(F.pmod(F.xxhash64(F.lit("mix"), "_label_of"), F.lit(parts)) < min(1.0, SAMPLE / max(total, 1)) * parts)
    # about SAMPLE rows of a key and a domain
    rows = df.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"))
    return rows.join(F.broadcast(taken), F.col("_key") == F.col("_label_of")).drop("_label_of")


def learn(df: DataFrame, labelled: DataFrame, key: str = "doc_id", text: str = "text") -> Weights:
    """Weights of all words with evidence for or against a domain, from about ``SAMPLE`` labelled documents.

    The documents are chosen by a hash of the key, so by no order of the data; they bound the number of words.
    """
    rows = _sampled(df, labelled, key, text).select("domain", features_of(F.col("_text")).alias("features"))
    rows = materialize(rows, "learned")
    # three rows at most
    sizes = {d: 0 for d in DOMAINS} | {r["domain"]: r["count"] for r in rows.groupBy("domain").count().collect()}
    size = sum(sizes.values())
    counts = [F.count(F.when(F.col("domain") == d, 1)).alias(f"n_{d}") for d in DOMAINS]
    found = rows.select("domain", F.explode("features").alias("word")).groupBy("word").agg(*counts)

    def rate(d: str) -> Column:
        return (F.col(f"n_{d}") + 0.5) / F.lit(sizes[d] + 1.0)

    seen = reduce(lambda a, b: a + b, [F.col(f"n_{d}") for d in DOMAINS])
    evidence = F.lit(0.0)
    for d in DOMAINS:
        for part, whole in ((F.col(f"n_{d}"), seen), (F.lit(sizes[d]) - F.col(f"n_{d}"), F.lit(size) - seen)):
            expected = whole * F.lit(sizes[d] / max(size, 1))
            evidence = evidence + F.when((part > 0) & (expected > 0), 2 * part * F.log(part / expected)).otherwise(0.0)
    # hash 0 stands for an empty slot
    kept = found.filter((evidence >= LEAST_EVIDENCE) & (F.col("word") != 0)).select("word", *[F.log(rate(d)) for d in DOMAINS])
    prior = [math.log((sizes[d] + 1.0) / (size + len(DOMAINS))) for d in DOMAINS]
    # words of the sample
    return Weights(prior, {word: tuple(weights) for word, *weights in kept.collect()})


def posteriors(df: DataFrame, weights: Weights, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, tokens, copies, one posterior per domain) per distinct key and text; one row per document throughout."""
    docs = df.select(
        row_of(key, text).alias("row"),
        F.size(words(F.col(f"`{text}`"))).cast("long").alias("tokens"),
        weights.slots_of(features_of(F.col(f"`{text}`"))).alias("slots"),
    )
    scored = docs.select("row", "tokens", *[weights.score(F.col("slots"), i).alias(f"w_{d}") for i, d in enumerate(DOMAINS)])
    sums = scored.groupBy("row").agg(
        F.min("tokens").alias("tokens"), F.count(F.lit(1)).alias("copies"), *[F.min(f"w_{d}").alias(f"w_{d}") for d in DOMAINS]
    )
    top = F.greatest(*[F.col(f"w_{d}") for d in DOMAINS])
    parts = {d: F.exp(F.col(f"w_{d}") - top) for d in DOMAINS}
    whole = reduce(lambda a, b: a + b, parts.values())
    return sums.select("row", "tokens", "copies", *[(parts[d] / whole).alias(f"p_{d}") for d in DOMAINS])


def cell_of() -> Column:
    """Number of the cell of the grid, steps of 1/32, that a document's posterior is nearest to."""
    toxic = F.round(F.col(f"p_{DOMAINS[2]}") * GRID)
    noisy = F.least(F.round(F.col(f"p_{DOMAINS[1]}") * GRID), GRID - toxic)
    return (noisy * (GRID + 1) + toxic).cast("int")


def calibrated(scored: DataFrame, df: DataFrame, labelled: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``scored`` with each posterior averaged with the labels of the labelled documents in its cell.

    The classifier counts only for the words that a text has, so a text without any keeps the priors, and it takes
    words for independent. The labels of a cell correct both; the classifier's own posterior weighs as much as one
    labelled document. A cell without labelled documents keeps it.
    """
    # about SAMPLE rows of a hash and a domain
    known = _sampled(df, labelled, key, text).select(row_of("_key", "_text").alias("row"), "domain").distinct()
    counts = [F.coalesce(F.sum(F.when(F.col("domain") == d, F.col("copies"))), F.lit(0)).alias(f"n_{d}") for d in DOMAINS]
    # at most 561 rows
    counted = scored.join(F.broadcast(known), "row").groupBy(cell_of().alias("_cell")).agg(*counts)
    joined = scored.withColumn("_cell", cell_of()).join(F.broadcast(counted), "_cell", "left")
    seen = {d: F.coalesce(F.col(f"n_{d}"), F.lit(0)) for d in DOMAINS}
    size = reduce(lambda a, b: a + b, seen.values()) + 1
    return joined.select("row", "tokens", "copies", *[((seen[d] + F.col(f"p_{d}")) / size).alias(f"p_{d}") for d in DOMAINS])


def row_of(key: str, text: str) -> Column:
    return F.xxhash64(F.col(f"`{key}`"), F.col(f"`{text}`"))


def solve(posterior: np.ndarray, mass: np.ndarray, goal: np.ndarray, start: float, most: float | None) -> np.ndarray:
    """Rate per cell, from the cells' mean posteriors and their mass per domain.

    Steps are accelerated; where one would lead uphill, the acceleration starts anew.
    """
    whole = mass.sum(axis=0)
    scale = np.divide(1.0, whole, out=np.zeros_like(whole), where=whole > 0)
    most = np.inf if most is None else most
    rate = ahead = np.full(len(posterior), min(start, most))
    moved, speed = 1.0, 1.0
    while moved > CLOSE:
        new = np.clip(ahead - posterior @ ((ahead @ mass - goal) * scale), 0.0, most)
        if (ahead - new) @ (mass.sum(axis=1) * (new - rate)) > 0 and speed > 1.0:
            ahead, speed = rate, 1.0
            continue
        moved = float(np.abs(new - rate).max(initial=0.0))
        after = (1.0 + (1.0 + 4.0 * speed * speed) ** 0.5) / 2.0
        rate, ahead, speed = new, new + (speed - 1.0) / after * (new - rate), after
    return rate


def fit(scored: DataFrame, weights: dict[str, float] | None, budget: float, shares: dict[str, float] | None = None, most: float | None = None) -> Column:
    """The rate column for rows of ``scored`` (tokens, copies, posteriors).

    Targets are ``weights`` of ``budget`` x all tokens, or ``shares`` of each domain's own expected tokens. At most
    (32 + 2 choose 2) cells reach the driver. A domain that no document belongs to moves no rate, as none can reach
    its target.
    """
    tokens = F.col("tokens") * F.col("copies")
    sums = [F.sum(tokens * F.col(f"p_{d}")).cast("double").alias(d) for d in DOMAINS]
    cells = sorted(tuple(r) for r in scored.groupBy(cell_of().alias("cell")).agg(*sums).filter("cell IS NOT NULL").collect())
    index = np.array([c[0] for c in cells], np.int64)
    mass = np.array([c[1:] for c in cells], np.float64).reshape(-1, len(DOMAINS))
    noisy, toxic = index // (GRID + 1) / GRID, index % (GRID + 1) / GRID
    size = mass.sum(axis=1, keepdims=True)
    # without tokens: the middle of the cell
    posterior = np.where(size > 0, mass / np.where(size > 0, size, 1.0), np.stack((1.0 - noisy - toxic, noisy, toxic), axis=1))
    own, everything = mass.sum(axis=0), float(mass.sum())
    if shares is not None:
        goal = np.array([shares[d] for d in DOMAINS]) * own
    else:
        goal = np.array([weights[d] for d in DOMAINS]) * budget * everything
    start = float(goal.sum()) / everything if everything else 0.0
    rates = np.zeros((GRID + 1) ** 2)
    rates[index] = solve(posterior, mass, goal, start, most)
    return F.array(*[F.lit(float(x)) for x in rates])[cell_of()]


def mix(
    df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", weights: dict[str, float] | None = None,
    budget: float = 0.5, shares: dict[str, float] | None = None, most: float | None = None,
) -> DataFrame:
    """(row, tokens, posteriors, rate) per distinct key and text of ``df``.

    A null text has no tokens and the posterior of the priors. Rows equal in key and text get one rate, and
    each counts in the totals. Without labels all posteriors are equal. An empty table gives no rows.
    """
    known = domain_of(labels)
    scored = materialize(posteriors(df, learn(df, known, key, text), key, text), "posteriors")
    scored = materialize(calibrated(scored, df, known, key, text), "scored")
    rate = fit(scored, weights, budget, shares, most)
    return scored.withColumn("rate", rate).drop("copies")


def sample(df: DataFrame, rates: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` whose hash, uniform from 0 to 1, is below their rate; a rate of 1 keeps all."""
    box = boxed(df.withColumn("_row_id_", row_of(key, text))).withColumn("_row_id", of("_row_id_"))
    spot = F.pmod(F.xxhash64(F.lit("keep"), "row"), F.lit(1 << 40)) / float(1 << 40)
    kept = rates.filter(spot < F.col("rate")).select(F.col("row").alias("_row_id"))
    return unboxed(box.join(kept, "_row_id", "left_semi"), df.columns)
