"""Quality rules whose cutoffs are chosen under a bound on false rejections.

Every rule rejects documents whose score is above a cutoff. Labelled documents that are good and would be
rejected are false rejections. For each stratum, rule and cutoff of a fixed grid, an exact binomial test on
the labelled holdout asks whether the rate of false rejections is at most the rule's share of the allowed
rate. Errors of all tests together are bounded by the Bonferroni correction. Of the cutoffs that pass, the
one that rejects most bad documents is taken; where none passes, the rule rejects nothing in that stratum.
The grid is fixed beforehand, so all labelled rows are holdout.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import BLANKS, boxed, let, of, unboxed, words
from folioforge.session import materialize

SYMBOLS = "#*$%&|<>"
#: Cutoffs of each rule's score, lenient ones last.
GRID = {
    "symbols": (0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 1.0, 2.0),
    "lines": (0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.7),
    "repeats": (0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5),
    "long_words": (6.0, 6.5, 7.0, 7.5, 8.0, 9.0, 10.0, 12.0),
}
#: False rejections allowed in a stratum, all rules together, and the chance that the bound is broken.
MAX_FALSE, ALPHA = 0.02, 0.05
#: A good document weighs as many bad ones when cutoffs that pass are compared.
GOOD_WEIGHT = 10
#: Strata up to which the cutoffs are sent to all tasks; more are joined by shuffle.
SMALL = 10_000
#: Terms of the binomial sum that are added one by one; a bound takes the place of the rest.
TERMS = 2000

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeats(ws: Column) -> Column:
    """Words that lie in a three-word window found twice or more."""

    def covered(places: Column) -> Column:
        n = F.size(places)
        steps = F.zip_with(
            F.slice(places, F.lit(1), n - 1), F.slice(places, F.lit(2), n - 1), lambda a, b: F.least(b - a, F.lit(3))
        )
        return F.aggregate(steps, F.lit(3), lambda s, x: s + x)

    def among(ordered: Column) -> Column:
        n = F.size(ordered)
        twins = F.zip_with(
            F.slice(ordered, F.lit(1), n - 1),
            F.slice(ordered, F.lit(2), n - 1),
            lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])),
        )
        places = F.sort_array(F.array_distinct(F.flatten(F.filter(twins, lambda t: t.isNotNull()))))
        return let(places, covered)

    def of_hashes(hs: Column) -> Column:
        pairs = F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(hs)) == F.size(hs), 0).otherwise(let(F.sort_array(pairs), among))

    windows = F.transform(
        F.sequence(F.lit(0), F.size(ws) - 3), lambda i: F.xxhash64(ws[i], ws[i + 1], ws[i + 2])
    )
    return F.when(F.size(ws) < 3, 0).otherwise(let(windows, of_hashes))


def measures(text: Column) -> dict[str, Column]:
    """Counts over the whole text; all are 0 for a null text."""
    whole = F.coalesce(text, F.lit(""))
    length = F.length(whole)
    lines = F.filter(F.split(whole, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    return {
        "n_words": F.size(words(text)).cast("long"),
        "word_chars": F.length(F.translate(whole, BLANKS, "")).cast("long"),
        "n_symbols": (length - F.length(F.translate(whole, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": let(lines, lambda ls: F.size(ls) - F.size(F.array_distinct(ls))).cast("long"),
        "n_repeat_words": let(words(text), _repeats).cast("long"),
    }


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 50) | (100 * n_repeat_words > 50 * n_words)


def scores(m: dict[str, Column]) -> dict[str, Column]:
    n = F.greatest(m["n_words"], F.lit(1)).cast("double")
    return {
        "symbols": m["n_symbols"] / n,
        "lines": m["n_dup_lines"] / n * 10,
        "repeats": m["n_repeat_words"] / n,
        "long_words": m["word_chars"] / n,
    }


def log_factorial(n: Column) -> Column:
    """ln n! by Stirling's series at n + 9, exact to about 1e-13."""
    z = n.cast("double") + 9
    series = (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (
        1260 * z * z * z * z * z
    )
    shift = reduce(lambda a, k: a + F.log(n.cast("double") + k), range(2, 9), F.log(n.cast("double") + 1))
    return series - shift


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X of Binomial(n, p); 1 where k >= n p, as such a count is never evidence of a low rate.

    Terms fall from k downwards; what follows the first ``TERMS`` is bounded by a geometric series, so the
    value is exact for k up to that number and never too small.
    """
    x, m = k.cast("double"), n.cast("double")
    top = F.exp(log_factorial(n) - log_factorial(k) - log_factorial(n - k) + x * math.log(p) + (m - x) * math.log1p(-p))

    def ratio(j: Column) -> Column:
        return j * (1 - p) / ((m - j + 1) * p)

    def step(acc: Column, i: Column) -> Column:
        term = acc["term"] * ratio(x - i.cast("double") + 1)
        return F.struct((acc["sum"] + term).alias("sum"), term.alias("term"))

    counted = F.least(k.cast("int"), F.lit(TERMS))
    down = F.when(counted > 0, F.sequence(F.lit(1), F.greatest(counted, F.lit(1)))).otherwise(
        F.array().cast("array<int>")
    )
    total = F.aggregate(down, F.struct(top.alias("sum"), top.alias("term")), step)
    r = ratio(x)
    return F.when(x >= m * p, F.lit(1.0)).otherwise(total["sum"] + F.when(k > TERMS, total["term"] * r / (1 - r)).otherwise(0.0))


def cutoffs(
    labelled: DataFrame, grid: dict = GRID, max_false: float = MAX_FALSE, alpha: float = ALPHA
) -> DataFrame:
    """One row per stratum with a cutoff per rule (infinite where none passes), from ``labelled``.

    ``labelled`` has ``stratum``, ``good`` (boolean) and a score per rule. Its rows are counted per stratum,
    rule and grid step before they are shuffled, so a stratum of any size is a few rows.
    """
    share = max_false / len(grid)
    # grid steps that a score is above: it is rejected by the cutoffs at those steps
    above = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(rule).alias("rule"),
                    reduce(lambda a, c, s=F.col(rule): a + (s > c).cast("int"), steps, F.lit(0)).alias("above"),
                )
                for rule, steps in grid.items()
            ]
        )
    )
    counted = (
        labelled.select("stratum", "good", above.alias("_a"))
        .groupBy("stratum", "_a.rule", "_a.above")
        .agg(F.count(F.when(F.col("good"), 1)).alias("good"), F.count(F.when(~F.col("good"), 1)).alias("bad"))
    )
    # a few rows per stratum, used several times
    counted = materialize(counted, "rule-counts")
    places = F.array(
        *[
            F.struct(F.lit(rule).alias("rule"), F.lit(i).alias("step"), F.lit(float(c)).alias("cutoff"))
            for rule, steps in grid.items()
            for i, c in enumerate(sorted(steps))
        ]
    )
    steps = counted.select("stratum", "rule", "above", "good", "bad", F.explode(places).alias("_p")).filter(
        F.col("rule") == F.col("_p.rule")
    )
    hit = F.col("above") > F.col("_p.step")
    tested = steps.groupBy("stratum", "rule", "_p.cutoff").agg(
        F.sum("good").alias("n"),
        F.sum(F.when(hit, F.col("good")).otherwise(0)).alias("k"),
        F.sum(F.when(hit, F.col("bad")).otherwise(0)).alias("caught"),
    )
    tests = sum(len(s) for s in grid.values()) * max(counted.select("stratum").distinct().count(), 1)
    level = tested.filter(binomial_tail(F.col("k"), F.col("n"), share) <= alpha / tests)
    gain = F.col("caught") - GOOD_WEIGHT * F.col("k")
    best = F.max(F.struct(gain.alias("gain"), F.col("cutoff").alias("cutoff")))
    chosen = level.groupBy("stratum").pivot("rule", list(grid)).agg(best.alias("best"))
    return chosen.select(
        "stratum",
        *[
            F.coalesce(F.when(F.col(rule)["gain"] >= 0, F.col(rule)["cutoff"]), F.lit(float("inf"))).alias(f"max_{rule}")
            for rule in grid
        ],
    )


def judge(
    df: DataFrame, measured: DataFrame, labels: DataFrame, key: str = "doc_id", stratum: str = "lang"
) -> DataFrame:
    """``df`` with ``base_failed`` and ``kept``. ``df`` and ``measured`` have the five counts as columns.

    ``measured`` is the frame that labels are joined to, normally the same rows. A label without quality, or
    of a document that is not there, counts for nothing; documents that fail the base rule are no holdout
    either. A null stratum is a stratum. Without labels, or with too few, only the base rule rejects.
    """
    own = {m: F.col(m) for m in MEASURES}
    failed = base_failed(own["n_words"], own["n_repeat_words"])
    name = F.coalesce(F.concat(F.lit("="), F.col(stratum).cast("string")), F.lit("null"))
    known = labels.filter(F.col("quality").isNotNull()).select(
        F.col(key).alias("_label_of"), (F.col("quality") == 1).alias("good")
    )
    labelled = (
        measured.filter(~failed)
        .select(F.col(key).alias("_key"), name.alias("stratum"), *[s.alias(r) for r, s in scores(own).items()])
        .join(known, F.col("_key") == F.col("_label_of"))
    )
    limits = materialize(cutoffs(labelled).withColumnRenamed("stratum", "_stratum"), "cutoffs")
    if limits.count() <= SMALL:
        limits = F.broadcast(limits)  # a row per stratum; else whole texts would be shuffled by it
    joined = df.withColumn("_name", name).join(limits, F.col("_name") == F.col("_stratum"), "left")
    over = reduce(
        lambda a, rule: a | F.coalesce(scores(own)[rule] > F.col(f"max_{rule}"), F.lit(False)), GRID, F.lit(False)
    )
    return joined.withColumns({"base_failed": failed, "kept": ~failed & ~over})


def assess(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """``df`` with the counts of ``MEASURES``, ``base_failed`` and ``kept``; columns of these names are replaced.

    Null and empty texts have no words and fail the base rule. Equal rows get equal verdicts. An empty table
    stays empty.
    """
    box = boxed(df).withColumns(measures(of(text)) | {key: of(key), stratum: of(stratum)})
    judged = judge(box, box, labels, key, stratum)
    return unboxed(judged, df.columns, *[F.col(m) for m in MEASURES], F.col("base_failed"), F.col("kept"))
