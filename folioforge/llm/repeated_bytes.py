"""Removal of byte strings that occurred before, by longest previous factors at a fixed depth.

The longest previous factor of a position reaches 100 bytes exactly if the suffix that starts there has, among
its neighbours in suffix order that agree with it in 100 bytes, one that starts earlier. Suffixes that agree
in 100 bytes stand next to each other in suffix order; the previous smaller position of every one of them but
the earliest lies among them. So the suffix order is needed only to depth 100, and only for suffixes that can
have an equal: these are found first.

1. Anchors. Every 100-byte string has one anchor, the leftmost of its 48-byte grams with the smallest hash; equal
   strings have equal anchors at equal places. Strings whose anchor occurs once have no equal.
2. Contexts. Neighbouring strings with the same anchor are one context. Of equal contexts, all but the earliest
   have only strings that occurred before.
3. Suffixes. Where an anchor has different contexts, the earliest of each are brought together in slices of about
   ``PIECE``, so an anchor with many contexts is spread over tasks. A slice is put in suffix order, equal suffixes
   by place; a suffix whose predecessor agrees with it in 100 bytes has that as its previous smaller position, and
   the next smaller one never lies among its equals. An anchor with more than one slice hands on the earliest suffix
   of each kind from each slice; these are range-partitioned by their 100 bytes and judged in the same way.

Every string stands in one context, so each place is one suffix. Equal contexts are reduced to their earliest
before rows are shuffled, and of a suffix that stands in several slices one row each is left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import written

#: Bytes of a repeated string, and of an anchor gram.
DEPTH, GRAM = 100, 48
REACH = DEPTH - GRAM
#: Contexts of an anchor that are put in suffix order at once, each with up to 53 suffixes of 100 bytes. It bounds the
#: memory of a task; results are the same for every value.
PIECE = 10_000
#: Contexts of small slices that are looked at together at least; a matter of speed.
LEAST = 2_000
#: Bytes of a long document that are looked at in one step.
STEP = 1 << 20
#: The order key of documents without an id: after all others.
LAST = (1 << 63) - 1

_BASE = 0x9E3779B97F4A7C15


def _fields(kind: str) -> str:
    return {
        "anchors": "gram long, row long, span long",
        "contexts": "gram long, c1 long, c2 long, doc long, row long, low int, starts int",
        "wanted": "gram long, slice int, sliced boolean, doc long, row long, low int, starts int, context binary",
        "judged": "row long, low int, high int, doc long, suffix binary",
        "late": "row long, low int, high int",
        "results": "row long, n_removed long, n_spans long, kept_sha256 string",
    }[kind]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of each 48-byte gram: its first 32 bytes and its last 16."""
    h = data.astype(np.uint64) + np.uint64(1)
    spans = {}
    for span in (1, 2, 4, 8, 16):
        spans[span] = h
        h = h[:-span] * np.uint64(pow(_BASE, span, 1 << 64)) + h[span:]
    tail = spans[16][32:]
    h = h[: len(tail)] * np.uint64(pow(_BASE, 16, 1 << 64)) + tail
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of every ``width`` neighbours."""
    done = 1
    while done * 2 <= width:
        values = pick(values[:-done], values[done:])
        done *= 2
    return pick(values[: len(values) - (width - done)], values[width - done :]) if width > done else values


def _owned(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, first string, last string) of every anchor of a block with gram hashes ``h``, by place."""
    least = _sliding(h, REACH + 1, np.minimum)
    pad = np.zeros(REACH, np.uint64)
    places = np.flatnonzero(_sliding(np.concatenate((pad, least, pad)), REACH + 1, np.maximum) == h)
    # runs of strings with one smallest hash; a gram that has it belongs to the last such run that starts at or before it
    first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    last = np.append(first[1:], len(least)) - 1
    kinds = np.unique(least[first])
    wide = len(h) + 1
    of_run = np.searchsorted(kinds, least[first]) * wide + first
    of_place = np.searchsorted(kinds, h[places]) * wide + places
    by_run, by_place = np.argsort(of_run), np.argsort(of_place)
    ranked, of_place = places[by_place], of_place[by_place]
    run = by_run[np.searchsorted(of_run[by_run], of_place, "right") - 1]
    # strings up to the gram before with the same hash are that one's
    same = np.concatenate(([False], of_place[1:] // wide == of_place[:-1] // wide))
    low = np.maximum(first[run], np.where(same, np.concatenate(([0], ranked[:-1])) + 1, 0))
    high = np.minimum(last[run], ranked)
    keep = np.argsort(ranked)
    keep = keep[low[keep] <= high[keep]]
    return ranked[keep], low[keep], high[keep]


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of a text: (hash, place, first string, number of strings).

    The anchor of a string is the leftmost of its grams with the smallest hash. Strings of one anchor are neighbours.
    """
    found = [(np.empty(0, np.uint64), *[np.empty(0, np.int64)] * 3)]
    whole = np.frombuffer(data, np.uint8)
    for start in range(0, max(len(whole) - DEPTH + 1, 0), STEP):
        h = gram_hashes(whole[start : start + STEP + DEPTH - 1])
        place, low, high = _owned(h)
        found.append((h[place], place + start, low + start, high - low + 1))
    return tuple(np.concatenate(column) for column in zip(*found, strict=True))


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _anchor_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Anchors as (gram, row, span); a span packs the first string, the way from it to the anchor, and the strings."""
    for batch in batches:
        found = [anchors(_bytes(t)) for t in batch["text"]]
        sizes = [len(f[0]) for f in found]
        if sum(sizes):
            hashes, places, firsts, counts = (np.concatenate(column) for column in zip(*found, strict=True))
            yield pd.DataFrame(
                {
                    "gram": hashes.view(np.int64),
                    "row": np.repeat(batch["row"].to_numpy(), sizes),
                    "span": firsts << 16 | (places - firsts) << 8 | counts,
                }
            )


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _context_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["gram", "c1", "c2", "doc", "row", "low", "starts"]
    for batch in batches:
        out = []
        for doc, row, text, spans in zip(batch["doc"], batch["row"], batch["text"], batch["places"], strict=True):
            data = _bytes(text)
            for span in np.unique(spans).tolist():
                low, ahead, starts = span >> 16, span >> 8 & 255, span & 255
                end = low + starts + DEPTH - 1
                if end > len(data):
                    continue  # a place of another text with the same hash
                digest = xxhash.xxh3_128_intdigest(data[low:end], seed=ahead)
                gram = xxhash.xxh64_intdigest(data[low + ahead : low + ahead + GRAM])
                c1, c2 = _signed(digest >> 64), _signed(digest & ((1 << 64) - 1))
                out.append((_signed(gram), c1, c2, doc, row, low, starts))
        if out:
            yield pd.DataFrame(out, columns=names)


def _wanted_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["gram", "slice", "sliced", "doc", "row", "low", "starts", "context"]
    for batch in batches:
        out = []
        for doc, row, text, wanted in zip(batch["doc"], batch["row"], batch["text"], batch["wanted"], strict=True):
            data = _bytes(text)
            for place in wanted:
                low, starts = place["low"], place["starts"]
                context = data[low : low + starts + DEPTH - 1]
                out.append((place["gram"], place["slice"], place["slices"] > 1, doc, row, low, starts, context))
        if out:
            yield pd.DataFrame(out, columns=names)


def longest_previous(suffixes: np.ndarray) -> np.ndarray:
    """For each suffix the earliest one that agrees with it in 100 bytes: its own index if there is none before.

    ``suffixes`` are 100-byte strings; equal ones stand in the order of their places. They are put in suffix order
    by a stable sort, so equal ones stay in that order. The previous smaller position of a suffix agrees with it in
    100 bytes exactly if its predecessor does, and a next smaller position never does: the longest previous factor
    reaches 100 bytes where the predecessor agrees. Following predecessors to the first gives the earliest.
    """
    order = np.argsort(suffixes, kind="stable")
    ranked = suffixes[order]
    fresh = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    earliest = np.empty(len(order), np.int64)
    earliest[order] = order[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
    return earliest


def _judged(contexts: pd.DataFrame) -> pd.DataFrame:
    """Runs of late starts of ``contexts``, and of sliced anchors the earliest suffix of each kind."""
    contexts = contexts.sort_values(["doc", "row", "low"])
    counts = contexts["starts"].to_numpy()
    flat = np.frombuffer(b"".join(contexts["context"]), np.uint8)
    offsets = np.concatenate(([0], np.cumsum(counts + DEPTH - 1)[:-1]))
    which = np.repeat(np.arange(len(counts)), counts)
    inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    windows = np.lib.stride_tricks.sliding_window_view(flat, DEPTH)[offsets[which] + inner]
    suffixes = windows.view(f"S{DEPTH}").ravel()
    row, at = contexts["row"].to_numpy()[which], contexts["low"].to_numpy()[which] + inner
    earliest = longest_previous(suffixes)
    # the same place can come twice, from rows that are equal as a whole
    late = (row[earliest] != row) | (at[earliest] != at)
    places = np.flatnonzero(late)
    breaks = np.ones(len(places) + 1, bool)
    breaks[1:-1] = (np.diff(places) != 1) | (np.diff(which[places]) != 0)
    starts, ends = places[np.flatnonzero(breaks[:-1])], places[np.flatnonzero(breaks[1:])]
    runs = pd.DataFrame({"row": row[starts], "low": at[starts], "high": at[ends], "doc": None, "suffix": None})
    split = contexts["sliced"].to_numpy(bool)[which] & (earliest == np.arange(len(earliest)))
    if not split.any():
        return runs
    firsts = pd.DataFrame({"row": row[split], "low": at[split], "high": at[split]})
    firsts["doc"] = contexts["doc"].to_numpy()[which][split]
    firsts["suffix"] = [w.tobytes() for w in windows[split]]
    return firsts if runs.empty else pd.concat([runs.astype({"doc": "Int64"}), firsts.astype({"doc": "Int64"})])


def _judged_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Contexts come sorted by gram and slice; slices are looked at as a whole, small ones together."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) < LEAST:
            continue
        rows = pd.concat(held)
        whole = (rows["gram"] != rows["gram"].iloc[-1]) | (rows["slice"] != rows["slice"].iloc[-1])
        held = [rows[~whole]]
        if whole.any():
            yield _judged(rows[whole])
    if held:
        yield _judged(pd.concat(held))


def _late_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Suffixes come in suffix order, equal ones by place; all but the earliest place of each are late."""
    before = None
    for batch in batches:
        rows = batch if before is None else pd.concat([before, batch])
        earliest = longest_previous(np.array(rows["suffix"].tolist(), f"S{DEPTH}"))
        late = (rows["row"].to_numpy()[earliest] != rows["row"]) | (rows["low"].to_numpy()[earliest] != rows["low"])
        yield rows.loc[late.to_numpy(), ["row", "low", "high"]]
        before = rows.iloc[[earliest[-1]]]


def _cut_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for row, text, runs in zip(batch["row"], batch["text"], batch["runs"], strict=True):
            kept, end, removed, spans, data = hashlib.sha256(), 0, 0, 0, _bytes(text)
            for low, high in sorted((r["low"], r["high"]) for r in runs):
                high += DEPTH
                if low > end or not spans:
                    kept.update(data[end:low])
                    spans += 1
                    removed += high - low
                elif high > end:
                    removed += high - end
                end = max(end, high)
            kept.update(data[end:])
            out.append((row, removed, spans, kept.hexdigest()))
        yield pd.DataFrame(out, columns=["row", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``df``: doc_id (its key), n_bytes, n_removed, n_spans and kept_sha256.

    Texts are UTF-8 bytes. A byte is removed if a string of 100 bytes that covers it also starts earlier: in
    a row with a smaller key, or earlier in the same text. Strings are judged on the input, never cross
    texts, and may overlap.

    Null and empty texts have no bytes. Rows with equal keys are ordered by a hash of key and text; rows
    equal in both are one document, so each is judged against others only. Rows without a key come last. An
    empty table gives no rows.
    """
    own, whole = F.col(f"`{key}`").cast("long"), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    docs = df.select(
        own.alias("id"), F.coalesce(own, F.lit(LAST)).alias("doc"), F.xxhash64(own, whole).alias("row"), whole.alias("text")
    )
    long_enough = docs.filter(F.octet_length("text") >= DEPTH)
    grams = long_enough.select("row", "text").mapInPandas(_anchor_rows, _fields("anchors"))
    twice = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram")
    # at most the places of one text
    places = written(grams.join(twice, "gram").groupBy("row").agg(F.collect_set("span").alias("places")), "places")
    touched = written(long_enough.join(places, "row").select("doc", "row", "text", "places"), "touched")

    contexts = written(touched.mapInPandas(_context_rows, _fields("contexts")), "contexts")
    place = F.struct("doc", "row", "low", "starts")
    firsts = written(contexts.groupBy("gram", "c1", "c2").agg(F.min(place).alias("first")), "firsts")
    again = contexts.join(firsts, ["gram", "c1", "c2"]).filter(place != F.col("first"))
    again = written(again.select("row", "low", (F.col("low") + F.col("starts") - 1).alias("high")), "again")

    varied = firsts.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    wanted = firsts.join(varied, "gram").select("gram", "first", F.ceil(F.col("n") / PIECE).cast("int").alias("slices"))
    cut = F.pmod(F.xxhash64("first.row", "first.low"), "slices").cast("int").alias("slice")
    wanted = wanted.select("first.row", F.struct("gram", cut, "slices", "first.low", "first.starts").alias("w"))
    wanted = wanted.groupBy("row").agg(F.collect_list("w").alias("wanted"))
    sources = written(touched.drop("places").join(wanted, "row").mapInPandas(_wanted_rows, _fields("wanted")), "sources")
    slices = sources.repartition("gram", "slice").sortWithinPartitions("gram", "slice")
    judged = written(slices.mapInPandas(_judged_rows, _fields("judged")), "judged")
    crossing = judged.filter("suffix is not null").repartitionByRange("suffix").sortWithinPartitions("suffix", "doc", "row", "low")
    late = judged.filter("suffix is null").select("row", "low", "high")
    runs = again.union(late).union(crossing.mapInPandas(_late_rows, _fields("late")))
    runs = written(runs.groupBy("row").agg(F.collect_set(F.struct("low", "high")).alias("runs")), "runs")
    texts = touched.select("row", "text").dropDuplicates(["row"])
    cut = texts.join(runs, "row").mapInPandas(_cut_rows, _fields("results"))
    base = docs.select(
        F.col("id").alias("doc_id"),
        "row",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.sha2(F.col("text").cast("binary"), 256).alias("whole"),
    )
    zero = F.lit(0).cast("long")
    return base.join(cut, "row", "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"),
    )
