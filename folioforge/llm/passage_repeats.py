"""Removal of passages of 50 or more words that a document with a smaller key holds too, by seed and extend.

1. Seeds. Of the 31 grams of 20 words in a window of 50 words, those with the smallest hash are anchors (winnowing).
   Equal windows have equal anchors at equal places. The context of an anchor is all that its windows can reach: up
   to 30 words on either side.
2. Join. The first occurrence of an anchor, by document, place and hash, leads all others, so that an anchor is joined
   with one row however many documents hold it. Occurrences whose context equals that of their leader are settled.
3. Extension. Other occurrences are compared with their leader word by word in both directions; what is matched is a
   maximal repeat if it has 50 words or more.
4. Rest. A window that reaches beyond the match can only be found in an occurrence that is no leader. Such windows are
   seeds of their own, of 50 words: each belongs to its leftmost smallest anchor, so it is one row, and the first
   document that holds it leads the others.

Every leader is a minimum that is taken before rows are shuffled, and every join gives at most one row per anchor
place or window, whatever the number of copies.
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

#: Words of a repeated window, and of an anchor gram.
WINDOW, GRAM = 50, 20
REACH = WINDOW - GRAM
#: Window starts of a long document that are looked at in one step.
STEP = 1 << 17
#: Different words whose hashes a task remembers; beyond these it starts anew.
REMEMBERED = 1 << 18
#: The order key of documents without an id: after all others.
LAST = (1 << 63) - 1

#: Odd bases of the two rolling hashes.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_ANCHORS = "gram long, context long, doc long, row long, at int"
_CONTEXTS = "gram long, leads boolean, doc long, row long, at int, left int, words binary"
_FOUND = "doc long, row long, low int, high int, h long, g long"
_RESULTS = "doc_id long, n_words long, n_removed long, kept_sha256 string"


class WordHashes(dict):
    """64-bit hash of each word asked for."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def words_of(text: str | None) -> list[bytes]:
    """Words between blanks (space, U+0009 to U+000D), as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


class Rolling:
    """Hashes of any ranges of ``hashes``, along the last axis: differences of prefix sums, shifted back to the origin."""

    def __init__(self, hashes: np.ndarray, base: int = _BASES[0]):
        n = hashes.shape[-1]
        steps = np.full(n + 1, base, np.uint64)
        back = np.full(n + 1, pow(base, -1, 1 << 64), np.uint64)
        steps[0] = back[0] = 1
        self.sums = np.zeros((*hashes.shape[:-1], n + 1), np.uint64)
        np.cumsum(hashes * np.multiply.accumulate(steps)[:n], axis=-1, out=self.sums[..., 1:])
        self.back = np.multiply.accumulate(back)

    def spans(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[..., high] - self.sums[..., low]) * self.back[low])

    def every(self, width: int) -> np.ndarray:
        n = max(self.sums.shape[-1] - width, 0)
        return _mixed((self.sums[..., width:] - self.sums[..., :n]) * self.back[:n])


def _extreme(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of every ``width`` neighbours."""
    done = 1
    while done * 2 <= width:
        values = pick(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gram hash, context hash and place of the grams that are smallest in some window."""
    n, found = len(hashes), []
    for start in range(0, max(n - WINDOW + 1, 0), STEP):
        # the reach on either side of what this step decides
        first, last = max(0, start - REACH), min(n, start + STEP + WINDOW - 1 + REACH)
        rolling = Rolling(hashes[first:last])
        grams = rolling.every(GRAM)
        least = _extreme(grams, REACH + 1, np.minimum)
        pad = np.zeros(REACH, np.uint64)
        at = np.flatnonzero(_extreme(np.concatenate((pad, least, pad)), REACH + 1, np.maximum) == grams)
        # a place is decided in the step whose starts it lies among; the last step has the rest
        at = at[(at + first >= start) & ((at + first < start + STEP) | (start + STEP > n - WINDOW))]
        low, high = np.maximum(at - REACH, 0), np.minimum(at + WINDOW, last - first)
        sides = (at - low).astype(np.uint64) * np.uint64(64) + (high - at).astype(np.uint64)
        found.append((grams[at], _mixed(rolling.spans(low, high) ^ (sides * np.uint64(_BASES[1]))), at + first))
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64)
    return tuple(np.concatenate(part) for part in zip(*found, strict=True))


def _anchor_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = WordHashes()
    for batch in batches:
        found = [anchors(hashes.of(words_of(t))) for t in batch["text"]]
        sizes = [len(f[0]) for f in found]
        if sum(sizes):
            yield pd.DataFrame(
                {
                    "gram": np.concatenate([f[0] for f in found]).view(np.int64),
                    "context": np.concatenate([f[1] for f in found]).view(np.int64),
                    "doc": np.repeat(batch["doc"].to_numpy(), sizes),
                    "row": np.repeat(batch["row"].to_numpy(), sizes),
                    "at": np.concatenate([f[2] for f in found]).astype(np.int32),
                }
            )


def _context_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes, names = WordHashes(), ["gram", "leads", "doc", "row", "at", "left", "words"]
    for batch in batches:
        out = []
        for doc, row, text, places in zip(batch["doc"], batch["row"], batch["text"], batch["places"], strict=True):
            words = words_of(text)
            for p in places:
                at = p["at"]
                low = max(0, at - REACH)
                around = hashes.of(words[low : at + WINDOW])
                out.append((p["gram"], p["leads"], doc, row, at, at - low, around.tobytes()))
        if out:
            yield pd.DataFrame(out, columns=names)


def _aligned(contexts: list[bytes], lefts: np.ndarray, none: int) -> np.ndarray:
    """Contexts as rows of one matrix, with their grams in the same columns; ``none`` stands for missing words."""
    out = np.full((len(contexts), REACH + WINDOW), none, np.uint64)
    for row, (words, left) in enumerate(zip(contexts, lefts.tolist(), strict=True)):
        found = np.frombuffer(words, np.uint64)
        out[row, REACH - left : REACH - left + len(found)] = found
    return out


def matched(own: np.ndarray, lead: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row of two matrices: the columns, from low to before high, that agree around the gram."""
    same = own == lead
    low = REACH - np.logical_and.accumulate(same[:, :REACH][:, ::-1], axis=1).sum(axis=1)
    return low, REACH + np.logical_and.accumulate(same[:, REACH:], axis=1).sum(axis=1)


def own_windows(grams: np.ndarray) -> np.ndarray:
    """Whether the gram in the middle is the leftmost smallest one of the window that starts in each column."""
    middle, most = grams[:, REACH : REACH + 1], np.full((len(grams), 1), np.iinfo(np.uint64).max)
    before = np.minimum.accumulate(grams[:, :REACH][:, ::-1], axis=1)[:, ::-1]
    after = np.minimum.accumulate(grams[:, REACH + 1 :], axis=1)
    earlier = np.concatenate((middle < before, np.ones_like(most, bool)), axis=1)
    return earlier & (middle <= np.concatenate((most, after), axis=1))


def _extended_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Maximal repeats (low, high), and hashes of the windows that reach beyond the match, per occurrence."""
    starts = np.arange(REACH + 1)
    for batch in batches:
        if batch.empty:
            continue
        doc, row, left = (batch[c].to_numpy() for c in ("doc", "row", "left"))
        own = _aligned(batch["words"], left, 0)
        low, high = matched(own, _aligned(batch["lead_words"], batch["lead_left"].to_numpy(), 1))
        # no match reaches beyond the words there are, and no window does
        first, last = REACH - left, REACH - left + batch["words"].map(len).to_numpy() // 8
        low, high = np.maximum(low, first), np.minimum(high, last)
        origin = batch["at"].to_numpy() - REACH
        long = (batch["lead_doc"].to_numpy() < doc) & (high - low >= WINDOW)
        yield pd.DataFrame({"doc": doc[long], "row": row[long], "low": (origin + low)[long], "high": (origin + high)[long], "h": None, "g": None})

        rolling = [Rolling(own, base) for base in _BASES]
        beyond = (starts < low[:, None]) | (starts + WINDOW > high[:, None])
        whole = (starts >= first[:, None]) & (starts + WINDOW <= last[:, None])
        at, start = np.nonzero(own_windows(rolling[0].every(GRAM)) & beyond & whole)
        h, g = (r.every(WINDOW)[at, start].view(np.int64) for r in rolling)
        place = origin[at] + start
        yield pd.DataFrame({"doc": doc[at], "row": row[at], "low": place, "high": place + WINDOW, "h": h, "g": g})


def cut(words: list[bytes], spans: list[tuple[int, int]]) -> list[bytes]:
    """``words`` without those that a span covers."""
    kept, end = [], 0
    for low, high in sorted(spans):
        if low > end:
            kept += words[end:low]
        end = max(end, high)
    return kept + words[end:]


def _cut_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for key, text, spans in zip(batch["doc_id"], batch["text"], batch["spans"], strict=True):
            words = words_of(text)
            kept = words if spans is None else cut(words, [(s["low"], s["high"]) for s in spans])
            out.append((None if pd.isna(key) else int(key), len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
        found = pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept_sha256"])
        yield found.astype({"doc_id": "Int64"})


def _numbered(df: DataFrame, key: str, text: str) -> DataFrame:
    own, whole = F.col(f"`{key}`").cast("long"), F.col(f"`{text}`")
    return df.select(own.alias("doc_id"), F.coalesce(own, F.lit(LAST)).alias("doc"), F.xxhash64(own, whole).alias("row"), whole.alias("text"))


def repeated_spans(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, row, spans): word ranges of a document, from low to before high, that a smaller key's text holds too.

    Spans may overlap and each has 50 words or more, beyond which its text may end. ``row`` is the hash of key and
    text; documents without repeats have no row.
    """
    docs = _numbered(df, key, text)
    # 50 words need 99 bytes at least
    long_enough = docs.filter(F.octet_length("text") >= 2 * WINDOW - 1)
    seeds = written(long_enough.select("doc", "row", "text").mapInPandas(_anchor_rows, _ANCHORS), "seeds")
    first = F.min(F.struct("doc", "row", "at", "context")).alias("lead")
    leads = seeds.groupBy("gram").agg(first, F.max("doc").alias("last")).filter("last > lead.doc").drop("last")
    # written, so that a join with a hot gram is cut where rows are read
    others = seeds.join(written(leads, "leads"), "gram").filter(F.struct("doc", "row", "at", "context") != F.col("lead"))
    others = written(others, "others")

    like_lead = F.col("context") == F.col("lead.context")
    settled = others.filter(like_lead & (F.col("doc") > F.col("lead.doc")))
    settled = settled.select("doc", "row", (F.col("at") - REACH).alias("low"), (F.col("at") + WINDOW).alias("high"))
    open_ones = others.filter(~like_lead)
    own = open_ones.select("doc", "row", F.struct("gram", "at", F.lit(False).alias("leads")).alias("place"))
    lead = open_ones.groupBy("gram").agg(F.first("lead").alias("lead"))
    lead = lead.select("lead.doc", "lead.row", F.struct("gram", "lead.at", F.lit(True).alias("leads")).alias("place"))
    # at most the places of one text
    wanted = own.union(lead).groupBy("doc", "row").agg(F.collect_set("place").alias("places"))
    contexts = written(
        long_enough.select("doc", "row", "text").join(wanted, ["doc", "row"]).mapInPandas(_context_rows, _CONTEXTS), "contexts"
    )
    # rows equal in key and text are one document
    leading = contexts.filter("leads").groupBy("gram").agg(F.min(F.struct("doc", "left", "words")).alias("lead"))
    pairs = contexts.filter("not leads").join(written(leading, "leading"), "gram")
    pairs = pairs.select("doc", "row", "at", "left", "words", *[F.col(f"lead.{c}").alias(f"lead_{c}") for c in ("doc", "left", "words")])
    extended = written(pairs.mapInPandas(_extended_rows, _FOUND), "extended")

    windows = extended.filter("h is not null")
    held = windows.groupBy("h", "g").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).filter("last > first").drop("last")
    rest = windows.join(written(held, "held"), ["h", "g"]).filter("doc > first")
    spans = settled.unionByName(extended.filter("h is null").select("doc", "row", "low", "high"))
    spans = spans.unionByName(rest.select("doc", "row", "low", "high"))
    return spans.groupBy("doc", "row").agg(F.collect_set(F.struct(F.greatest("low", F.lit(0)).alias("low"), "high")).alias("spans"))


def without_repeats(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``df``: doc_id (its key), n_words, n_removed and kept_sha256 (kept words, joined by one space).

    Words lie between blanks (space, U+0009 to U+000D). A word is removed if a window of 50 words that covers it is
    also in a row with a smaller key; repeats within one key do not count. Windows are judged on the input.

    Null, empty and blank texts have no words. Rows with equal keys are judged against smaller keys only, so repeated
    rows stay alike. Rows without a key come after all others. Columns other than key and text are not looked at. An
    empty table gives no rows.
    """
    spans = written(repeated_spans(df, key, text), "spans")
    docs = _numbered(df, key, text).join(spans, ["doc", "row"], "left")
    return docs.select("doc_id", "text", "spans").mapInPandas(_cut_rows, _RESULTS)


def kept_text(text: Column, spans: Column) -> Column:
    """A text's words outside ``spans``, joined by one space."""

    @F.pandas_udf("string")
    def joined(texts: pd.Series, ranges: pd.Series) -> pd.Series:
        parts = [
            words_of(t) if r is None else cut(words_of(t), [(s["low"], s["high"]) for s in r])
            for t, r in zip(texts, ranges, strict=True)
        ]
        return pd.Series([b" ".join(p).decode("utf-8", "surrogatepass") for p in parts])

    return joined(text, spans)
