"""Near-duplicate documents by MinHash signatures and a multi-index Hamming join.

A document is the set of its word shingles. Its signature has 32 lanes of 16 bits, cut into 8 chunks of four
lanes. Two signatures that differ in at most 15 lanes have, by the pigeonhole principle, a chunk in which at
most one lane differs; every chunk is therefore indexed four times, each time with one lane masked. Pairs that
share an index key are candidates; they become links only after a comparison of the full shingle sets.

Equal sets are one node from the start. The members of a key are never paired with each other: each is
compared with one leader, the member that meets most others. Nodes of keys whose members are still in
different components are compared once more across components, where they share one of their rarest shingles,
as all similar sets do: first with one node of the largest component, then with all. So no link between
different sets is lost, and a large group of near copies costs about as many comparisons as it has members.

Nodes are named by a 64-bit hash of their set; two different sets share a name with probability 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioforge.llm.common import boxed, of, unboxed
from folioforge.session import materialize

LANES, CHUNKS, WIDTH = 32, 8, 4
#: Lanes that may differ in candidates that are compared in full. All pairs up to 15 are found; of those
#: beyond, which the index may also give, the ones up to this number are kept.
MAX_DISTANCE = 20
_DRAW = np.random.default_rng(20240607)
_FACTORS = _DRAW.integers(1 << 62, 1 << 63, LANES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _DRAW.integers(0, 1 << 63, LANES, dtype=np.uint64)
_PLACES = _DRAW.integers(1 << 62, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


class _Words(dict):
    """Hashes of words; emptied when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1_000_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX[0]
    h = (h ^ (h >> np.uint64(27))) * _MIX[1]
    return h ^ (h >> np.uint64(31))


def shingle_hashes(text: str | None, size: int, known: _Words) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a text, A to Z taken as lower case."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(known.__getitem__, parts), np.uint64, len(parts))
    span = min(size, len(ids))
    total = np.full(len(ids) - span + 1, span, np.uint64)
    for i in range(span):
        total += ids[i : len(ids) - span + 1 + i] * _PLACES[i]
    return np.unique(_mixed(total))


def signature(hashes: np.ndarray) -> np.ndarray:
    """Eight chunks of four 16-bit lanes, as signed longs."""
    if len(hashes) <= 4096:
        least = (hashes[None, :] * _FACTORS[:, None] + _SHIFTS[:, None]).min(axis=1)
    else:
        least = np.array([(hashes * f + s).min() for f, s in zip(_FACTORS, _SHIFTS, strict=True)])
    lanes = (_mixed(least) >> np.uint64(48)).reshape(CHUNKS, WIDTH)
    steps = np.arange(WIDTH, dtype=np.uint64) * np.uint64(16)
    return (lanes << steps).sum(axis=1, dtype=np.uint64).view(np.int64)


def _signed(digest: int) -> int:
    return digest - (1 << 64) if digest >> 63 else digest


CHUNK_NAMES = [f"c{i}" for i in range(CHUNKS)]


def signatures(texts: DataFrame, size: int) -> DataFrame:
    """(row, doc, n_shingles, node, c0 to c7) of (row, doc, text); node and chunks are null for an empty set."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Words()
        for batch in batches:
            counts, nodes, chunks = [], [], []
            for text in batch["text"]:
                hashes = shingle_hashes(text, size, known)
                counts.append(len(hashes))
                nodes.append(_signed(xxhash.xxh64_intdigest(hashes.tobytes())) if len(hashes) else None)
                chunks.append(signature(hashes).tolist() if len(hashes) else [None] * CHUNKS)
            out = pd.DataFrame({"row": batch["row"], "doc": batch["doc"].astype("Int64"), "n_shingles": counts})
            out["node"] = pd.array(nodes, dtype="Int64")
            for i, name in enumerate(CHUNK_NAMES):
                out[name] = pd.array([c[i] for c in chunks], dtype="Int64")
            yield out

    fields = ", ".join(f"{c} long" for c in CHUNK_NAMES)
    return texts.mapInPandas(run, f"row long, doc long, n_shingles long, node long, {fields}")


def shingle_sets(texts: DataFrame, size: int) -> DataFrame:
    """(node, shingles) of (node, text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Words()
        for batch in batches:
            sets = [shingle_hashes(t, size, known).view(np.int64) for t in batch["text"]]
            yield pd.DataFrame({"node": batch["node"], "shingles": sets})

    return texts.mapInPandas(run, "node long, shingles array<long>")


def index_keys(chunks: list[Column]) -> Column:
    """The 32 index keys of a signature: each chunk with each of its lanes masked."""
    keys = []
    for i, c in enumerate(chunks):
        for lane in range(WIDTH):
            mask = ~(0xFFFF << (16 * lane)) & ((1 << 64) - 1)
            keys.append(F.xxhash64(F.lit(i * WIDTH + lane), c.bitwiseAND(F.lit(_signed(mask)))))
    return F.array(*keys)


def lane_distance(a: list[Column], b: list[Column]) -> Column:
    total = F.lit(0)
    for x, y in zip(a, b, strict=True):
        both = x.bitwiseXOR(y)
        for lane in range(WIDTH):
            total = total + (both.bitwiseAND(F.lit(_signed(0xFFFF << (16 * lane)))) != 0).cast("int")
    return total


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of ``edges`` (a, b); label is the smallest node that can be reached.

    Labels take the smallest label of a neighbour and then their label's own label, until nothing changes,
    so long chains take few rounds.
    """
    both = materialize(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links"
    )
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label"))
    labels = materialize(labels, "labels")
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        taken = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("up"))
        moved = taken.join(up, "label").select("node", "old", F.least("label", "up").alias("label"))
        seen = Observation()
        changed = F.sum((F.col("old") != F.col("label")).cast("long")).alias("changed")
        labels = materialize(moved.observe(seen, changed), "labels").select("node", "label")
        if not seen.get["changed"]:
            return labels


class _Search:
    """Candidates and confirmed links among the distinct shingle sets of one table."""

    def __init__(self, texts: DataFrame, rows: DataFrame, size: int, percent: int):
        self.percent = percent
        firsts = [F.min(c).alias(c) for c in CHUNK_NAMES]
        self.nodes = materialize(
            rows.filter("n_shingles > 0")
            .groupBy("node")
            .agg(F.min("row").alias("row"), F.min("doc").alias("doc"), F.min("n_shingles").alias("n"), *firsts),
            "nodes",
        )
        keys = self.nodes.select("node", F.explode(index_keys([F.col(c) for c in CHUNK_NAMES])).alias("key"))
        shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        # members of keys that more than one node has
        self.members = materialize(keys.join(shared, "key"), "members")
        rows = self.members.select("node").distinct().join(self.nodes.select("node", "row"), "node")
        self.sets = materialize(shingle_sets(texts.join(rows, "row").select("node", "text"), size), "sets")
        self.edges = None

    def confirm(self, pairs: DataFrame) -> DataFrame:
        """Of the pairs (a, b), those whose full sets are similar enough."""
        sides = {}
        for side in "ab":
            sides[side] = self.nodes.select(
                F.col("node").alias(side), F.col("n").alias(f"n_{side}"), *[F.col(c).alias(f"{c}_{side}") for c in CHUNK_NAMES]
            )
        gap = lane_distance(*[[F.col(f"{c}_{s}") for c in CHUNK_NAMES] for s in "ab"])
        # sets of very unequal size cannot be similar enough
        fits = 100 * F.least("n_a", "n_b") >= self.percent * F.greatest("n_a", "n_b")
        near = pairs.distinct().join(sides["a"], "a").join(sides["b"], "b").filter(fits & (gap <= MAX_DISTANCE))
        near = materialize(near.select("a", "b", "n_a", "n_b"), "pairs")
        left = self.sets.select(F.col("node").alias("a"), F.col("shingles").alias("s_a"))
        right = self.sets.select(F.col("node").alias("b"), F.col("shingles").alias("s_b"))
        both = F.size(F.array_intersect("s_a", "s_b"))
        joined = near.join(left, "a").join(right, "b")
        return joined.filter(100 * both >= self.percent * (F.col("n_a") + F.col("n_b") - both)).select("a", "b")

    def add(self, pairs: DataFrame) -> None:
        found = materialize(self.confirm(pairs), "edges")
        self.edges = found if self.edges is None else self.edges.union(found)
        self.labels = components(self.edges)

    def labelled(self) -> DataFrame:
        """Members of keys whose nodes are not all in one component."""
        named = self.members.filter("size > 2").join(self.labels, "node", "left")
        named = named.select("key", "node", F.coalesce("label", "node").alias("label"))
        ends = named.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"))
        return named.join(ends.filter("low <> high").select("key"), "key")

    def by_weight(self) -> DataFrame:
        """Pairs of each key's leader with its other members.

        The leader is the member that meets most others over all its keys: the text that the others are
        edits of, or one near it.
        """
        weight = self.members.groupBy("node").agg(F.sum("size").alias("weight"))
        top = self.members.join(weight, "node").groupBy("key").agg(F.max(F.struct("weight", "node")).alias("top"))
        lead = top.select("key", F.col("top.node").alias("a"))
        return self.members.join(lead, "key").filter("node <> a").select("a", F.col("node").alias("b"))

    def heads(self, open_keys: DataFrame) -> DataFrame:
        """(node, n, s, left): the rarest shingles of the given nodes, and how many each has from there on.

        Two similar sets share a shingle among the first ``n - needed + 1`` of each in any common order; here
        the rarest come first.
        """
        nodes = open_keys.select("node").distinct().join(self.nodes.select("node", "n"), "node")
        spread = self.sets.join(nodes.select("node"), "node", "left_semi").select("node", F.explode("shingles").alias("s"))
        found = spread.groupBy("s").agg(F.count(F.lit(1)).alias("f")).filter("f > 1")
        shared = spread.join(found, "s").groupBy("node").agg(F.sort_array(F.collect_set(F.struct("f", "s"))).alias("o"))
        shared = shared.join(nodes, "node").withColumn("own", F.col("n") - F.size("o"))
        first = F.col("n") - F.ceil(F.col("n") * self.percent / 100) + 1 - F.col("own")
        heads = shared.filter(first > 0).select(
            "node", "n", "own", F.posexplode(F.slice("o", F.lit(1), first.cast("int"))).alias("at", "h")
        )
        left = (F.col("n") - F.col("own") - F.col("at")).alias("left")
        return materialize(heads.select("node", "n", F.col("h.s").alias("s"), left), "heads")

    def across(self, heads: DataFrame, best: bool) -> DataFrame:
        """Pairs of nodes in different components that share one of the rarest shingles of both.

        What both have from the first shared shingle on must be as much as similar sets share, so a set with
        many shingles of its own meets others by rare ones only. All similar pairs of the given nodes are
        found, or with ``best`` only those with the node of the largest component that has most left.
        """
        named = heads.join(self.labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        parts = named.groupBy("s", "label").agg(F.count(F.lit(1)).alias("size"))
        tops = parts.groupBy("s").agg(F.max(F.struct("size", "label")).alias("top"), F.count(F.lit(1)).alias("labels"))
        tops = tops.filter("labels > 1").select("s", F.col("top.label").alias("top"))
        marked = named.join(tops, "s")
        # the largest component at a shingle is met by the members of the others only
        names = {"node": "a", "label": "label_a", "n": "n_a", "left": "left_a"}
        others = marked.filter("label <> top").select("s", *[F.col(c).alias(name) for c, name in names.items()])
        met = named
        if best:
            most = marked.filter("label = top").groupBy("s").agg(F.max(F.struct("left", "node", "n", "label")).alias("m"))
            met = most.select("s", "m.*")
        fits = 100 * F.least("n", "n_a") >= self.percent * F.greatest("n", "n_a")
        enough = (100 + self.percent) * F.least("left", "left_a") >= self.percent * (F.col("n") + F.col("n_a"))
        pairs = others.join(met, "s").filter(fits & enough & (F.col("label") != F.col("label_a")))
        return pairs.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b"))

    def run(self) -> DataFrame:
        self.add(self.by_weight())
        open_keys = materialize(self.labelled(), "open")
        if not open_keys.isEmpty():
            heads = self.heads(open_keys)
            self.add(self.across(heads, best=True))
            self.add(self.across(heads, best=False))
        return self.labels


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``df``: row, doc (its key), n_shingles and component_id, the smallest key it is linked with.

    Texts are linked if the sets of their shingles of ``size`` words have 100 * intersection >= ``percent`` *
    union; a text with fewer words is one shingle. A null, empty or blank text has no shingle and is linked
    with nothing. ``row`` is a hash of key and text; rows equal in both have the same. Keys that repeat with
    other texts are judged by each text. Null keys count as larger than all others; a component of null keys
    only has a null id. An empty table gives no rows.
    """
    texts = df.select(row_of(key, text).alias("row"), F.col(f"`{key}`").cast("long").alias("doc"), F.col(f"`{text}`").alias("text"))
    rows = materialize(signatures(texts, size), "signatures")
    search = _Search(texts.select("row", "text"), rows, size, percent)
    labels = search.run()
    named = search.nodes.select("node", "doc").join(labels, "node", "left")
    named = named.select("node", "doc", F.coalesce("label", "node").alias("label"))
    least = named.groupBy("label").agg(F.min("doc").alias("component_id"))
    by_node = named.join(least, "label").select("node", "component_id")
    joined = rows.join(by_node, "node", "left")
    return joined.select(
        "row", "doc", "n_shingles", F.when(F.col("node").isNull(), F.col("doc")).otherwise(F.col("component_id")).alias("component_id")
    )


def row_of(key: str, text: str) -> Column:
    return F.xxhash64(F.col(f"`{key}`"), F.col(f"`{text}`"))


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``df`` less all but the one with the smallest key in each group of near duplicates.

    Rows equal in key and text are copies: one stays. Rows that share a key with other texts are judged by
    each text. A row whose text has no word stays.
    """
    found = near_duplicates(df, key, text, size, percent)
    kept = found.filter(F.col("doc").eqNullSafe(F.col("component_id"))).select(F.col("row").alias("_row_id")).distinct()
    box = boxed(df.withColumn("_row_id_", row_of(key, text))).withColumn("_row_id", of("_row_id_"))
    once = F.row_number().over(Window.partitionBy("_row_id").orderBy(F.lit(1)))
    left = box.join(kept, "_row_id", "left_semi").withColumn("_once", once).filter("_once = 1")
    return unboxed(left, df.columns)
