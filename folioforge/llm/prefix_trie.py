"""The trie of rebuilt conversations, from composable fingerprints of their turns.

A conversation is rebuilt from the first turns of its base, the head, and its own later turns, the suffix. No rebuilt
sequence is made. The fingerprint of turns t1 ... tn is the element (n, sum of t_j * B^j mod p) of a monoid: (n, g)
followed by (m, k) is (n + m, g + B^n k). So prefixes of a suffix are differences of the stored prefixes of its own
conversation, moved to where the head ends, and the prefixes of a head are those of the base.

1. Turns are range-partitioned in order and folded in streams. A conversation that spans partitions is put together
   from its parts' elements, of which two a partition reach the driver.
2. A member row says that a rebuilt conversation has a prefix of some depth and fingerprint. Rows of one prefix are a
   node. Each keeps a reference to a stored turn; a node whose members differ in the turn's SHA-256 or in the parent's
   fingerprint shows a collision, and the trie is made anew with other bases. So equal fingerprints are equal prefixes.
3. The smallest member owns a node. A conversation owns its prefixes from some depth on, so sums over the nodes of a
   subtree become sums over the members of its top: each member that is not the owner adds the text of its turns
   before its own depth, and each leaf counts with its owner. Nothing walks the trie level by level.

Every sum is an aggregation with partial sums per task, so a turn that all conversations start with is one row a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import written
from folioforge.operators.skew import salted_join

#: Most turns of a head; a conversation's head has crc32(conv_id) modulo one more.
MOST_HEAD = 5
#: Conversations of one base.
FAMILY = 100
#: The prime of the fingerprints and their independent lanes, each with its own base.
PRIME, LANES = (1 << 31) - 1, 4
#: Ids that are joined into one piece of text.
PIECE = 1 << 14
#: Powers of a base are products of two tables; the size of the first.
_TABLE = 4096

G = [f"g{k}" for k in range(LANES)]
W = [f"w{k}" for k in range(LANES)]
NODE = ["depth", "a", "b"]
_TURNS = ", ".join(["part int, conv long, pos long, chars long, upto long, c1 long, c2 long", *[f"{c} long" for c in G + W]])
_PIECES = "depth long, a long, b long, part int, no long, ids string"


def bases(attempt: int) -> list[int]:
    """One base per lane, other ones for each attempt."""
    return [2 + xxhash.xxh64_intdigest(f"{attempt}:{k}") % (PRIME - 3) for k in range(LANES)]


class Powers:
    """Powers of one base modulo the prime, by the numbers of an array."""

    def __init__(self, base: int):
        self.low = self._table(base, _TABLE)
        self.step = pow(base, _TABLE, PRIME)
        self.high = self._table(self.step, 2)

    @staticmethod
    def _table(base: int, size: int) -> np.ndarray:
        out = np.ones(size, np.int64)
        for i in range(1, size):
            out[i] = out[i - 1] * base % PRIME
        return out

    def of(self, n: np.ndarray) -> np.ndarray:
        q, r = np.divmod(n, _TABLE)
        if len(q) and q.max() >= len(self.high):
            self.high = self._table(self.step, 2 * int(q.max()) + 2)
        return self.high[q] * self.low[r] % PRIME


def _folder(chosen: list[int]):
    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each turn with its place and the element of all turns up to it, within its partition."""
        part = TaskContext.get().partitionId()
        powers = [Powers(b) for b in chosen]
        conv, done, chars_done, sums = None, 0, 0, [0] * LANES
        for batch in batches:
            n = len(batch)
            if not n:
                continue
            convs, chars = batch["conv"].to_numpy(), batch["chars"].to_numpy()
            fresh = np.concatenate(([convs[0] != conv], convs[1:] != convs[:-1]))
            group = np.cumsum(fresh)
            # rows before the turn's conversation in this batch; a conversation that goes on has group 0
            starts = np.concatenate(([0], np.flatnonzero(fresh)))
            goes_on = group == 0
            first = starts[group]
            pos = np.arange(1, n + 1) - first + np.where(goes_on, done, 0)

            def running(values: np.ndarray, before: int) -> np.ndarray:
                total = np.concatenate(([0], np.cumsum(values)))
                return total[1:] - total[first] + np.where(goes_on, before, 0)

            out = {"part": part, "conv": convs, "pos": pos, "chars": chars, "upto": running(chars, chars_done)}
            out |= {"c1": batch["c1"], "c2": batch["c2"]}
            content = [batch["c1"].to_numpy(), batch["c2"].to_numpy()]
            for k in range(LANES):
                symbol = (content[k % 2] >> (29 * (k // 2))) % PRIME
                weight = symbol * powers[k].of(pos) % PRIME
                out[W[k]] = weight
                out[G[k]] = running(weight, sums[k]) % PRIME
            conv, done, chars_done = convs[-1], int(pos[-1]), int(out["upto"][-1])
            sums = [int(out[g][-1]) for g in G]
            yield pd.DataFrame(out)[["part", "conv", "pos", "chars", "upto", "c1", "c2", *G, *W]]

    return fold


def _content(df: DataFrame) -> DataFrame:
    """Rows with a conversation, with the order of a turn, the size of its text and 120 bits of its SHA-256."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    known = df.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), "turn", role.alias("role"), F.substring(text, 1, 32).alias("start"),
        F.char_length(text).cast("long").alias("chars"), digest.alias("digest"),
    )
    halves = [F.conv(F.substring("digest", at, 15), 16, 10).cast("long") for at in (1, 16)]
    return known.withColumns({"c1": halves[0], "c2": halves[1]}).drop("digest")


def _mod(value: Column) -> Column:
    return F.pmod(value, F.lit(PRIME))


def numbered_turns(df: DataFrame, attempt: int = 0) -> DataFrame:
    """(conv, pos, chars, upto, c1, c2, lanes of the prefix element and of the turn's own term)."""
    order = ["conv", "turn", "role", "start", "c1", "c2"]
    ordered = _content(df).repartitionByRange(*order).sortWithinPartitions(*order)
    folded = written(ordered.select("conv", "chars", "c1", "c2").mapInPandas(_folder(bases(attempt)), _TURNS), "turns")
    # one row per partition, then at most two
    ends = folded.groupBy("part").agg(F.min("conv").alias("low"), F.max("conv").alias("high"))
    outer = folded.join(F.broadcast(ends), "part").filter("conv = low or conv = high")
    parts = outer.groupBy("part", "conv").agg(F.max(F.struct("pos", "upto", *G)).alias("e")).select("part", "conv", "e.*").collect()
    moved, held, before, table = bases(attempt), None, (0, 0, *[0] * LANES), []
    for r in sorted(parts, key=lambda r: (r["part"], r["conv"])):
        own = (r["pos"], r["upto"], *[r[g] for g in G])
        if r["conv"] == held:
            steps = [pow(b, before[0], PRIME) for b in moved]
            table.append((r["part"], held, *before, *steps))
            own = (before[0] + own[0], before[1] + own[1], *[(x + s * y) % PRIME for x, s, y in zip(before[2:], steps, own[2:], strict=True)])
        held, before = r["conv"], own
    if not table:
        return folded
    schema = ", ".join(["part int, conv long, n0 long, u0 long", *[f"x{k} long" for k in range(LANES)], *[f"s{k} long" for k in range(LANES)]])
    # at most one row per partition
    carried = folded.join(F.broadcast(df.sparkSession.createDataFrame(table, schema)), ["part", "conv"], "left")
    zero, one = F.lit(0), F.lit(1)
    return carried.select(
        "part", "conv", (F.col("pos") + F.coalesce("n0", zero)).alias("pos"), "chars", (F.col("upto") + F.coalesce("u0", zero)).alias("upto"), "c1", "c2",
        *[_mod(F.coalesce(f"x{k}", zero) + F.coalesce(f"s{k}", one) * F.col(G[k])).alias(G[k]) for k in range(LANES)],
        *[_mod(F.coalesce(f"s{k}", one) * F.col(W[k])).alias(W[k]) for k in range(LANES)],
    )


def head_size(conv: Column) -> Column:
    return (F.crc32(conv.cast("string")) % (MOST_HEAD + 1)).cast("int")


def _packed(lanes: list[Column], first: str, second: str) -> list[Column]:
    """Lanes of 31 bits, two in a column."""
    a, b = ((F.shiftleft(lanes[k], 31) + lanes[k + 1]) for k in (0, 2))
    return [a.alias(first), b.alias(second)]


def _rebuilt(turns: DataFrame, attempt: int) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations and their member rows of depth 1 and more."""
    head = head_size(F.col("conv"))
    at_head = [F.max(F.when(F.col("pos") == head, F.col(c))).alias(f"h_{c}") for c in ("upto", *G)]
    own = turns.groupBy("conv").agg(F.max("pos").alias("n"), F.max("upto").alias("total"), *at_head)
    # at most MOST_HEAD turns
    stored = F.sort_array(F.collect_list(F.struct("pos", "chars", "upto", "c1", "c2", *G, *W))).alias("head")
    starts = turns.filter((F.col("pos") <= MOST_HEAD) & (F.col("conv") % FAMILY == 0))
    starts = starts.groupBy(F.col("conv").alias("base")).agg(stored)
    convs = own.withColumn("base", F.col("conv") - F.col("conv") % FAMILY).join(starts, "base", "left")
    convs = convs.withColumn("h", head).withColumn("k", F.least("h", F.coalesce(F.size("head"), F.lit(0))))
    last = F.when(F.col("k") > 0, F.get("head", F.col("k") - 1))
    goes_on = F.col("n") > F.col("h")
    zero = F.lit(0).cast("long")
    convs = convs.select(
        "conv", "base", "h", (F.col("h") - F.col("k")).alias("moved"), F.slice("head", F.lit(1), F.col("k")).alias("head"),
        (F.col("k") + F.greatest(F.col("n") - F.col("h"), zero)).alias("size"),
        *[F.coalesce(last[c], zero).alias(f"b_{c}") for c in ("upto", *G)],
        *[F.coalesce(f"h_{c}", zero).alias(f"h_{c}") for c in ("upto", *G)],
        (F.coalesce(last["upto"], zero) + F.when(goes_on, F.col("total") - F.coalesce("h_upto", zero)).otherwise(zero)).alias("total"),
    )
    convs = written(convs, "rebuilt")

    suffix = turns.filter(F.col("pos") > head).join(convs.drop("head"), "conv")
    back = [F.array(*[F.lit(pow(b, -e, PRIME)) for e in range(MOST_HEAD + 1)])[F.col("moved")] for b in bases(attempt)]
    prints = [_mod(F.col(f"b_{g}") + back[k] * _mod(F.col(g) - F.col(f"h_{g}"))) for k, g in enumerate(G)]
    parents = [_mod(p - _mod(back[k] * F.col(W[k]))) for k, p in enumerate(prints)]
    depth = (F.col("pos") - F.col("moved")).alias("depth")
    upto = (F.col("b_upto") + F.col("upto") - F.col("h_upto")).alias("upto")
    own_rows = suffix.select(
        "conv", "size", depth, *_packed(prints, "a", "b"), *_packed(parents, "pa", "pb"), "chars", upto, "c1", "c2",
        F.col("conv").alias("turn_conv"), F.col("pos").alias("turn_pos"),
    )
    heads = convs.select("conv", "base", "size", F.inline("head"))
    head_rows = heads.select(
        "conv", "size", F.col("pos").alias("depth"), *_packed([F.col(g) for g in G], "a", "b"),
        *_packed([_mod(F.col(g) - F.col(w)) for g, w in zip(G, W, strict=True)], "pa", "pb"),
        "chars", "upto", "c1", "c2", F.col("base").alias("turn_conv"), F.col("pos").alias("turn_pos"),
    )
    return convs, written(own_rows.unionByName(head_rows), "members")


def _nodes(convs: DataFrame, members: DataFrame) -> DataFrame:
    """Nodes with their owner; ``same`` is false where fingerprints hide different turns or parents."""
    lead = F.min(F.struct("conv", "size")).alias("lead")
    alike = [F.min(c) == F.max(c) for c in ("pa", "pb", "c1", "c2")]
    shown = ["n_convs", "lead.conv as conv_id", "lead.size as owner_size", "deepest"]
    found = members.groupBy(*NODE).agg(
        F.count(F.lit(1)).alias("n_convs"), lead, F.max("size").alias("deepest"), F.min("pa").alias("pa"), F.min("pb").alias("pb"),
        F.min("chars").alias("chars"), F.min("upto").alias("upto"), F.min(F.struct("turn_conv", "turn_pos")).alias("ref"),
        (alike[0] & alike[1] & alike[2] & alike[3]).alias("same"),
    )
    found = found.selectExpr(*NODE, *shown, "pa", "pb", "chars", "upto", "ref.turn_conv", "ref.turn_pos", "same")
    root = convs.agg(F.count(F.lit(1)).alias("n_convs"), lead, F.max("size").alias("deepest")).filter("n_convs > 0")
    zero, none = "cast(0 as long)", "cast(null as long)"
    root = root.selectExpr(
        *[f"{zero} as {c}" for c in NODE], *shown, f"{none} as pa", f"{none} as pb", f"{zero} as chars", f"{zero} as upto",
        f"{none} as turn_conv", f"{none} as turn_pos", "true as same",
    )
    return written(found.unionByName(root), "nodes")


def _id_pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Ids of rows that come sorted by node, joined by commas, at most ``PIECE`` in a piece."""
    part, no, node, ids = TaskContext.get().partitionId(), 0, None, []
    for batch in batches:
        out = []
        for *own, conv in zip(*(batch[c] for c in NODE), batch["conv"], strict=True):
            if own != node or len(ids) == PIECE:
                if ids:
                    out.append((*node, part, no, ",".join(ids)))
                    no += 1
                node, ids = own, []
            ids.append(str(conv))
        yield pd.DataFrame(out, columns=[*NODE, "part", "no", "ids"])
    if ids:
        yield pd.DataFrame([(*node, part, no, ",".join(ids))], columns=[*NODE, "part", "no", "ids"])


def _id_digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of the pieces of each node, which come in order; nothing but the hash is held."""
    node, digest = None, None
    for batch in batches:
        out = []
        for *own, ids in zip(*(batch[c] for c in NODE), batch["ids"], strict=True):
            if own == node:
                digest.update(b",")
            else:
                if digest:
                    out.append((*node, digest.hexdigest()))
                node, digest = own, hashlib.sha256()
            digest.update(ids.encode())
        yield pd.DataFrame(out, columns=[*NODE, "ends_sha256"])
    if digest:
        yield pd.DataFrame([(*node, digest.hexdigest())], columns=[*NODE, "ends_sha256"])


def _ends(convs: DataFrame, members: DataFrame) -> DataFrame:
    """Per node at which conversations end: SHA-256 of their ids, ascending and joined by commas."""
    zero = F.lit(0).cast("long")
    turnless = convs.filter("size = 0").select(*[zero.alias(c) for c in NODE], "conv")
    ends = members.filter("depth = size").select(*NODE, "conv").unionByName(turnless)
    pieces = ends.repartitionByRange(*NODE, "conv").sortWithinPartitions(*NODE, "conv").mapInPandas(_id_pieces, _PIECES)
    pieces = written(pieces, "pieces").repartition(*NODE).sortWithinPartitions(*NODE, "part", "no")
    return pieces.select(*NODE, "ids").mapInPandas(_id_digests, "depth long, a long, b long, ends_sha256 string")


def _measured(convs: DataFrame, members: DataFrame, nodes: DataFrame) -> DataFrame:
    first = F.min(F.struct("depth", (F.col("upto") - F.col("chars")).alias("before"), "a", "b", "pa", "pb")).alias("first")
    leaf = F.max((F.col("deepest") == F.col("depth")).cast("long")).alias("leaf")
    alone = F.min(F.when(F.col("n_convs") == 1, F.col("depth"))).alias("alone")
    owners = written(nodes.groupBy(F.col("conv_id").alias("conv")).agg(first, leaf, alone), "owners")
    top = nodes.filter("depth = 0").first()

    begun = owners.filter("first.depth > 0").select(
        F.struct((F.col("first.depth") - 1).alias("depth"), F.col("first.pa").alias("a"), F.col("first.pb").alias("b")).alias("node"), "first"
    )
    # children whose owner does not own the parent: they come to the parent, and its owner to them
    zero = F.lit(0).cast("long")
    facts = ["children", "leaves", "saved", "parent_conv_id"]

    def fact(df: DataFrame, node: list, **values: Column) -> DataFrame:
        return df.select(*node, *[values.get(f, F.lit(None).cast("long")).alias(f) for f in facts])

    under = begun.filter("node.depth > 0")
    parents = nodes.select(F.struct(*NODE).alias("node"), F.col("conv_id").alias("parent"))
    met = salted_join(under, parents, "node")
    own_node = [F.col(f"first.{c}").alias(c) for c in NODE]
    counted = begun.groupBy("node.depth", "node.a", "node.b").agg(F.count(F.lit(1)).alias("n"))

    attributes = convs.select("conv", "size", "total").join(owners, "conv", "left")
    since = F.coalesce("first.depth", F.col("size") + 1).alias("since")
    before = F.coalesce("first.before", "total").alias("before")
    attributes = attributes.select(
        "conv", since, before, F.coalesce("leaf", zero).alias("leaf"), F.coalesce("alone", F.col("size") + 1).alias("alone")
    )
    attributes = written(attributes, "attributes")
    # the owner adds nothing; prefixes of one conversation are leaves or lead to one
    shared = members.select("conv", *NODE, (F.col("upto") - F.col("chars")).alias("upto")).join(attributes, "conv").filter("depth < alone")
    added = F.when(F.col("since") > F.col("depth"), F.col("before") - F.col("upto")).otherwise(zero)
    sums = shared.groupBy(*NODE).agg(F.sum("leaf").alias("l"), F.sum(added).alias("s"))
    whole = attributes.agg(F.sum("leaf").alias("l"), F.sum(F.when(F.col("since") > 0, F.col("before")).otherwise(zero)).alias("s"))
    whole = whole.filter("l is not null").select(*[zero.alias(c) for c in NODE], "l", "s")

    same_owner = F.when(F.col("depth") > 0, F.col("conv_id"))
    rows = [
        fact(counted, NODE, children=F.col("n")),
        fact(sums, NODE, leaves=F.col("l"), saved=F.col("s")),
        fact(whole, NODE, leaves=F.col("l"), saved=F.col("s")),
        fact(met, own_node, parent_conv_id=F.col("parent")),
    ]
    if top is not None:
        rows.append(fact(begun.filter("node.depth = 0"), own_node, parent_conv_id=F.lit(top["conv_id"]).cast("long")))
    facts_of = rows[0]
    for more in rows[1:]:
        facts_of = facts_of.unionByName(more)
    facts_of = facts_of.groupBy(*NODE).agg(*[F.max(f).alias(f) for f in facts])
    joined = nodes.join(facts_of, NODE, "left")
    goes_on = (F.col("owner_size") > F.col("depth")).cast("long")
    return joined.select(
        *NODE, "conv_id", F.coalesce("parent_conv_id", same_owner).alias("parent_conv_id"), "n_convs",
        (F.coalesce("children", zero) + goes_on).alias("n_children"), F.coalesce("leaves", F.lit(1).cast("long")).alias("n_leaves"),
        F.coalesce("saved", zero).alias("saved_tokens"), "turn_conv", "turn_pos",
    )


def trie(df: DataFrame) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations of ``df`` (conv_id, turn, role, text).

    A conversation c is rebuilt from the first h turns of conversation c - c % 100, or as many as there are, and its
    own turns after its first h, where h = crc32 of its decimal id modulo 6. Columns: conv_id (smallest member),
    depth, parent_conv_id (null at the root), n_convs, n_children, n_leaves, saved_tokens (over the subtree: members
    beyond the first, times the code points of the last text), ends_sha256 (ids of members that end here), and
    turn_conv, turn_pos: the stored turn that the node's last turn equals.

    Turns are ordered by number, null first, then by role, the first 32 characters of the text, and a hash of both;
    repeated rows are repeated turns. Null role or text is empty. Rows without conv_id belong to no conversation and
    are left out. Other columns are not looked at. An empty table gives no node.
    """
    for attempt in count():
        convs, members = _rebuilt(numbered_turns(df, attempt), attempt)
        nodes = _nodes(convs, members)
        if nodes.filter("not same").isEmpty():
            break
    measured = _measured(convs, members, nodes)
    ended = measured.join(_ends(convs, members), NODE, "left")
    none = hashlib.sha256().hexdigest()
    return ended.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"), "turn_conv", "turn_pos",
    )
