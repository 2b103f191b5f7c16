"""Preference formatting: shared turns once as the prompt, the rest as two masked completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Mark after a rendered turn.
CLOSE = "<|end|>\n"


def rendered(role: Column, text: Column) -> Column:
    empty = F.lit("")
    return F.concat(F.lit("<|"), F.coalesce(role, empty), F.lit("|>\n"), F.coalesce(text, empty), F.lit(CLOSE))


def format_pairs(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """Segments of preference examples, one row per rendered turn.

    ``turns`` has pair_id, side (0 chosen, 1 rejected), turn, role and text. The longest run of turns from
    the start that both sides share is rendered once with part ``prompt``; the other turns of each side have
    part ``chosen`` or ``rejected``. In order of turn the segments of a part concatenate to its text.
    ``is_target`` is the loss mask: true in completions for ``trained_role``, over the ``target_chars``
    characters of text and end mark that follow ``masked_chars`` masked ones.

    A null role or text renders as empty and equals another null only; a null turn comes first. Rows that
    repeat a (side, turn) all stay and are compared as a bag, by count and sums of two hashes. A pair with one side has no prompt. Equal sides
    make a prompt without completions. An empty table gives no rows. Other columns are dropped. No row
    gathers a conversation, so its length has no bound.
    """
    own = turns.select("pair_id", "side", "turn", "role", "text")
    said = [F.xxhash64("role", "text", F.col("role").isNull(), F.col("text").isNull()), F.xxhash64(F.lit(1), "text", "role")]
    per_side = []
    for side in (0, 1):
        here = F.col("side") == side
        per_side.append([F.count(F.when(here, 1)), *[F.sum(F.when(here, s.cast("decimal(20,0)"))) for s in said]])
    same = F.lit(True)
    for a, b in zip(*per_side, strict=True):
        same = same & a.eqNullSafe(b)
    places = own.groupBy("pair_id", "turn").agg(same.alias("same"))
    first = F.coalesce(F.col("turn").cast("long"), F.lit(-(2**63)))
    split = places.groupBy(F.col("pair_id").alias("_pair")).agg(F.min(F.when(~F.col("same"), first)).alias("_split"))
    joined = own.join(split, F.col("pair_id").eqNullSafe(F.col("_pair")))
    in_prompt = F.col("_split").isNull() | (first < F.col("_split"))
    target = ~in_prompt & F.col("role").eqNullSafe(F.lit(trained_role))
    segment = rendered(F.col("role"), F.col("text"))
    goal = F.length(F.coalesce("text", F.lit(""))) + F.lit(len(CLOSE))
    return joined.filter(~in_prompt | (F.col("side") == 0)).select(
        "pair_id",
        F.when(in_prompt, "prompt").when(F.col("side") == 0, "chosen").otherwise("rejected").alias("part"),
        "turn",
        "role",
        segment.alias("segment"),
        target.alias("is_target"),
        F.when(target, F.length(segment) - goal).otherwise(F.length(segment)).cast("long").alias("masked_chars"),
        F.when(target, goal).otherwise(0).cast("long").alias("target_chars"),
    )


def neighbours(conversations: DataFrame) -> DataFrame:
    """Conversations 2k and 2k + 1 as the chosen and the rejected side of pair k.

    Rows without conv_id belong to no conversation and are left out.
    """
    named = conversations.filter(F.col("conv_id").isNotNull())
    return named.select(
        F.floor(F.col("conv_id") / 2).cast("long").alias("pair_id"),
        F.pmod(F.col("conv_id"), F.lit(2)).cast("int").alias("side"),
        "turn",
        "role",
        "text",
    )


def swapped_replies(conversations: DataFrame, replier: str = "assistant") -> DataFrame:
    """Each conversation with its own last reply as the chosen side, and with its neighbour's as the rejected one.

    Neighbours are conversations 2k and 2k + 1; ``pair_id`` is the conversation's own id. The chosen side ends with the
    turn of the last reply, and the rejected side has all turns before it and, at that turn, the neighbour's last reply.
    So the turns before are shared, and equal replies make equal sides.

    Rows without conv_id belong to no conversation, and a reply needs a turn. Of several replies at the last turn the
    greatest text counts as the neighbour's, a null text being least; the chosen side keeps them all. Null turns come
    first, so both sides have them. A conversation without a reply, or whose neighbour has none, makes no pair, since
    nothing can be preferred; an empty table makes none. Other columns are dropped.
    """
    own = conversations.filter(F.col("conv_id").isNotNull()).select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    spoken = own.filter(F.col("turn").isNotNull() & (F.col("role") == replier))
    # one row a conversation; copies are reduced before the shuffle
    last = spoken.groupBy("pair_id").agg(F.max(F.struct("turn", "text")).alias("_last"))
    others = last.select(
        F.col("pair_id").bitwiseXOR(F.lit(1).cast("long")).alias("pair_id"), F.col("_last.text").alias("_other")
    )
    pairs = last.join(others, "pair_id").select("pair_id", F.col("_last.turn").alias("_end"), "_other")
    before = F.col("turn").isNull() | (F.col("turn") < F.col("_end"))
    sides = F.when(before, F.array(F.lit(0), F.lit(1))).when(F.col("turn") == F.col("_end"), F.array(F.lit(0)))
    said = own.join(pairs, "pair_id").select("pair_id", F.explode(sides).alias("side"), "turn", "role", "text")
    replies = pairs.select(
        "pair_id", F.lit(1).alias("side"), F.col("_end").alias("turn"), F.lit(replier).alias("role"), F.col("_other").alias("text")
    )
    return said.unionByName(replies)
