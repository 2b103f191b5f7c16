"""Consistent hashing with bounded loads.

A ring of ``CELLS`` positions carries the virtual nodes of every shard. A key hashes to a cell and belongs to
the first shard clockwise that is not full; a full shard passes its keys on clockwise. Keys enter cell by
cell in a fixed shuffled order and within a cell by hash, so the outcome is that of inserting the keys one by
one, although only the number of keys per cell has to be known: ``CELLS`` numbers for any amount of rows. A
cell that fills a shard is cut at the rank where the shard became full.
"""

from __future__ import annotations

import bisect
import math
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from folioforge.llm.common import boxed, of, unboxed

#: Positions of the ring: what is collected and broadcast has at most so many rows, plus one per shard.
CELLS = 1 << 16
REPLICAS = 128

PIECES = T.StructType(
    [
        T.StructField("_cell", T.IntegerType(), False),
        T.StructField("_first", T.LongType(), False),
        T.StructField("_last", T.LongType(), False),
        T.StructField("shard", T.IntegerType(), False),
        T.StructField("_slot", T.LongType(), False),
    ]
)


def ring(shards: int, replicas: int = REPLICAS) -> tuple[list[int], list[int]]:
    """Positions of the virtual nodes in ring order, and the shard of each.

    A node's position depends on its own shard and number only, so a new shard moves no other node.
    """
    nodes = sorted(
        (zlib.crc32(f"shard {s} node {r}".encode()) % CELLS, s, r) for s in range(shards) for r in range(replicas)
    )
    return [n[0] for n in nodes], [n[1] for n in nodes]


def capacities(total: int, shards: int, slack: float = 0.0) -> list[int]:
    """Most rows a shard may take. Without slack they add up to ``total``, so counts are one apart at most."""
    if slack:
        return [math.ceil((1 + slack) * total / shards)] * shards
    return [total // shards + (s < total % shards) for s in range(shards)]


def place(counts: dict[int, int], shards: int, slack: float = 0.0, replicas: int = REPLICAS) -> list[tuple]:
    """Pieces (cell, first rank, last rank, shard, slot of the first rank) of all non-empty cells."""
    room = capacities(sum(counts.values()), shards, slack)
    positions, owners = ring(shards, replicas)
    used, pieces = [0] * shards, []
    for cell in sorted(counts, key=lambda c: (zlib.crc32(b"cell %d" % c), c)):
        at, rank, left = bisect.bisect_left(positions, cell), 0, counts[cell]
        while left:
            shard = owners[at % len(owners)]
            taken = min(left, room[shard] - used[shard])
            if taken > 0:
                pieces.append((cell, rank, rank + taken - 1, shard, used[shard]))
                used[shard] += taken
                rank, left = rank + taken, left - taken
            at += 1
    return pieces


def size_of(text: Column) -> Column:
    """UTF-8 bytes plus 1; a null text has no bytes."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(1).cast("long")


def shard_rows(
    spark: SparkSession,
    df: DataFrame,
    shards: int,
    key: str = "doc_id",
    text: str = "text",
    slack: float = 0.0,
    replicas: int = REPLICAS,
) -> DataFrame:
    """All columns and rows of ``df`` with ``shard`` (int) and ``slot`` (long, gapless from 0 in a shard).

    Rows without a key are placed by their text, so that they spread. Repeated rows are separate rows in
    neighbouring slots. Null and empty texts are placed like any other. An empty table stays empty. Columns
    named ``shard`` or ``slot`` are replaced.
    """
    named = F.col(f"`{key}`")
    placed = F.when(named.isNull(), F.xxhash64(F.lit("no key"), F.col(f"`{text}`"))).otherwise(F.xxhash64(named))
    cell_of = F.pmod(placed, F.lit(CELLS)).cast("int")
    counts = {r["_cell"]: r["count"] for r in df.groupBy(cell_of.alias("_cell")).count().collect()}
    pieces = spark.createDataFrame(place(counts, shards, slack, replicas), PIECES)
    box = boxed(df.withColumns({"_placed_": placed, "_cell_": cell_of}))
    order = Window.partitionBy("_cell").orderBy("_placed", F.xxhash64(of(text)), F.octet_length(of(text)))
    ranked = box.select(
        "_row", of("_cell_").alias("_cell"), of("_placed_").alias("_placed")
    ).withColumn("_rank", (F.row_number().over(order) - 1).cast("long"))
    # at most CELLS + shards rows, whatever the size of the table
    joined = ranked.join(
        F.broadcast(pieces),
        (ranked["_cell"] == pieces["_cell"]) & F.col("_rank").between(F.col("_first"), F.col("_last")),
    )
    slot = (F.col("_slot") + F.col("_rank") - F.col("_first")).alias("slot")
    return unboxed(joined, df.columns, F.col("shard"), slot)
