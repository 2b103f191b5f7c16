"""Dense ordered keys, survivorship and version chains, each safe for hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.session import materialize

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def add_surrogate_key(
    df: DataFrame, order_by: Sequence[str], key: str, start_after: Column | None = None
) -> DataFrame:
    """Number rows 1..n in ``order_by`` order without moving them into one partition.

    Rows are range-partitioned and sorted, and written once with their (partition, row) position.
    Each partition then needs only the number of rows before it, a table with one row per partition.
    ``order_by`` must be unique.
    """
    placed = materialize(
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_pos", F.monotonically_increasing_id()),
        "surrogate-key",
    )
    part = F.shiftright("_pos", _ROW_BITS)
    before = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count("*").alias("_n"))
        .withColumn(
            "_before",
            F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
        )
        .select("_part", F.coalesce("_before", F.lit(0)).alias("_before"))
    )
    within = F.col("_pos").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    base = F.lit(0) if start_after is None else start_after
    # One row per partition of the range exchange: its size is bounded by the partition count.
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(before), "_part")
        .withColumn(key, (base + F.col("_before") + within + 1).cast("long"))
        .drop("_part", "_pos", "_before")
    )


def number_within(df: DataFrame, by: Sequence[str], order_by: Sequence[str], number: str) -> DataFrame:
    """Number the rows of each group 1..n in ``order_by`` order; no group has to fit into one task.

    Two levels of counts: rows are range-partitioned by group and order and written once with their place, so a group
    is a run of rows in one partition, or in several that follow each other. A row's number is its place in the run
    plus the group's rows in earlier partitions. Group columns must not be null.
    """
    placed = materialize(
        df.repartitionByRange(*by, *order_by)
        .sortWithinPartitions(*by, *order_by)
        .withColumn("_pos", F.monotonically_increasing_id()),
        "numbered",
    )
    placed = placed.withColumn("_part", F.shiftright("_pos", _ROW_BITS))
    runs = placed.groupBy(*by, "_part").agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # At most one row per partition in each window.
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    numbered = placed.join(runs, [*by, "_part"])
    return numbered.withColumn(number, F.col("_pos") - F.col("_first") + F.col("_before") + 1).select(*df.columns, number)


def latest_per_key(df: DataFrame, keys: Sequence[str], latest_by: Sequence[str]) -> DataFrame:
    """One surviving row per business key: the greatest by ``latest_by``, then by all other columns.

    An aggregate, not a window: copies of a hot key are reduced before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys and c not in latest_by]
    winner = F.max(F.struct(*latest_by, *rest)).alias("_w")
    return df.groupBy(*keys).agg(winner).select(*keys, "_w.*").select(*df.columns)


def version_chain(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], bucket: Column
) -> DataFrame:
    """Add ``version_no`` and ``next_from`` (first order column of the following version).

    Rows are chained within (key, bucket), and buckets are chained through one summary row each, so
    a hot key is spread over its buckets. ``bucket`` must not decrease along ``order_by``, and
    ``order_by`` must be unique within a key.
    """
    grouped = df.withColumn("_bucket", bucket)
    by_bucket = [*keys, "_bucket"]
    heads = (
        grouped.groupBy(*by_bucket)
        .agg(F.count("*").alias("_n"), F.min(order_by[0]).alias("_head"))
        .withColumns(
            {
                "_earlier": F.coalesce(
                    F.sum("_n").over(
                        Window.partitionBy(*keys)
                        .orderBy("_bucket")
                        .rowsBetween(Window.unboundedPreceding, -1)
                    ),
                    F.lit(0),
                ),
                "_next_head": F.lead("_head").over(Window.partitionBy(*keys).orderBy("_bucket")),
            }
        )
        .select(*by_bucket, "_earlier", "_next_head")
    )
    inside = Window.partitionBy(*by_bucket).orderBy(*order_by)
    return (
        grouped.withColumns(
            {"_rn": F.row_number().over(inside), "_lead": F.lead(order_by[0]).over(inside)}
        )
        .join(heads, by_bucket)
        .withColumns(
            {
                "version_no": (F.col("_earlier") + F.col("_rn")).cast("int"),
                "next_from": F.coalesce("_lead", "_next_head"),
            }
        )
        .drop("_bucket", "_rn", "_lead", "_earlier", "_next_head")
    )
