"""Equi join that spreads hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds at least this share of the large side, so there are at most 1000 of them.
HOT_SHARE = 0.001
# Slicing a key smaller than this saves nothing.
HOT_ROWS = 100_000


def hot_keys(df: DataFrame, key: str, min_rows: int = HOT_ROWS) -> DataFrame:
    """(key, ``_salts``): hot keys and the number of slices that bring each slice below the share."""
    keyed = df.where(F.col(key).isNotNull())
    counts = keyed.groupBy(key).agg(F.count("*").alias("_n"))
    total = keyed.agg(F.count("*")).scalar()
    share = F.col("_n") / total
    return counts.where((F.col("_n") >= min_rows) & (share >= HOT_SHARE)).select(
        key, F.ceil(share / HOT_SHARE).cast("int").alias("_salts")
    )


def salted_join(
    large: DataFrame,
    small: DataFrame,
    key: str,
    how: str = "inner",
    min_rows: int = HOT_ROWS,
    counted: DataFrame | None = None,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Join on ``key``: hot keys of ``large`` are cut into slices, their ``small`` rows are repeated.

    All other keys join as usual. The slice is a hash of the row, so a retried task cuts it the same way.
    The hot-key table has at most ``1 / HOT_SHARE`` rows, which bounds the broadcast. ``counted`` is a
    cheaper frame with the same keys to find them in, where ``large`` is itself the result of a join. ``spread_by``
    names columns that tell rows of a key apart, so that columns nobody asks for are not read for the hash.
    """
    hot = F.broadcast(hot_keys(large if counted is None else counted, key, min_rows))
    others = [c for c in large.columns if c != key] if spread_by is None else spread_by
    sliced = large.join(hot, key, "left").withColumn(
        "_slice",
        F.when(F.col("_salts").isNull(), 0)
        .otherwise(F.pmod(F.xxhash64(*others), F.col("_salts")))
        .cast("int"),
    )
    repeated = small.join(hot, key, "left").withColumn(
        "_slice",
        F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)),
    )
    return sliced.drop("_salts").join(repeated.drop("_salts"), [key, "_slice"], how).drop("_slice")


def lookup_join(df: DataFrame, reference: DataFrame, key: str, row_key: str) -> DataFrame:
    """Left join on a text ``key`` where rows without one match nothing and are spread by a hash of ``row_key``.

    A shuffled left join would send all null keys to one partition. Their place is taken by a text of their own in an
    added join key; the key itself stays in the condition, so such a text can match no reference row.
    """
    stand_in = F.concat(F.lit("\0"), F.xxhash64(row_key).cast("string"))
    spread = df.withColumn("_place", F.coalesce(F.col(key), stand_in))
    named = reference.withColumnRenamed(key, "_key")
    same = (F.col("_place") == F.col("_key")) & (F.col(key) == F.col("_key"))
    return spread.join(named, same, "left").drop("_place", "_key")
