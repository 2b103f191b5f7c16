"""Removal of repeated passages by windows of three consecutive lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import BLANKS, boxed, let, of, unboxed

#: Lines of a window.
SPAN = 3


def drop_repeated_windows(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows of ``df`` with the text less its repeated lines, ``n_lines`` and ``n_removed`` (long).

    Lines are the parts between line feeds, compared without the blanks around them. Every run of three
    lines that holds a word is a window. Of equal windows in all rows the first, by key and place, stays; the
    lines of later ones are removed, also where later ones overlap the first. Windows are judged on the
    input.

    A null text stays null and has no lines; a text of fewer than three lines has no window. Rows with equal
    keys are ordered by a hash of their text, a null key before all others; rows equal in key and text are
    one document, so they stay or go together. An empty table stays empty. Columns named ``n_lines`` or
    ``n_removed`` are replaced.
    """
    rows = boxed(df).withColumn("_id", F.xxhash64(of(key), of(text)))
    lines = F.transform(F.split(of(text), "\n"), lambda x: F.btrim(x, F.lit(BLANKS)))
    windows = rows.select("_id", of(key).alias("_key"), F.posexplode(let(lines, _windows)).alias("_at", "_w"))
    hashed = windows.filter("_w is not null").select("_id", "_key", "_at", "_w.*")
    place = F.struct("_key", "_id", "_at")
    repeated = hashed.groupBy("h", "g").agg(F.count(F.lit(1)).alias("_n"), F.min(place).alias("_first"))
    later = hashed.join(repeated.filter("_n > 1"), ["h", "g"]).filter(~place.eqNullSafe(F.col("_first")))
    gone = (
        later.select("_id", F.explode(F.sequence("_at", F.col("_at") + SPAN - 1)).alias("_line"))
        .groupBy("_id")
        .agg(F.collect_set("_line").alias("_gone"))
    )
    joined = rows.join(gone, "_id", "left").withColumn("_split", F.split(of(text), "\n"))
    kept = let(
        F.col("_split"),
        lambda ls: F.transform(
            F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), F.col("_gone")), lambda i: ls[i]
        ),
    )
    cleaned = F.when(F.col("_gone").isNull(), of(text)).otherwise(F.array_join(kept, "\n"))
    return unboxed(
        joined,
        df.columns,
        cleaned.alias(text),
        F.when(of(text).isNull(), 0).otherwise(F.size(F.split(of(text), "\n"))).cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"),
    ).select(*df.columns, *[c for c in ("n_lines", "n_removed") if c not in df.columns])


def _windows(lines: Column) -> Column:
    """Two 64-bit hashes of each window, null where it holds no word."""
    def at(i: Column) -> Column:
        parts = [lines[i + k] for k in range(SPAN)]
        hashes = F.struct(F.xxhash64(*parts).alias("h"), F.xxhash64(F.lit(1), *parts[::-1]).alias("g"))
        return F.when(F.concat(*parts) != "", hashes)

    starts = F.sequence(F.lit(0), F.size(lines) - SPAN)
    return F.when(F.size(lines) >= SPAN, F.transform(starts, at))
