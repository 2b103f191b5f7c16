"""Data quality: null shares, duplicates, invalid values, rejects, orphans, schema checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def null_shares(df: DataFrame, limits: Mapping[str, float]) -> DataFrame:
    """Null share of each column against its limit, in one pass."""
    counted = df.agg(
        F.count("*").alias("row_count"),
        *(F.count_if(F.col(c).isNull()).alias(f"_{c}") for c in limits),
    )
    per_column = F.array(
        *(
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"_{c}").alias("null_count"),
                F.lit(float(limit)).alias("max_null_share"),
            )
            for c, limit in limits.items()
        )
    )
    share = F.try_divide("null_count", "row_count")
    return counted.select("row_count", F.inline(per_column)).select(
        "column_name",
        "row_count",
        "null_count",
        share.alias("null_share"),
        "max_null_share",
        F.coalesce(share > F.col("max_null_share"), F.lit(False)).alias("is_breached"),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def invalid_dates(df: DataFrame, column: str) -> DataFrame:
    """Rows whose date text is missing or no date."""
    return df.where(F.try_to_date(F.col(column)).isNull())


def unknown_references(df: DataFrame, reference: DataFrame, key: str) -> DataFrame:
    """Rows whose key is null or absent from the reference."""
    return df.join(reference.select(key), key, "left_anti")


def orphan_keys(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Fact keys without a dimension row, and how many facts each one has.

    Facts are counted per key before they are shuffled to the dimension.
    """
    counted = facts.groupBy(key).agg(F.count("*").alias("fact_count"))
    return counted.join(dimension.select(key).distinct(), key, "left_anti")


def with_reject_reasons(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add ``reject_reasons``: names of the broken rules. A rule that yields null counts as broken."""
    broken = F.array_compact(
        F.array(*(F.when(F.coalesce(~ok, F.lit(True)), F.lit(name)) for name, ok in rules.items()))
    )
    return df.withColumn("reject_reasons", broken)


def split_rejects(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected); together they hold every input row."""
    judged = with_reject_reasons(df, rules)
    clean = F.size("reject_reasons") == 0
    return judged.where(clean).drop("reject_reasons"), judged.where(~clean)


class Violation(NamedTuple):
    column: str
    problem: str


def schema_violations(found: T.StructType, expected: T.StructType) -> list[Violation]:
    """Missing, unexpected and differently typed columns."""
    have = {f.name: f.dataType.simpleString() for f in found}
    want = {f.name: f.dataType.simpleString() for f in expected}
    problems = []
    for name in sorted({*have, *want}):
        if name not in have:
            problems.append(Violation(name, "missing"))
        elif name not in want:
            problems.append(Violation(name, "unexpected"))
        elif have[name] != want[name]:
            problems.append(Violation(name, f"is {have[name]}, expected {want[name]}"))
    return problems


def project_to(df: DataFrame, declared: T.StructType) -> DataFrame:
    """Exactly the declared columns: missing ones become typed nulls, others are left out."""
    have = set(df.columns)
    return df.select(
        *(
            F.col(f.name).try_cast(f.dataType).alias(f.name)
            if f.name in have
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in declared
        )
    )
