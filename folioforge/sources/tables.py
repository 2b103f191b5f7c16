"""Parquet tables and month-bounded scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.session import configure


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{folder}/{name}.parquet")


def in_month(column: str, yyyymm: str) -> Column:
    """Half-open month range on the stored timestamp itself, so that Parquet can skip row groups."""
    year, month = int(yyyymm[:4]), int(yyyymm[4:])
    following = (year + month // 12, month % 12 + 1)
    return (F.col(column) >= F.expr(f"timestamp_ntz'{year:04d}-{month:02d}-01'")) & (
        F.col(column) < F.expr(f"timestamp_ntz'{following[0]:04d}-{following[1]:02d}-01'")
    )


def month_of(date: str | Column) -> Column:
    return F.date_format(date, "yyyyMM")


def within_lookback(date: str, as_of: str | Column, months: int) -> Column:
    """Dates in the ``months`` before ``as_of``, which is included."""
    end = F.to_date(F.lit(as_of)) if isinstance(as_of, str) else as_of
    return (F.col(date) > F.add_months(end, -months)) & (F.col(date) <= end)


def batch_of(spark: SparkSession, path: str, month: str) -> DataFrame:
    """One batch of a raw table partitioned by ``source_yyyymm``: the scan lists and reads that partition only."""
    return configure(spark).read.parquet(path).where(F.col("source_yyyymm") == month)
