"""Valid time and system time: stamps and half-open as-of predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.params import OPEN_END_TS


def ts(value: str) -> Column:
    return F.lit(value).cast("timestamp")


def open_end() -> Column:
    return ts(OPEN_END_TS)


def stamp(
    df: DataFrame,
    valid_from: str | Column,
    system_from: str | Column,
    valid_days: int | None = None,
) -> DataFrame:
    """Add the eight bi-temporal columns. ``valid_days`` closes the valid interval after that many days."""
    start = (F.col(valid_from) if isinstance(valid_from, str) else valid_from).cast("timestamp")
    system = ts(system_from) if isinstance(system_from, str) else system_from
    end = open_end() if valid_days is None else start + F.make_dt_interval(F.lit(valid_days))
    return df.withColumns(
        {
            "valid_from_ts": start,
            "valid_to_ts": end,
            "system_from_ts": system,
            "system_to_ts": open_end(),
            "is_current_valid": F.lit(True),
            "is_current_system": F.lit(True),
            "record_version": F.lit(1),
            "change_type": F.lit("INSERT"),
        }
    )


def covers(at: str | Column, start: str, end: str) -> Column:
    """``start <= at < end``."""
    moment = ts(at) if isinstance(at, str) else at
    return (F.col(start) <= moment) & (moment < F.col(end))


def valid_at(df: DataFrame, at: str) -> DataFrame:
    """What was true in the business at that moment."""
    return df.where(covers(at, "valid_from_ts", "valid_to_ts"))


def known_at(df: DataFrame, at: str) -> DataFrame:
    """What the platform had on record at that moment."""
    return df.where(covers(at, "system_from_ts", "system_to_ts"))


def as_of(df: DataFrame, valid_ts: str, system_ts: str) -> DataFrame:
    """What was believed at ``system_ts`` about ``valid_ts``."""
    return known_at(valid_at(df, valid_ts), system_ts)
