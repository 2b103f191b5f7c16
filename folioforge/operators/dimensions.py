"""Dimensions: type-2 history as an append-only version log, static snapshots, calendar."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions.hashing import tracking_hash
from folioforge.functions.temporal import open_end, stamp, ts
from folioforge.operators.keys import add_surrogate_key, latest_per_key
from folioforge.operators.skew import salted_join
from folioforge.params import OPEN_END_DT


def one_row_per_key(snapshot: DataFrame, business_key: str) -> DataFrame:
    """Repeated business keys in a snapshot: the greatest row survives, on every run the same one."""
    return latest_per_key(snapshot, [business_key], [])


def detect_changes(
    snapshot: DataFrame, current: DataFrame, business_key: str, surrogate_key: str, tracked: Sequence[str]
) -> DataFrame:
    """Snapshot rows that are new or whose tracked attributes changed.

    ``existing_sk`` and ``existing_version`` are null for new keys. Rows replayed unchanged vanish.
    """
    hashed = one_row_per_key(snapshot, business_key).withColumn("attribute_hash", tracking_hash(tracked))
    known = current.select(
        business_key,
        F.col(surrogate_key).alias("existing_sk"),
        F.col("record_version").alias("existing_version"),
        F.col("attribute_hash").alias("_known_hash"),
    )
    return (
        hashed.join(known, business_key, "left")
        .where(~F.col("attribute_hash").eqNullSafe(F.col("_known_hash")))
        .drop("_known_hash")
    )


def new_versions(
    snapshot: DataFrame,
    log: DataFrame | None,
    business_key: str,
    surrogate_key: str,
    tracked: Sequence[str],
    as_of_ts: str,
) -> DataFrame:
    """Versions to append to ``log``; with no log yet, the initial load."""
    if log is None:
        changes = (
            one_row_per_key(snapshot, business_key)
            .withColumn("attribute_hash", tracking_hash(tracked))
            .withColumns({"existing_sk": F.lit(None).cast("long"), "existing_version": F.lit(None).cast("int")})
        )
        highest = None
    else:
        changes = detect_changes(
            snapshot, latest_versions(log, business_key), business_key, surrogate_key, tracked
        )
        highest = log.agg(F.coalesce(F.max(surrogate_key), F.lit(0))).scalar()
    numbered = add_surrogate_key(changes, [business_key, "attribute_hash"], surrogate_key, highest)
    return numbered.select(
        surrogate_key,
        business_key,
        *tracked,
        "attribute_hash",
        ts(as_of_ts).alias("system_from_ts"),
        (F.coalesce("existing_version", F.lit(0)) + 1).cast("int").alias("record_version"),
        F.when(F.col("existing_sk").isNull(), "INSERT").otherwise("UPDATE").alias("change_type"),
    )


def latest_versions(log: DataFrame, business_key: str) -> DataFrame:
    """The newest version of each key: an aggregate, so nothing is sorted."""
    return latest_per_key(log, [business_key], ["system_from_ts", "record_version"])


def dimension_view(log: DataFrame, business_key: str) -> DataFrame:
    """Close every version where its successor starts and derive all current flags.

    A key has at most one version per load, so its window is bounded by the number of loads. The end
    of one version equals the start of the next: no moment is left without a version.
    """
    chain = Window.partitionBy(business_key).orderBy("system_from_ts", "record_version")
    successor = F.lead("system_from_ts").over(chain)
    return (
        log.withColumn("_next", successor)
        .withColumns(
            {
                "is_current": F.col("_next").isNull(),
                "effective_from_dt": F.to_date("system_from_ts"),
                "effective_to_dt": F.when(
                    F.col("_next").isNotNull(),
                    F.greatest(F.to_date("system_from_ts"), F.date_sub(F.to_date("_next"), 1)),
                ).otherwise(F.lit(OPEN_END_DT).cast("date")),
                "valid_from_ts": F.col("system_from_ts"),
                "valid_to_ts": F.coalesce("_next", open_end()),
                "system_to_ts": F.coalesce("_next", open_end()),
                "is_current_valid": F.col("_next").isNull(),
                "is_current_system": F.col("_next").isNull(),
                "change_type": F.when(F.col("_next").isNull(), F.col("change_type")).otherwise("EXPIRE"),
            }
        )
        .drop("_next")
    )


def is_current() -> Column:
    return F.col("is_current") & F.col("is_current_valid") & F.col("is_current_system")


def current_reference(dimension: DataFrame, business_key: str, surrogate_key: str) -> DataFrame:
    return dimension.where(is_current()).select(business_key, surrogate_key)


def static_dimension(
    snapshot: DataFrame, business_key: str, surrogate_key: str, as_of_ts: str
) -> DataFrame:
    """Rebuilt from each snapshot; keys follow the order of the business key; nothing is tracked."""
    numbered = add_surrogate_key(one_row_per_key(snapshot, business_key), [business_key], surrogate_key)
    dated = numbered.withColumns(
        {
            "effective_from_dt": F.to_date(ts(as_of_ts)),
            "effective_to_dt": F.lit(OPEN_END_DT).cast("date"),
            "is_current": F.lit(True),
            "attribute_hash": F.lit(None).cast("string"),
        }
    )
    return stamp(dated, "effective_from_dt", as_of_ts)


def calendar(bounds: DataFrame, as_of_ts: str) -> DataFrame:
    """One row per day from ``first_dt`` to ``last_dt`` of the one-row ``bounds``."""
    day = F.col("calendar_dt")
    days = bounds.select(
        F.explode(F.sequence("first_dt", "last_dt", F.expr("interval 1 day"))).alias("calendar_dt")
    )
    # The calendar is bounded by the date range, a few rows per year.
    described = days.select(
        day,
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_sk"),
        F.year(day).alias("year_num"),
        F.quarter(day).alias("quarter_num"),
        F.month(day).alias("month_num"),
        F.dayofmonth(day).alias("day_num"),
        (F.last_day(day) == day).alias("is_month_end"),
        F.weekday(day).between(0, 4).alias("is_business_day"),
        F.lit(None).cast("string").alias("attribute_hash"),
    )
    return stamp(described, "calendar_dt", as_of_ts)


def join_as_of(facts: DataFrame, dimension: DataFrame, business_key: str, moment: Column) -> DataFrame:
    """Attach the version whose system interval covers the moment of the fact.

    Versions are gathered into one row per key (bounded by the number of loads), so each fact meets one
    row instead of every version of its key, and hot keys are sliced.
    """
    attributes = [c for c in dimension.columns if c != business_key]
    per_key = dimension.groupBy(business_key).agg(
        F.collect_list(F.struct(*attributes)).alias("_versions")
    )
    covering = F.filter(
        "_versions",
        lambda v: (v["system_from_ts"] <= F.col("_moment")) & (F.col("_moment") < v["system_to_ts"]),
    )
    joined = salted_join(facts.withColumn("_moment", moment), per_key, business_key, "left")
    return joined.withColumn("version", F.get(covering, F.lit(0))).drop("_versions", "_moment")



def history_of_snapshots(
    snapshots: DataFrame, business_key: str, tracked: Sequence[str]
) -> DataFrame:
    """Type-2 history of dated snapshots in one pass, for backfills.

    ``snapshots`` has one row per key and ``system_from_ts``; a version starts where the tracked
    attributes differ from the snapshot before. A window has one row per snapshot of its key.
    """
    in_order = Window.partitionBy(business_key).orderBy("system_from_ts")
    hashed = snapshots.withColumn("attribute_hash", tracking_hash(tracked))
    changed = (
        hashed.withColumn("_before", F.lag("attribute_hash").over(in_order))
        .where(~F.col("attribute_hash").eqNullSafe(F.col("_before")))
        .drop("_before")
    )
    return changed.withColumns(
        {
            "system_to_ts": F.coalesce(F.lead("system_from_ts").over(in_order), open_end()),
            "record_version": F.row_number().over(in_order),
        }
    )
