"""Facts: enrichment with surrogate keys, batch and event months, corrections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.functions.temporal import known_at, open_end, stamp, ts, valid_at
from folioforge.operators.keys import latest_per_key, version_chain
from folioforge.operators.skew import lookup_join
from folioforge.schemas import DIMENSION, FactSpec
from folioforge.sources.tables import month_of


def build_fact(
    raw: DataFrame,
    spec: FactSpec,
    references: Mapping[str, DataFrame],
    as_of_ts: str,
    dimensions: Sequence[str] | None = None,
) -> DataFrame:
    """Natural keys, surrogate keys of the current dimension rows, typed measures, bi-temporal stamp.

    ``references`` maps a dimension table to (business key, surrogate key). Dimensions join without a
    hint: Catalyst broadcasts those whose size is known to be small and shuffles the others. Rows without a key
    are spread over all partitions of a shuffled join. A surrogate key that ``raw`` already has is kept. ``dimensions``
    names those whose surrogate keys are wanted, if not all.
    """
    keys = [DIMENSION[name] for name in spec.dimensions]
    wanted = [k for k in keys if dimensions is None or k.table in dimensions]
    known = [k.surrogate_key for k in wanted if k.surrogate_key in raw.columns]
    event_date = F.try_to_date(F.col(spec.event_date).cast("string"))
    natural = [k.business_key for k in keys]
    typed = raw.select(
        spec.key,
        *natural,
        *known,
        event_date.alias(spec.event_date),
        *(F.try_to_date(F.col(c).cast("string")).alias(c) for c in spec.dates),
        *spec.labels,
        *(F.col(c).try_cast("double").alias(c) for c in spec.measures),
        "source_yyyymm",
        month_of(event_date).alias(spec.month),
    )
    enriched = typed
    for k in wanted:
        if k.surrogate_key in known:
            continue
        enriched = lookup_join(enriched, references[k.table], k.business_key, spec.key)
    ordered = enriched.select(
        spec.key,
        *natural,
        *(k.surrogate_key for k in wanted),
        spec.event_date,
        *spec.dates,
        *spec.labels,
        *spec.measures,
        "source_yyyymm",
        spec.month,
    )
    return stamp(ordered, spec.event_date, as_of_ts, spec.valid_days)


def affected_months(batch: DataFrame, month: str) -> DataFrame:
    """Event months a batch touches."""
    return batch.select(month).where(F.col(month).isNotNull()).distinct()


def kept_rows(existing: DataFrame, arrived: DataFrame, keys: Sequence[str], month: str) -> DataFrame:
    """Old rows of the months a batch touches whose key did not arrive; with the batch they are the new content.

    ``arrived`` is the batch with one row per key; it is read twice here, so it should be a written table. Old
    rows are not compared with each other, so what a month holds does not depend on which months a batch happens
    to touch. ``keys`` must include the event month, since identifiers restart every month; so only the keys of
    months that exist already have to be compared.
    """
    # One row per month: small enough to broadcast by nature, and it prunes the partitions to read.
    months = F.broadcast(affected_months(arrived, month))
    known = F.broadcast(affected_months(existing, month))
    named = arrived.join(known, month, "left_semi").select(*[F.col(k).alias(f"_{k}") for k in keys])
    same_key = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return existing.join(months, month, "left_semi").join(named, same_key, "left_anti")


def restate(rows: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Every version ever recorded, each closed in system time by its successor.

    Nothing is updated in place, so a question asked as of an earlier moment keeps its answer.
    ``order_by`` starts with ``system_from_ts``.
    """
    chained = version_chain(rows, keys, order_by, F.date_trunc("day", order_by[0]))
    return chained.withColumns(
        {
            "system_to_ts": F.coalesce("next_from", open_end()),
            "is_current_system": F.col("next_from").isNull(),
            "record_version": F.col("version_no"),
            "change_type": F.when(F.col("version_no") == 1, "INSERT").otherwise("UPDATE"),
        }
    ).drop("next_from", "version_no")


def changed_versions(
    log: DataFrame, arrived: DataFrame, keys: Sequence[str], recorded_at: str, replace: bool = False
) -> DataFrame:
    """Rows of ``arrived`` that say something new against what ``log`` holds from before ``recorded_at``.

    Both carry ``content_hash`` and ``is_deleted``. With ``replace``, keys of the log that did not arrive get a version
    that says they are gone.
    """
    before = log.where(F.col("system_from_ts") < ts(recorded_at))
    last = latest_per_key(before, list(keys), ["system_from_ts"])
    named = last.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("content_hash").alias("_hash"), F.col("is_deleted").alias("_gone"))
    same_key = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    new = F.col("_hash").isNull() | F.col("_gone") | (F.col("_hash") != F.col("content_hash"))
    added = arrived.join(named, same_key, "left").where(new).select(*arrived.columns)
    if not replace:
        return added
    here = arrived.select(*[F.col(k).alias(f"_{k}") for k in keys])
    gone = last.where(~F.col("is_deleted")).join(here, same_key, "left_anti")
    gone = gone.withColumns({"system_from_ts": ts(recorded_at), "is_deleted": F.lit(True)})
    return added.unionByName(gone.select(*arrived.columns))


def fact_history(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All versions of a fact log, each closed in system time by the next one of its key."""
    return restate(log, keys, ["system_from_ts"])


def facts_known_at(log: DataFrame, keys: Sequence[str], system_ts: str, valid_ts: str | None = None) -> DataFrame:
    """Facts as they were on record at a moment, optionally only those valid at a business moment."""
    known = known_at(fact_history(log, keys), system_ts).where(~F.col("is_deleted"))
    return known if valid_ts is None else valid_at(known, valid_ts)


def replayed(batches: DataFrame, month: str, batch: str) -> DataFrame:
    """State after loading all batches in order when each batch replaces the event months it touches.

    The last batch that touches a month owns it. The table of owners has one row per month.
    """
    owners = batches.groupBy(month).agg(F.max(batch).alias(batch))
    return batches.join(F.broadcast(owners), [month, batch], "left_semi")


def system_stamp(rows: DataFrame, valid_from: str, recorded: str) -> DataFrame:
    """Stamp rows whose recording day is itself a column."""
    return stamp(rows, valid_from, F.col(recorded).cast("timestamp"))

