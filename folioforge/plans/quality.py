"""Data-quality queries. Defects are parts of the feed read in a stricter way than they were sent."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.operators import quality
from folioforge.plans.model_sql import FIRST_LOAD, TRANSACTIONS, snapshot
from folioforge.plans.registry import day, present, query, rounded
from folioforge.sources import model
from folioforge.sources.tables import month_of

_LIMITS = {"discount": 0.05, "fee_rate": 0.2, "quantity": 0.0}

# Returned lines carry a date with a suffix and a currency code outside the reference.
_FEED = f"""{TRANSACTIONS}, feed AS (
  SELECT *, {day('trade_dt')} || CASE WHEN currency_code = 'R' THEN '?' ELSE '' END AS trade_text,
    CASE WHEN transaction_type = 'SELL' AND currency_code = 'A' THEN 'X' ELSE currency_code END AS feed_currency
  FROM tx)"""


def _feed(spark: SparkSession, folder: str) -> DataFrame:
    suffix = F.when(F.col("currency_code") == "R", "?").otherwise("")
    unknown = (F.col("transaction_type") == "SELL") & (F.col("currency_code") == "A")
    return model.transactions(spark, folder).select(
        "transaction_id",
        "instrument_id",
        "counterparty_id",
        "quantity",
        "gross_amount",
        F.concat(F.date_format("trade_dt", "yyyy-MM-dd"), suffix).alias("trade_text"),
        F.when(unknown, "X").otherwise(F.col("currency_code")).alias("currency_code"),
    )


@query(
    "dq_null_threshold",
    f"""WITH counted AS (SELECT count(*) AS row_count, count(*) FILTER (l_discount = 0) AS discount,
      count(*) FILTER (l_tax = 0) AS fee_rate, count(*) FILTER (l_quantity IS NULL) AS quantity FROM lineitem),
    shares AS (
      SELECT 'discount' AS column_name, row_count, discount AS null_count, 0.05::DOUBLE AS max_null_share FROM counted
      UNION ALL SELECT 'fee_rate', row_count, fee_rate, 0.2::DOUBLE FROM counted
      UNION ALL SELECT 'quantity', row_count, quantity, 0.0::DOUBLE FROM counted)
    SELECT column_name, row_count, null_count, {rounded('null_count / row_count', 6)} AS null_share,
    max_null_share, null_count / row_count > max_null_share AS is_breached FROM shares""",
)
def dq_null_threshold(spark: SparkSession, folder: str) -> DataFrame:
    """A discount or tax of zero counts as not filled in."""
    feed = model.load(spark, folder, "lineitem").select(
        F.nullif("l_discount", F.lit(0.0)).alias("discount"),
        F.nullif("l_tax", F.lit(0.0)).alias("fee_rate"),
        F.col("l_quantity").alias("quantity"),
    )
    return present(quality.null_shares(feed, _LIMITS), 6)


@query(
    "dq_duplicates",
    f"""WITH {TRANSACTIONS} SELECT transaction_id, trade_yyyymm, count(*) AS copies FROM tx
    GROUP BY ALL HAVING count(*) > 1""",
)
def dq_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    rows = model.transactions(spark, folder).withColumn("trade_yyyymm", month_of("trade_dt"))
    return quality.duplicate_keys(rows, ["transaction_id", "trade_yyyymm"])


@query(
    "dq_invalid_refs",
    f"""WITH {_FEED} SELECT 'invalid_date' AS problem, transaction_id, instrument_id, counterparty_id,
    trade_text AS found FROM feed WHERE TRY_CAST(trade_text AS DATE) IS NULL UNION ALL
    SELECT 'unknown_currency', transaction_id, instrument_id, counterparty_id, feed_currency FROM feed
    WHERE feed_currency NOT IN (SELECT l_returnflag FROM lineitem UNION SELECT o_orderstatus FROM orders)""",
)
def dq_invalid_refs(spark: SparkSession, folder: str) -> DataFrame:
    feed = _feed(spark, folder)
    ids = ["transaction_id", "instrument_id", "counterparty_id"]
    dates = quality.invalid_dates(feed, "trade_text").select(
        F.lit("invalid_date").alias("problem"), *ids, F.col("trade_text").alias("found")
    )
    # One row per code, however many lines use it: a shuffle by code would send each code's lines to one task.
    codes = F.broadcast(model.currencies(spark, folder))
    unknown = quality.unknown_references(feed, codes, "currency_code").select(
        F.lit("unknown_currency").alias("problem"), *ids, F.col("currency_code").alias("found")
    )
    return dates.unionByName(unknown)


_RULES_SQL = f"""{_FEED}, judged AS (
  SELECT *, concat_ws(',', CASE WHEN TRY_CAST(trade_text AS DATE) IS NULL THEN 'valid_date' END,
    CASE WHEN feed_currency = 'X' THEN 'known_currency' END,
    CASE WHEN quantity < 2 THEN 'tradable_quantity' END) AS reasons FROM feed)"""


@query(
    "dq_reject_split",
    f"""WITH {_RULES_SQL} SELECT transaction_id, instrument_id, counterparty_id,
    {rounded('gross_amount')} AS gross_amount, reasons, reasons <> '' AS is_rejected FROM judged""",
)
def dq_reject_split(spark: SparkSession, folder: str) -> DataFrame:
    rules = {
        "valid_date": F.try_to_date("trade_text").isNotNull(),
        "known_currency": F.col("currency_code") != "X",
        "tradable_quantity": F.col("quantity") >= 2,
    }
    accepted, rejected = quality.split_rejects(_feed(spark, folder), rules)
    columns = ["transaction_id", "instrument_id", "counterparty_id", "gross_amount"]
    kept = accepted.select(*columns, F.lit("").alias("reasons"), F.lit(False).alias("is_rejected"))
    refused = rejected.select(
        *columns, F.array_join("reject_reasons", ",").alias("reasons"), F.lit(True).alias("is_rejected")
    )
    return present(kept.unionByName(refused))


@query(
    "dq_orphans",
    f"""WITH {TRANSACTIONS}, {snapshot('first_load', FIRST_LOAD)} SELECT portfolio_id, count(*) AS fact_count
    FROM tx WHERE portfolio_id NOT IN (SELECT portfolio_id FROM first_load) GROUP BY portfolio_id""",
)
def dq_orphans(spark: SparkSession, folder: str) -> DataFrame:
    """Portfolios traded but missing from the first snapshot."""
    known = model.portfolio_snapshot(spark, folder, FIRST_LOAD)
    return quality.orphan_keys(model.transactions(spark, folder), known, "portfolio_id")
