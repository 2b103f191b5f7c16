"""Serving layer: summaries, as-of reads, audits and business reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions.temporal import as_of, known_at

RESULT_KEY = ("portfolio_id", "as_of_date", "confidence_level", "result_yyyymm")


def risk_summary(var: DataFrame, svar: DataFrame) -> DataFrame:
    """VaR with the stressed VaR of the same portfolio, day, level and month."""
    stressed = svar.select(*RESULT_KEY, "svar_amount")
    return var.join(stressed, list(RESULT_KEY), "left").select(*RESULT_KEY, "var_amount", "svar_amount")


def performance_summary(
    cagr: DataFrame, irr: DataFrame, xirr: DataFrame, by: Sequence[str]
) -> DataFrame:
    return (
        cagr.join(irr.select(*by, "irr"), list(by), "left")
        .join(xirr.select(*by, "xirr"), list(by), "left")
        .select(*by, "beginning_dt", "valuation_dt", "cagr", "irr", "xirr")
    )


def results_as_of(results: DataFrame, system_ts: str, valid_ts: str | None = None) -> DataFrame:
    """Published results as they were known at a moment, optionally about a business moment."""
    if valid_ts is None:
        return known_at(results, system_ts)
    return as_of(results, valid_ts, system_ts)


def month_counts(tables: Mapping[str, tuple[DataFrame, str]], month_name: str) -> DataFrame:
    """Rows per month of several tables; each is counted before the union."""
    counted = [
        df.groupBy(F.col(month).alias(month_name))
        .agg(F.count("*").alias("record_count"))
        .select(F.lit(name).alias("table_name"), month_name, "record_count")
        for name, (df, month) in tables.items()
    ]
    united = counted[0]
    for frame in counted[1:]:
        united = united.unionByName(frame)
    return united


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each table in one job instead of one job per table."""
    counted = [
        df.agg(F.count("*").alias("record_count")).select(
            F.lit(name).alias("table_name"), "record_count"
        )
        for name, df in tables.items()
    ]
    united = counted[0]
    for frame in counted[1:]:
        united = united.unionByName(frame)
    return united


def point_in_time(
    transactions: DataFrame, portfolios: DataFrame, currencies: DataFrame, rows: int | None = None
) -> DataFrame:
    """Transactions with the portfolio version their surrogate key points at."""
    versions = portfolios.select("portfolio_sk", "portfolio_name", "risk_policy_name", "effective_from_dt")
    report = (
        transactions.join(versions, "portfolio_sk")
        .join(currencies.select("currency_sk", "currency_name"), "currency_sk")
        .select(
            "transaction_id",
            "trade_dt",
            "portfolio_id",
            "portfolio_name",
            "risk_policy_name",
            "effective_from_dt",
            "net_amount",
            "currency_name",
        )
    )
    if rows is None:
        return report
    return report.orderBy("trade_dt", *report.columns).limit(rows)


def current_hierarchy(transactions: DataFrame, portfolios: DataFrame) -> DataFrame:
    """Transaction totals under the current attributes of each portfolio.

    Totals are built per portfolio before the join, so attributes never enter a large shuffle.
    """
    totals = transactions.groupBy("portfolio_id").agg(
        F.count("transaction_id").alias("transaction_count"),
        F.sum("net_amount").alias("total_net_amount"),
    )
    current = portfolios.where("is_current").select(
        "portfolio_id", "portfolio_name", "risk_policy_name", "base_currency_code"
    )
    return totals.join(current, "portfolio_id").orderBy(F.desc("transaction_count"), "portfolio_id")


def revalued_positions(positions: DataFrame, tolerance: float) -> DataFrame:
    """Market value from quantity and price, and its difference to the value on record."""
    computed = F.col("quantity") * F.col("end_of_day_price")
    return positions.withColumns(
        {
            "computed_value": computed,
            "value_difference": computed - F.col("market_value"),
            "is_reconciled": F.abs(computed - F.col("market_value")) <= tolerance,
        }
    )


def holdings_from_trades(transactions: DataFrame) -> DataFrame:
    """Running quantity per portfolio and instrument.

    Trades are netted per day first, so a window has at most one row per calendar day.
    """
    signed = F.when(F.col("transaction_type") == "BUY", F.col("quantity")).otherwise(-F.col("quantity"))
    netted = transactions.groupBy("portfolio_id", "instrument_id", "trade_dt").agg(
        F.sum(signed).alias("net_quantity")
    )
    until_now = (
        Window.partitionBy("portfolio_id", "instrument_id")
        .orderBy("trade_dt")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return netted.withColumn("holding", F.sum("net_quantity").over(until_now))


def exposure(positions: DataFrame, instruments: DataFrame) -> DataFrame:
    """Market value per day, asset class and currency, with the share of the day.

    Positions are added up per instrument before they meet the instrument dimension.
    """
    per_instrument = positions.groupBy("position_dt", "instrument_id", "currency_code").agg(
        F.sum("market_value").alias("market_value")
    )
    by_class = (
        per_instrument.join(
            instruments.select("instrument_id", "asset_class_code"), "instrument_id", "left"
        )
        .groupBy("position_dt", "asset_class_code", "currency_code")
        .agg(F.sum("market_value").alias("market_value"))
    )
    day_total = F.sum("market_value").over(Window.partitionBy("position_dt"))
    return by_class.withColumn("exposure_share", F.try_divide(F.col("market_value"), day_total))


def counterparty_activity(transactions: DataFrame, counterparties: DataFrame) -> DataFrame:
    totals = transactions.groupBy("counterparty_id").agg(
        F.count("*").alias("transaction_count"),
        F.sum("gross_amount").alias("gross_amount"),
        F.sum("fees_amount").alias("fees_amount"),
        F.max("trade_dt").alias("last_trade_dt"),
    )
    return counterparties.select("counterparty_id", "counterparty_name").join(
        totals, "counterparty_id", "left"
    )


def month_end_positions(positions: DataFrame, calendar: DataFrame) -> DataFrame:
    """Positions on the last business day of each month.

    The calendar is bounded by the date range; one row per month remains after the aggregation.
    """
    last_days = (
        calendar.where("is_business_day")
        .groupBy("year_num", "month_num")
        .agg(F.max("calendar_dt").alias("position_dt"))
        .select("position_dt")
    )
    return positions.join(F.broadcast(last_days), "position_dt", "left_semi")


def transaction_cost(transactions: DataFrame) -> DataFrame:
    """Fees and their share of the traded amount per portfolio and month."""
    return (
        transactions.groupBy("portfolio_id", F.date_format("trade_dt", "yyyyMM").alias("trade_yyyymm"))
        .agg(F.sum("gross_amount").alias("gross_amount"), F.sum("fees_amount").alias("fees_amount"))
        .withColumn("fee_share", F.try_divide("fees_amount", "gross_amount"))
    )


def net_asset_value(positions: DataFrame) -> DataFrame:
    return positions.groupBy("portfolio_id", "position_dt").agg(
        F.sum("market_value").alias("net_asset_value"), F.count("*").alias("position_count")
    )


def income_by_type(cashflows: DataFrame) -> DataFrame:
    return cashflows.groupBy("portfolio_id", "cashflow_type", "cashflow_yyyymm").agg(
        F.sum("cashflow_amount").alias("cashflow_amount"), F.count("*").alias("flow_count")
    )
