"""Declared schemas, keys and fact layouts of the data model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


_TYPES = {"string": T.StringType(), "double": T.DoubleType(), "int": T.IntegerType()}


def _schema(columns: str) -> T.StructType:
    """From "name type, name type", without needing a session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Landed datasets. Dates arrive as text and are parsed, or rejected, when facts are built.
LANDED: dict[str, T.StructType] = {
    "transactions": _schema(
        "transaction_id string, portfolio_id string, instrument_id string, counterparty_id string, "
        "trade_dt string, settlement_dt string, transaction_type string, quantity double, "
        "price double, gross_amount double, fees_amount double, net_amount double, "
        "currency_code string, as_of_month string"
    ),
    "positions_daily": _schema(
        "position_id string, portfolio_id string, instrument_id string, position_dt string, "
        "quantity double, end_of_day_price double, market_value double, unrealized_pnl double, "
        "currency_code string, source_system_code string, as_of_month string"
    ),
    "market_prices_daily": _schema(
        "price_id string, instrument_id string, price_dt string, close_price double, "
        "return_pct double, volatility_proxy double, currency_code string, "
        "source_system_code string, as_of_month string"
    ),
    "cashflows": _schema(
        "cashflow_id string, portfolio_id string, instrument_id string, cashflow_dt string, "
        "cashflow_type string, cashflow_amount double, currency_code string, as_of_month string"
    ),
    "portfolios": _schema(
        "portfolio_id string, portfolio_name string, portfolio_type string, "
        "base_currency_code string, risk_policy_name string, as_of_month string"
    ),
    "instruments": _schema(
        "instrument_id string, instrument_name string, ticker string, isin string, "
        "asset_class_code string, currency_code string, issuer_name string, coupon_rate double, "
        "maturity_dt string, as_of_month string"
    ),
    "counterparties": _schema(
        "counterparty_id string, counterparty_name string, counterparty_type string, "
        "country_code string, credit_rating string, as_of_month string"
    ),
    "currencies": _schema(
        "currency_code string, currency_name string, decimal_precision int, as_of_month string"
    ),
    "asset_classes": _schema(
        "asset_class_code string, asset_class_name string, risk_bucket string, as_of_month string"
    ),
    "market_data_sources": _schema(
        "source_system_code string, source_system_name string, vendor_name string, as_of_month string"
    ),
}

GRAIN = {
    "transactions": "transaction",
    "positions_daily": "daily_position",
    "market_prices_daily": "daily_market_price",
    "cashflows": "cashflow",
}
EVENT_DATASETS = tuple(GRAIN)
DIMENSION_DATASETS = tuple(name for name in LANDED if name not in GRAIN)


@dataclass(frozen=True)
class DimensionSpec:
    """A versioned dimension (``tracked`` given) or a static one."""

    table: str
    dataset: str
    business_key: str
    surrogate_key: str
    attributes: tuple[str, ...]
    versioned: bool = True


DIMENSIONS = (
    DimensionSpec(
        "dim_portfolio", "portfolios", "portfolio_id", "portfolio_sk",
        ("portfolio_name", "portfolio_type", "base_currency_code", "risk_policy_name"),
    ),
    DimensionSpec(
        "dim_instrument", "instruments", "instrument_id", "instrument_sk",
        ("instrument_name", "ticker", "isin", "asset_class_code", "currency_code", "issuer_name",
         "coupon_rate", "maturity_dt"),
    ),
    DimensionSpec(
        "dim_counterparty", "counterparties", "counterparty_id", "counterparty_sk",
        ("counterparty_name", "counterparty_type", "country_code", "credit_rating"),
    ),
    DimensionSpec(
        "dim_currency", "currencies", "currency_code", "currency_sk",
        ("currency_name", "decimal_precision"), versioned=False,
    ),
    DimensionSpec(
        "dim_asset_class", "asset_classes", "asset_class_code", "asset_class_sk",
        ("asset_class_name", "risk_bucket"), versioned=False,
    ),
    DimensionSpec(
        "dim_market_data_source", "market_data_sources", "source_system_code",
        "market_data_source_sk", ("source_system_name", "vendor_name"), versioned=False,
    ),
)
DIMENSION = {spec.table: spec for spec in DIMENSIONS}


@dataclass(frozen=True)
class FactSpec:
    """How a landed event dataset becomes a fact partitioned by event month."""

    table: str
    dataset: str
    key: str
    dimensions: tuple[str, ...]
    event_date: str
    month: str
    measures: tuple[str, ...]
    dates: tuple[str, ...] = ()
    labels: tuple[str, ...] = ()
    valid_days: int | None = None


FACTS = (
    FactSpec(
        "fact_transactions", "transactions", "transaction_id",
        ("dim_portfolio", "dim_instrument", "dim_counterparty", "dim_currency"),
        "trade_dt", "trade_yyyymm",
        ("quantity", "price", "gross_amount", "fees_amount", "net_amount"),
        dates=("settlement_dt",), labels=("transaction_type", "load_id"),
    ),
    FactSpec(
        "fact_positions_daily", "positions_daily", "position_id",
        ("dim_portfolio", "dim_instrument", "dim_currency", "dim_market_data_source"),
        "position_dt", "position_yyyymm",
        ("quantity", "end_of_day_price", "market_value", "unrealized_pnl"), valid_days=1,
    ),
    FactSpec(
        "fact_market_prices_daily", "market_prices_daily", "price_id",
        ("dim_instrument", "dim_currency", "dim_market_data_source"),
        "price_dt", "price_yyyymm",
        ("close_price", "return_pct", "volatility_proxy"), valid_days=1,
    ),
    FactSpec(
        "fact_cashflows", "cashflows", "cashflow_id",
        ("dim_portfolio", "dim_instrument", "dim_currency"),
        "cashflow_dt", "cashflow_yyyymm",
        ("cashflow_amount",), labels=("cashflow_type",),
    ),
)
FACT = {spec.table: spec for spec in FACTS}
