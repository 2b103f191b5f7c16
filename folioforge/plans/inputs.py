"""Inputs shared by several registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.operators import dimensions
from folioforge.params import RunParams
from folioforge.plans.model_sql import FIRST_LOAD, SECOND_LOAD
from folioforge.schemas import DIMENSION
from folioforge.session import materialize
from folioforge.sources import model

AS_OF = "2002-01-01 00:00:00"
PARAMS = RunParams(
    as_of_ts=AS_OF, load_id="load-1", stress_start="1996-06-01", stress_end="1996-08-31"
)
PORTFOLIO = DIMENSION["dim_portfolio"]


def first_log(spark: SparkSession, folder: str) -> DataFrame:
    snapshot = model.portfolio_snapshot(spark, folder, FIRST_LOAD)
    return dimensions.new_versions(
        snapshot, None, PORTFOLIO.business_key, PORTFOLIO.surrogate_key, PORTFOLIO.attributes, FIRST_LOAD
    )


def version_log(spark: SparkSession, folder: str) -> DataFrame:
    """Version log of the portfolios after two loads."""
    log = first_log(spark, folder)
    snapshot = model.portfolio_snapshot(spark, folder, SECOND_LOAD)
    added = dimensions.new_versions(
        snapshot, log, PORTFOLIO.business_key, PORTFOLIO.surrogate_key, PORTFOLIO.attributes, SECOND_LOAD
    )
    return log.unionByName(added)


def dim_portfolio(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.dimension_view(version_log(spark, folder), PORTFOLIO.business_key)


def _static(snapshot: DataFrame, table: str) -> DataFrame:
    spec = DIMENSION[table]
    return dimensions.static_dimension(snapshot, spec.business_key, spec.surrogate_key, AS_OF)


def dim_instrument(spark: SparkSession, folder: str) -> DataFrame:
    return _static(model.instruments(spark, folder), "dim_instrument")


def dim_counterparty(spark: SparkSession, folder: str) -> DataFrame:
    return _static(model.counterparties(spark, folder), "dim_counterparty")


def dim_currency(spark: SparkSession, folder: str) -> DataFrame:
    return _static(model.currencies(spark, folder), "dim_currency")


def dim_asset_class(spark: SparkSession, folder: str) -> DataFrame:
    return _static(model.asset_classes(spark, folder), "dim_asset_class")


def dim_market_data_source(spark: SparkSession, folder: str) -> DataFrame:
    return _static(model.market_data_sources(spark, folder), "dim_market_data_source")


BUILDERS = {
    "dim_portfolio": dim_portfolio,
    "dim_instrument": dim_instrument,
    "dim_counterparty": dim_counterparty,
    "dim_currency": dim_currency,
    "dim_asset_class": dim_asset_class,
    "dim_market_data_source": dim_market_data_source,
}


def references(spark: SparkSession, folder: str, tables: tuple[str, ...]) -> dict[str, DataFrame]:
    """Current (business key, surrogate key) of each named dimension."""
    return {
        t: dimensions.current_reference(
            BUILDERS[t](spark, folder), DIMENSION[t].business_key, DIMENSION[t].surrogate_key
        )
        for t in tables
    }


def recorded(df: DataFrame) -> DataFrame:
    """Written once, for frames that a query uses more than once."""
    return materialize(df, "recorded")


def date_bounds(spark: SparkSession, folder: str) -> DataFrame:
    """First and last day of all events."""
    shipped = model.load(spark, folder, "lineitem").select(F.col("l_shipdate").alias("d"))
    ordered = model.load(spark, folder, "orders").select(F.col("o_orderdate").alias("d"))
    return shipped.union(ordered).agg(
        F.min("d").cast("date").alias("first_dt"), F.max("d").cast("date").alias("last_dt")
    )
