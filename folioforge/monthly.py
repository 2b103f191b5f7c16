"""One monthly run over catalog tables: land, curate, publish, serve.

    run_month(spark, "/landing", RunParams(as_of_ts="2026-02-01 06:00:00", month="202601"))

Rerunning a month gives the same tables: raw batches and results are replaced by month, facts are
corrected by key, and dimensions only grow by real changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions.temporal import ts
from folioforge.operators import bronze, dimensions, facts, quality, reports, returns, risk
from folioforge.params import OPEN_END_TS, RunParams
from folioforge.schemas import (
    DIMENSION_DATASETS, DIMENSIONS, EVENT_DATASETS, FACTS, GRAIN, LANDED, DimensionSpec, FactSpec,
)
from folioforge.session import configure, materialize
from folioforge.sinks import tables as sinks
from folioforge.sources.landing import dimension_file, event_files, read_landed

LAYERS = ("bronze", "silver", "gold", "audit")
CALENDAR_START = "2023-01-01"  # fixed value of the data model
RESULT_TABLES = {
    "risk_pnl_distribution": "position_yyyymm",
    "risk_var_results": "result_yyyymm",
    "risk_svar_results": "result_yyyymm",
    "performance_cagr_results": "result_yyyymm",
    "performance_irr_results": "result_yyyymm",
    "performance_xirr_results": "result_yyyymm",
}


def create_layers(spark: SparkSession) -> None:
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")


def ingest_month(spark: SparkSession, base: str, params: RunParams) -> None:
    """Landed files of a month into the raw tables, one batch each."""
    for dataset in (*EVENT_DATASETS, *DIMENSION_DATASETS):
        is_event = dataset in GRAIN
        path = (event_files if is_event else dimension_file)(base, dataset, params.month)
        landed = read_landed(spark, path, LANDED[dataset])
        raw = bronze.with_control_columns(
            bronze.align(landed, LANDED[dataset]),
            GRAIN.get(dataset, "dimension_snapshot"),
            params.load_id,
            params.as_of_ts,
            params.month,
        )
        sinks.save_raw(raw, f"bronze.{dataset}_raw", "source_yyyymm")


def _batch(spark: SparkSession, dataset: str, month: str) -> DataFrame:
    return spark.table(f"bronze.{dataset}_raw").where(F.col("source_yyyymm") == month)


def load_dimension(spark: SparkSession, spec: DimensionSpec, params: RunParams) -> None:
    snapshot = (
        _batch(spark, spec.dataset, params.month)
        .where(~F.col("is_corrupt_record") & F.col(spec.business_key).isNotNull())
        .select(spec.business_key, *spec.attributes)
    )
    if not spec.versioned:
        rebuilt = dimensions.static_dimension(
            snapshot, spec.business_key, spec.surrogate_key, params.as_of_ts
        )
        sinks.save_rebuild(rebuilt, f"silver.{spec.table}")
        return
    history = f"silver.{spec.table}_versions"
    log = spark.table(history) if spark.catalog.tableExists(history) else None
    added = dimensions.new_versions(
        snapshot, log, spec.business_key, spec.surrogate_key, spec.attributes, params.as_of_ts
    )
    # Written aside first: the new versions are computed from the table they are appended to.
    sinks.save_append(materialize(added, spec.table), history)
    sinks.save_rebuild(
        dimensions.dimension_view(spark.table(history), spec.business_key), f"silver.{spec.table}"
    )


def load_fact(
    spark: SparkSession, spec: FactSpec, params: RunParams, replace: bool = False
) -> None:
    """A batch into the event months it contains; records that cannot be dated go to the rejects.

    By default rows of those months stay unless their key arrives again. ``replace`` takes the batch as
    the whole content of every month it contains.
    """
    accepted, rejected = quality.split_rejects(
        _batch(spark, spec.dataset, params.month),
        {
            "readable": ~F.col("is_corrupt_record"),
            "has_key": F.col(spec.key).isNotNull(),
            "has_event_date": F.try_to_date(F.col(spec.event_date)).isNotNull(),
        },
    )
    sinks.save_raw(rejected, f"audit.rejected_{spec.dataset}", "source_yyyymm")
    references = {
        d.table: dimensions.current_reference(
            spark.table(f"silver.{d.table}"), d.business_key, d.surrogate_key
        )
        for d in DIMENSIONS
        if d.table in spec.dimensions
    }
    # Written once: the log and the current table are both made from it.
    fact = materialize(facts.build_fact(accepted, spec, references, params.as_of_ts), spec.table)
    keys, latest_by = [spec.key, spec.month], ["system_from_ts", "source_yyyymm"]
    sinks.save_versions(
        fact, f"silver.{spec.table}_versions", spec.month, keys, latest_by, params.as_of_ts, replace
    )
    if replace:
        sinks.save_months(fact, f"silver.{spec.table}", spec.month)
        return
    sinks.save_corrections(fact, f"silver.{spec.table}", spec.month, keys, latest_by)


def transform_month(spark: SparkSession, params: RunParams, replace: bool = False) -> None:
    for dimension in DIMENSIONS:
        load_dimension(spark, dimension, params)
    bounds = spark.range(1).select(
        F.lit(CALENDAR_START).cast("date").alias("first_dt"),
        F.to_date(ts(params.as_of_ts)).alias("last_dt"),
    )
    sinks.save_rebuild(dimensions.calendar(bounds, params.as_of_ts), "silver.dim_date")
    for fact in FACTS:
        load_fact(spark, fact, params, replace)


def _published(results: DataFrame, spark: SparkSession, params: RunParams, day: str) -> DataFrame:
    """Results with the current surrogate key of the portfolio and both as-of times."""
    owners = dimensions.current_reference(
        spark.table("silver.dim_portfolio"), "portfolio_id", "portfolio_sk"
    )
    return results.join(owners, "portfolio_id", "left").withColumns(
        {
            "business_as_of_ts": F.col(day).cast("timestamp"),
            "system_as_of_ts": ts(params.as_of_ts),
        }
    )


def _save_results(results: DataFrame, table: str, month: str, params: RunParams) -> None:
    """The last results of each month, and those of every run beside them."""
    written = materialize(results, table)
    sinks.save_months(written, f"gold.{table}", month)
    sinks.save_run(written, f"gold.{table}_runs", month, params.as_of_ts)


def publish_risk(spark: SparkSession, params: RunParams) -> None:
    positions = spark.table("silver.fact_positions_daily")
    prices = spark.table("silver.fact_market_prices_daily")
    pnl = risk.simulated_pnl(positions, prices, params)
    sinks.save_months(
        _published(pnl, spark, params, "as_of_date"), "gold.risk_pnl_distribution", "position_yyyymm"
    )
    # The measures start from the facts again: the stored distribution is larger by the history length.
    measures = materialize(risk.position_measures(positions, prices, params), "measures")
    for results, table in (
        (risk.measured_results(measures, params, "var"), "risk_var_results"),
        (risk.stressed_results(measures, params), "risk_svar_results"),
    ):
        _save_results(_published(results, spark, params, "as_of_date"), table, "result_yyyymm", params)


def publish_returns(spark: SparkSession, params: RunParams) -> None:
    by = list(returns.MONTHLY)
    positions = spark.table("silver.fact_positions_daily").where(
        F.col("position_yyyymm") == params.month
    )
    cashflows = spark.table("silver.fact_cashflows").where(F.col("cashflow_yyyymm") == params.month)
    bounds = materialize(
        returns.valuation_bounds(returns.daily_values(positions, by), by), "bounds"
    )
    flows = returns.flows_with_terminal(cashflows, bounds, by)
    valued = bounds.select(*by, "valuation_dt")
    for results, table in (
        (returns.cagr(bounds, by), "performance_cagr_results"),
        (returns.irr_results(flows, by, params.solver).join(valued, by, "left"), "performance_irr_results"),
        (returns.xirr_results(flows, by, params.solver).join(valued, by, "left"), "performance_xirr_results"),
    ):
        _save_results(_published(results, spark, params, "valuation_dt"), table, "result_yyyymm", params)


def create_views(spark: SparkSession) -> None:
    """The four serving views, and one history per fact.

    The as-of views hold the results of every run. What was known at a moment t about business up to a moment b has
    ``system_as_of_ts <= t AND t < known_to_ts AND business_as_of_ts <= b``. A fact's history is asked with
    ``system_from_ts <= t AND t < system_to_ts AND NOT is_deleted``.
    """
    spark.sql("""
        CREATE OR REPLACE VIEW gold.vw_portfolio_risk_summary AS
        SELECT portfolio_id, v.portfolio_sk, as_of_date, v.business_as_of_ts, v.system_as_of_ts,
               confidence_level, result_yyyymm, v.var_amount, s.svar_amount
        FROM gold.risk_var_results v
        LEFT JOIN gold.risk_svar_results s
        USING (portfolio_id, as_of_date, confidence_level, result_yyyymm)""")
    spark.sql("""
        CREATE OR REPLACE VIEW gold.vw_portfolio_performance_summary AS
        SELECT portfolio_id, c.portfolio_sk, result_yyyymm, c.beginning_dt, c.valuation_dt,
               c.cagr, i.irr, x.xirr
        FROM gold.performance_cagr_results c
        LEFT JOIN gold.performance_irr_results i USING (portfolio_id, result_yyyymm)
        LEFT JOIN gold.performance_xirr_results x USING (portfolio_id, result_yyyymm)""")
    spark.sql(f"""
        CREATE OR REPLACE VIEW gold.vw_portfolio_risk_asof AS
        WITH {_known_spans('risk_var_results')}
        SELECT v.*, s.svar_amount, s.svar_pct_market_value, known_to_ts
        FROM gold.risk_var_results_runs v
        JOIN spans USING (result_yyyymm, run)
        LEFT JOIN (SELECT portfolio_id, as_of_date, confidence_level, result_yyyymm, run, svar_amount,
                     svar_pct_market_value FROM gold.risk_svar_results_runs) s
        USING (portfolio_id, as_of_date, confidence_level, result_yyyymm, run)""")
    spark.sql(f"""
        CREATE OR REPLACE VIEW gold.vw_portfolio_performance_asof AS
        WITH {_known_spans('performance_cagr_results')}
        SELECT c.*, i.irr, x.xirr, known_to_ts
        FROM gold.performance_cagr_results_runs c
        JOIN spans USING (result_yyyymm, run)
        LEFT JOIN (SELECT portfolio_id, result_yyyymm, run, irr FROM gold.performance_irr_results_runs) i
        USING (portfolio_id, result_yyyymm, run)
        LEFT JOIN (SELECT portfolio_id, result_yyyymm, run, xirr FROM gold.performance_xirr_results_runs) x
        USING (portfolio_id, result_yyyymm, run)""")
    for fact in FACTS:
        spark.sql(f"""
            CREATE OR REPLACE VIEW silver.vw_{fact.table}_history AS
            SELECT * EXCEPT (system_to_ts, is_current_system, record_version, change_type),
                   lead(system_from_ts, 1, TIMESTAMP '{OPEN_END_TS}') OVER w AS system_to_ts,
                   lead(system_from_ts) OVER w IS NULL AS is_current_system,
                   CAST(row_number() OVER w AS INT) AS record_version,
                   CASE WHEN is_deleted THEN 'DELETE' WHEN row_number() OVER w = 1 THEN 'INSERT' ELSE 'UPDATE' END
                     AS change_type
            FROM silver.{fact.table}_versions
            WINDOW w AS (PARTITION BY {fact.key}, {fact.month} ORDER BY system_from_ts)""")


def _known_spans(table: str) -> str:
    """For every run of a month, from when to when it was the last one; one row per month and run."""
    return f"""runs AS (SELECT DISTINCT result_yyyymm, run, system_as_of_ts FROM gold.{table}_runs),
        spans AS (SELECT result_yyyymm, run,
            lead(system_as_of_ts, 1, TIMESTAMP '{OPEN_END_TS}')
              OVER (PARTITION BY result_yyyymm ORDER BY system_as_of_ts) AS known_to_ts FROM runs)"""


def event_months(spark: SparkSession) -> DataFrame:
    """Rows per event month of every fact table."""
    tables = {f.table: (spark.table(f"silver.{f.table}"), f.month) for f in FACTS}
    return reports.month_counts(tables, "event_yyyymm").orderBy("table_name", "event_yyyymm")


def raw_counts(spark: SparkSession) -> DataFrame:
    return reports.row_counts({f"{d}_raw": spark.table(f"bronze.{d}_raw") for d in LANDED})


def run_month(
    spark: SparkSession, base: str, params: RunParams, replace: bool = False
) -> None:
    configure(spark)
    create_layers(spark)
    ingest_month(spark, base, params)
    transform_month(spark, params, replace)
    publish_risk(spark, params)
    publish_returns(spark, params)
    create_views(spark)
