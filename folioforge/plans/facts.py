"""Facts with surrogate keys, month replacement, corrections and the reports on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.operators import dimensions, facts, reports
from folioforge.operators.keys import latest_per_key
from folioforge.plans import inputs
from folioforge.plans.model_sql import (
    CASHFLOWS, DIM_COUNTERPARTY, DIM_CURRENCY, DIM_INSTRUMENT, DIM_SOURCE, LINES, PORTFOLIO_LOG,
    POSITIONS, PRICES, TRANSACTIONS,
)
from folioforge.plans.registry import day, moment, present, query, rounded
from folioforge.schemas import FACT
from folioforge.session import work_path
from folioforge.sinks import tables as sinks
from folioforge.sources import model
from folioforge.sources.tables import month_of

_OPEN = moment("TIMESTAMP '9999-12-31 23:59:59'")


def _stamp_sql(event: str, days: int | None) -> str:
    end = _OPEN if days is None else moment(f"{event} + {days}")
    return f"""{moment(event)} AS valid_from_ts, {end} AS valid_to_ts,
    {moment("TIMESTAMP '2002-01-01'")} AS system_from_ts, {_OPEN} AS system_to_ts, true AS is_current_valid,
    true AS is_current_system, 1 AS record_version, 'INSERT' AS change_type"""


_CURRENT_PORTFOLIO = (
    f"{PORTFOLIO_LOG}, portfolio_ref AS (SELECT portfolio_id, portfolio_sk FROM dim_portfolio WHERE is_current)"
)
_DIMS = f"{_CURRENT_PORTFOLIO}, {DIM_INSTRUMENT}, {DIM_COUNTERPARTY}, {DIM_CURRENCY}, {DIM_SOURCE}"


def _fact(spark: SparkSession, folder: str, table: str, raw: DataFrame) -> DataFrame:
    spec = FACT[table]
    references = inputs.references(spark, folder, spec.dimensions)
    return facts.build_fact(raw, spec, references, inputs.AS_OF)


def _transactions(spark: SparkSession, folder: str) -> DataFrame:
    spec = FACT["fact_transactions"]
    references = inputs.references(spark, folder, spec.dimensions)
    # one row per currency code
    references["dim_currency"] = F.broadcast(references["dim_currency"])
    raw = model.transactions(spark, folder, references).withColumn("load_id", F.lit(inputs.PARAMS.load_id))
    return facts.build_fact(raw, spec, references, inputs.AS_OF)


@query(
    "fact_transactions",
    f"""WITH {TRANSACTIONS}, {_DIMS} SELECT transaction_id, portfolio_id, instrument_id, counterparty_id,
    currency_code, portfolio_sk, instrument_sk, counterparty_sk, currency_sk, {day('trade_dt')} AS trade_dt,
    {day('settlement_dt')} AS settlement_dt, transaction_type, 'load-1' AS load_id,
    {rounded('quantity')} AS quantity, {rounded('price')} AS price, {rounded('gross_amount')} AS gross_amount,
    {rounded('fees_amount')} AS fees_amount, {rounded('net_amount')} AS net_amount, source_yyyymm, trade_yyyymm,
    {_stamp_sql('trade_dt', None)} FROM tx LEFT JOIN portfolio_ref USING (portfolio_id)
    LEFT JOIN dim_instrument USING (instrument_id) LEFT JOIN dim_counterparty USING (counterparty_id)
    LEFT JOIN dim_currency USING (currency_code)""",
)
def fact_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return present(_transactions(spark, folder))


@query(
    "fact_positions_daily",
    f"""WITH {POSITIONS}, {_DIMS} SELECT position_id, p.portfolio_id, instrument_id, currency_code,
    source_system_code, portfolio_sk, instrument_sk, currency_sk, market_data_source_sk,
    {day('position_dt')} AS position_dt, {rounded('quantity')} AS quantity,
    {rounded('end_of_day_price')} AS end_of_day_price, {rounded('market_value')} AS market_value,
    {rounded('unrealized_pnl')} AS unrealized_pnl, source_yyyymm, position_yyyymm,
    {_stamp_sql('position_dt', 1)} FROM positions p
    LEFT JOIN (SELECT counterparty_id AS portfolio_id, counterparty_sk AS portfolio_sk FROM dim_counterparty)
      USING (portfolio_id)
    LEFT JOIN dim_instrument USING (instrument_id) LEFT JOIN dim_currency USING (currency_code)
    LEFT JOIN dim_market_data_source USING (source_system_code)""",
)
def fact_positions_daily(spark: SparkSession, folder: str) -> DataFrame:
    """Positions are held by suppliers, so the supplier dimension stands in for the portfolio dimension."""
    spec = FACT["fact_positions_daily"]
    owners = inputs.references(spark, folder, ("dim_counterparty",))["dim_counterparty"]
    references = inputs.references(spark, folder, spec.dimensions[1:])
    references["dim_portfolio"] = owners.toDF("portfolio_id", "portfolio_sk")
    raw = model.positions(spark, folder)
    return present(facts.build_fact(raw, spec, references, inputs.AS_OF))


@query(
    "fact_market_prices_daily",
    f"""WITH {LINES}, {PRICES}, {_DIMS} SELECT price_id, instrument_id, currency_code, source_system_code,
    instrument_sk, currency_sk, market_data_source_sk, {day('price_dt')} AS price_dt,
    {rounded('close_price')} AS close_price, {rounded('return_pct', 6)} AS return_pct,
    {rounded('volatility_proxy')} AS volatility_proxy, source_yyyymm, price_yyyymm,
    {_stamp_sql('price_dt', 1)} FROM prices LEFT JOIN dim_instrument USING (instrument_id)
    LEFT JOIN dim_currency USING (currency_code)
    LEFT JOIN dim_market_data_source USING (source_system_code)""",
)
def fact_market_prices_daily(spark: SparkSession, folder: str) -> DataFrame:
    fact = _fact(spark, folder, "fact_market_prices_daily", model.prices(spark, folder))
    return present(fact, return_pct=6)


@query(
    "fact_cashflows",
    f"""WITH {CASHFLOWS}, {_DIMS} SELECT cashflow_id, portfolio_id, CAST(NULL AS VARCHAR) AS instrument_id,
    currency_code, portfolio_sk, CAST(NULL AS BIGINT) AS instrument_sk, currency_sk,
    {day('cashflow_dt')} AS cashflow_dt, cashflow_type, {rounded('cashflow_amount')} AS cashflow_amount,
    source_yyyymm, cashflow_yyyymm, {_stamp_sql('cashflow_dt', None)} FROM cashflows
    LEFT JOIN portfolio_ref USING (portfolio_id) LEFT JOIN dim_currency USING (currency_code)""",
)
def fact_cashflows(spark: SparkSession, folder: str) -> DataFrame:
    return present(_fact(spark, folder, "fact_cashflows", model.cashflows(spark, folder)))


_LOADED = f"""transaction_id, instrument_id, counterparty_id, {day('trade_dt')} AS trade_dt,
    {rounded('gross_amount')} AS gross_amount, source_yyyymm, trade_yyyymm"""
_SECOND_BATCH = "199806"
_TRADE_COLUMNS = ("transaction_id", "instrument_id", "counterparty_id", "trade_dt", "gross_amount")


def _two_loads(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Everything that arrived before a month, and everything that arrived from then on."""
    rows = (
        model.transactions(spark, folder)
        .select(*_TRADE_COLUMNS, "arrival_dt", "source_yyyymm")
        .withColumn("trade_yyyymm", month_of("trade_dt"))
    )
    earlier = F.col("source_yyyymm") < _SECOND_BATCH
    return rows.where(earlier), rows.where(~earlier)


@query(
    "partition_replace",
    f"""WITH {TRANSACTIONS} SELECT {_LOADED} FROM tx WHERE source_yyyymm >= '{_SECOND_BATCH}'
    OR trade_yyyymm NOT IN (SELECT trade_yyyymm FROM tx WHERE source_yyyymm >= '{_SECOND_BATCH}')""",
)
def partition_replace(spark: SparkSession, folder: str) -> DataFrame:
    """Table content after a second load replaced exactly the event months it contains."""
    path = work_path(spark, "fact-transactions")
    first, second = _two_loads(spark, folder)
    sinks.replace_months(first, path, "trade_yyyymm")
    sinks.replace_months(second, path, "trade_yyyymm")
    table = spark.read.schema(first.schema).parquet(path)
    return present(table.select(*_TRADE_COLUMNS, "source_yyyymm", "trade_yyyymm"))


@query(
    "partition_replay",
    f"""WITH {TRANSACTIONS} SELECT {_LOADED} FROM tx JOIN (
      SELECT trade_yyyymm AS m, max(source_yyyymm) AS owner FROM tx GROUP BY 1)
    ON trade_yyyymm = m AND source_yyyymm = owner""",
)
def partition_replay(spark: SparkSession, folder: str) -> DataFrame:
    """State after every monthly batch replaced the event months it touched, one after the other."""
    rows = model.transactions(spark, folder).select(*_TRADE_COLUMNS, "source_yyyymm")
    dated = rows.withColumn("trade_yyyymm", month_of("trade_dt"))
    return present(facts.replayed(dated, "trade_yyyymm", "source_yyyymm"))


@query(
    "fact_upsert",
    f"""WITH {TRANSACTIONS}, loaded AS (
      SELECT *, source_yyyymm >= '{_SECOND_BATCH}' AS is_second FROM tx),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY is_second, transaction_id, trade_yyyymm
        ORDER BY arrival_dt DESC, instrument_id DESC, counterparty_id DESC, trade_dt DESC,
          gross_amount DESC) AS rn FROM loaded),
    arrived AS (FROM ranked WHERE is_second AND rn = 1)
    SELECT {_LOADED} FROM arrived
    UNION ALL SELECT {_LOADED} FROM ranked o WHERE NOT is_second AND rn = 1 AND NOT EXISTS (
      FROM arrived n WHERE n.transaction_id IS NOT DISTINCT FROM o.transaction_id
        AND n.trade_yyyymm IS NOT DISTINCT FROM o.trade_yyyymm)""",
)
def fact_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """The same two loads as corrections: rows of the affected months stay unless their key arrives again."""
    path = work_path(spark, "fact-transactions")
    first, second = _two_loads(spark, folder)
    keys = ["transaction_id", "trade_yyyymm"]
    latest_by = ["arrival_dt", "instrument_id", "counterparty_id", "trade_dt"]
    sinks.replace_months(latest_per_key(first, keys, latest_by), path, "trade_yyyymm")
    sinks.upsert_months(second, path, "trade_yyyymm", keys, latest_by)
    table = spark.read.schema(first.schema).parquet(path)
    return present(table.select(*_TRADE_COLUMNS, "source_yyyymm", "trade_yyyymm"))


_POINT_IN_TIME = f"""SELECT transaction_id, {day('trade_dt')} AS trade_dt, portfolio_id, d.portfolio_name,
    d.risk_policy_name, {day('d.effective_from_dt')} AS effective_from_dt,
    {rounded('net_amount')} AS net_amount, upper(currency_code[1]) || lower(currency_code[2:]) AS currency_name
    FROM tx JOIN portfolio_ref USING (portfolio_id) JOIN dim_portfolio d USING (portfolio_id, portfolio_sk)
    JOIN dim_currency USING (currency_code)"""


def _point_in_time(spark: SparkSession, folder: str, rows: int | None) -> DataFrame:
    portfolios = inputs.recorded(inputs.dim_portfolio(spark, folder))
    currencies = inputs.recorded(inputs.dim_currency(spark, folder))
    # The report shows two dimensions, so the two others are not looked up. Currencies are one row per code.
    references = {
        "dim_portfolio": dimensions.current_reference(portfolios, "portfolio_id", "portfolio_sk"),
        "dim_currency": F.broadcast(dimensions.current_reference(currencies, "currency_code", "currency_sk")),
    }
    raw = model.transactions(spark, folder, references).withColumn("load_id", F.lit(inputs.PARAMS.load_id))
    trades = facts.build_fact(raw, FACT["fact_transactions"], references, inputs.AS_OF, tuple(references))
    return reports.point_in_time(trades, portfolios, F.broadcast(currencies), rows)


@query("point_in_time_query", f"WITH {TRANSACTIONS}, {_DIMS} {_POINT_IN_TIME}")
def point_in_time_query(spark: SparkSession, folder: str) -> DataFrame:
    return present(_point_in_time(spark, folder, None))


@query(
    "point_in_time_first_rows",
    f"""WITH {TRANSACTIONS}, {_DIMS} SELECT * FROM ({_POINT_IN_TIME})
    ORDER BY trade_dt, transaction_id, portfolio_id, portfolio_name, risk_policy_name, effective_from_dt,
      net_amount LIMIT 5""",
)
def point_in_time_first_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The report as a top-5 over the whole table."""
    return present(_point_in_time(spark, folder, 5))


@query(
    "current_hierarchy_query",
    f"""WITH {TRANSACTIONS}, {PORTFOLIO_LOG} SELECT portfolio_id, portfolio_name, risk_policy_name,
    base_currency_code, count(transaction_id) AS transaction_count,
    {rounded('sum(net_amount)')} AS total_net_amount FROM tx JOIN dim_portfolio USING (portfolio_id)
    WHERE is_current GROUP BY ALL""",
)
def current_hierarchy_query(spark: SparkSession, folder: str) -> DataFrame:
    trades = model.transactions(spark, folder)
    return present(reports.current_hierarchy(trades, inputs.dim_portfolio(spark, folder)))


@query(
    "position_revalue",
    f"""WITH {POSITIONS} SELECT position_id, {rounded('market_value')} AS market_value,
    {rounded('quantity * end_of_day_price')} AS computed_value,
    abs(quantity * end_of_day_price - market_value) <= 0.01 AS is_reconciled FROM positions""",
)
def position_revalue(spark: SparkSession, folder: str) -> DataFrame:
    checked = reports.revalued_positions(model.positions(spark, folder), 0.01)
    return present(checked.select("position_id", "market_value", "computed_value", "is_reconciled"))


@query(
    "position_from_trades",
    f"""WITH {TRANSACTIONS}, netted AS (SELECT portfolio_id, instrument_id, trade_dt,
      sum(CASE transaction_type WHEN 'BUY' THEN quantity ELSE -quantity END) AS net_quantity
      FROM tx GROUP BY ALL)
    SELECT portfolio_id, instrument_id, {day('trade_dt')} AS trade_dt,
    {rounded('net_quantity')} AS net_quantity,
    {rounded('sum(net_quantity) OVER (PARTITION BY portfolio_id, instrument_id ORDER BY trade_dt)')} AS holding
    FROM netted""",
)
def position_from_trades(spark: SparkSession, folder: str) -> DataFrame:
    return present(reports.holdings_from_trades(model.transactions(spark, folder)))


@query(
    "exposure_by_class",
    f"""WITH {POSITIONS}, by_class AS (SELECT position_dt, p_type AS asset_class_code, currency_code,
      sum(market_value) AS market_value FROM positions JOIN part ON instrument_id = CAST(p_partkey AS VARCHAR)
      GROUP BY ALL)
    SELECT {day('position_dt')} AS position_dt, asset_class_code, currency_code,
    {rounded('market_value')} AS market_value,
    {rounded('market_value / sum(market_value) OVER (PARTITION BY position_dt)', 6)} AS exposure_share
    FROM by_class""",
)
def exposure_by_class(spark: SparkSession, folder: str) -> DataFrame:
    held = model.positions(spark, folder)
    return present(reports.exposure(held, model.instruments(spark, folder)), exposure_share=6)


@query(
    "counterparty_activity",
    f"""WITH {TRANSACTIONS} SELECT CAST(s_suppkey AS VARCHAR) AS counterparty_id, s_name AS counterparty_name,
    count(transaction_id) AS transaction_count, {rounded('sum(gross_amount)')} AS gross_amount,
    {rounded('sum(fees_amount)')} AS fees_amount, {day('max(trade_dt)')} AS last_trade_dt
    FROM supplier LEFT JOIN tx ON CAST(s_suppkey AS VARCHAR) = counterparty_id GROUP BY s_suppkey, s_name""",
)
def counterparty_activity(spark: SparkSession, folder: str) -> DataFrame:
    trades = model.transactions(spark, folder)
    return present(reports.counterparty_activity(trades, model.counterparties(spark, folder)))


@query(
    "month_end_positions",
    f"""WITH {POSITIONS}, days AS (
      SELECT CAST(unnest(generate_series(least(a, c), greatest(b, d), INTERVAL 1 DAY)) AS DATE) AS d FROM
      (SELECT min(ship_dt) AS a, max(ship_dt) AS b FROM lines),
      (SELECT min(CAST(o_orderdate AS DATE)) AS c, max(CAST(o_orderdate AS DATE)) AS d FROM orders)),
    last_days AS (SELECT max(d) AS d FROM days WHERE isodow(d) <= 5 GROUP BY year(d), month(d))
    SELECT position_id, {day('position_dt')} AS position_dt, {rounded('market_value')} AS market_value
    FROM positions WHERE position_dt IN (SELECT d FROM last_days)""",
)
def month_end_positions(spark: SparkSession, folder: str) -> DataFrame:
    calendar = dimensions.calendar(inputs.date_bounds(spark, folder), inputs.AS_OF)
    held = reports.month_end_positions(model.positions(spark, folder), calendar)
    return present(held.select("position_id", "position_dt", "market_value"))


@query(
    "transaction_cost",
    f"""WITH {TRANSACTIONS} SELECT portfolio_id, trade_yyyymm, {rounded('sum(gross_amount)')} AS gross_amount,
    {rounded('sum(fees_amount)')} AS fees_amount,
    {rounded('sum(fees_amount) / sum(gross_amount)', 6)} AS fee_share FROM tx GROUP BY ALL""",
)
def transaction_cost(spark: SparkSession, folder: str) -> DataFrame:
    return present(reports.transaction_cost(model.transactions(spark, folder)), fee_share=6)


@query(
    "nav_daily",
    f"""WITH {POSITIONS} SELECT portfolio_id, {day('position_dt')} AS position_dt,
    {rounded('sum(market_value)')} AS net_asset_value, count(*) AS position_count
    FROM positions GROUP BY portfolio_id, positions.position_dt""",
)
def nav_daily(spark: SparkSession, folder: str) -> DataFrame:
    return present(reports.net_asset_value(model.positions(spark, folder)))


@query(
    "cashflow_by_type",
    f"""WITH {CASHFLOWS} SELECT portfolio_id, cashflow_type, cashflow_yyyymm,
    {rounded('sum(cashflow_amount)')} AS cashflow_amount, count(*) AS flow_count FROM cashflows
    GROUP BY portfolio_id, cashflow_type, cashflow_yyyymm""",
)
def cashflow_by_type(spark: SparkSession, folder: str) -> DataFrame:
    return present(reports.income_by_type(model.cashflows(spark, folder)))
