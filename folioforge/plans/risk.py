"""Value at risk and related measures over all months."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions.temporal import stamp
from folioforge.operators import reports, risk
from folioforge.plans.inputs import PARAMS
from folioforge.plans.model_sql import LINES, NATION_POSITIONS, POSITIONS, PRICES
from folioforge.plans.registry import day, moment, nearest, present, query, rounded
from folioforge.session import materialize
from folioforge.sources import model

_STRESS = (
    f"price_dt BETWEEN DATE '{PARAMS.stress_start}' AND DATE '{PARAMS.stress_end}'"
)


def _pnl(name: str, condition: str = "true") -> str:
    return f"""{name} AS (
  SELECT portfolio_id, p.instrument_id, position_dt AS as_of_date, price_dt AS historical_dt,
    market_value * return_pct AS simulated_pnl, market_value, position_yyyymm
  FROM positions p JOIN prices m ON p.instrument_id = m.instrument_id AND price_dt <= position_dt
  WHERE {condition})"""


def _quantiles(name: str, pnl: str, prefix: str) -> str:
    return f"""{name} AS (
  SELECT portfolio_id, as_of_date, confidence_level, 1 AS holding_period_days,
    position_yyyymm AS result_yyyymm, count(*) AS simulations_count,
    -CASE WHEN confidence_level = 0.95::DOUBLE THEN quantile_disc(simulated_pnl, 0.05)
      ELSE quantile_disc(simulated_pnl, 0.01) END AS {prefix}_amount,
    {prefix}_amount / sum(market_value) AS {prefix}_pct_market_value
  FROM {pnl}, (SELECT unnest([0.95::DOUBLE, 0.99::DOUBLE]) AS confidence_level)
  GROUP BY portfolio_id, as_of_date, position_yyyymm, confidence_level)"""


def _facts(
    spark: SparkSession, folder: str, portfolio: str = "supplier", classes: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Positions and prices as written tables: simulations start from stored facts and scan them by column.

    Positions have the columns of ``classes`` of their instrument, if given.
    """
    held = model.positions(spark, folder, portfolio).select(
        "portfolio_id", "instrument_id", "position_dt", "market_value", "position_yyyymm"
    )
    if classes is not None:
        held = held.join(classes, "instrument_id")
    quotes = model.prices(spark, folder).select("instrument_id", "price_dt", "return_pct")
    return materialize(held, "positions"), materialize(quotes, "prices")


@query(
    "pnl_distribution",
    f"""WITH {POSITIONS}, {PRICES}, {_pnl('pnl')} SELECT portfolio_id, instrument_id,
    {day('as_of_date')} AS as_of_date, {day('historical_dt')} AS historical_dt,
    {rounded('simulated_pnl', 6)} AS simulated_pnl, {rounded('market_value', 6)} AS market_value, position_yyyymm
    FROM pnl""",
)
def pnl_distribution(spark: SparkSession, folder: str) -> DataFrame:
    """Texts and rounded values are made once per position and price, not once per simulated day."""
    held, quotes = _facts(spark, folder)
    held = held.withColumns({"day_text": F.date_format("position_dt", "yyyy-MM-dd"), "shown_value": nearest(F.col("market_value"), 6)})
    quotes = quotes.withColumn("history_text", F.date_format("price_dt", "yyyy-MM-dd"))
    pnl = risk.simulated_pnl(held, quotes, PARAMS, ["day_text", "shown_value"], ["history_text"])
    return pnl.select(
        "portfolio_id",
        "instrument_id",
        F.col("day_text").alias("as_of_date"),
        F.col("history_text").alias("historical_dt"),
        nearest(F.col("simulated_pnl"), 6).alias("simulated_pnl"),
        F.col("shown_value").alias("market_value"),
        "position_yyyymm",
    )


def _position_var(spark: SparkSession, folder: str) -> DataFrame:
    held, quotes = _facts(spark, folder)
    return risk.position_level_var(held, quotes, PARAMS)


_VAR = f"{POSITIONS}, {PRICES}, {_pnl('pnl')}, {_quantiles('var_results', 'pnl', 'var')}"
_VAR_COLUMNS = f"""portfolio_id, {day('as_of_date')} AS as_of_date, confidence_level, holding_period_days,
    result_yyyymm, simulations_count, {rounded('var_amount')} AS var_amount,
    {rounded('var_pct_market_value', 10)} AS var_pct_market_value"""


@query("var_position_level", f"WITH {_VAR} SELECT {_VAR_COLUMNS} FROM var_results")
def var_position_level(spark: SparkSession, folder: str) -> DataFrame:
    return present(_position_var(spark, folder), var_pct_market_value=10)


_PORTFOLIO_VAR = f"""{NATION_POSITIONS}, {PRICES}, {_pnl('pnl')}, days AS (
  SELECT portfolio_id, as_of_date, position_yyyymm, historical_dt, sum(simulated_pnl) AS pnl
  FROM pnl GROUP BY ALL),
series AS (SELECT portfolio_id, as_of_date, position_yyyymm, list(pnl ORDER BY pnl) AS ordered,
  count(*) AS n FROM days GROUP BY ALL),
portfolio_value AS (SELECT portfolio_id, position_dt AS as_of_date, sum(market_value) AS value
  FROM positions GROUP BY ALL),
measured AS (SELECT *, (n * tail + 999) // 1000 AS k FROM series JOIN portfolio_value
  USING (portfolio_id, as_of_date),
  (SELECT unnest([0.95::DOUBLE, 0.99::DOUBLE]) AS confidence_level, unnest([50, 10]) AS tail))"""


def _portfolio_var(spark: SparkSession, folder: str) -> DataFrame:
    held, quotes = _facts(spark, folder, "nation")
    pnl = risk.simulated_pnl(held, quotes, PARAMS)
    return risk.portfolio_level_var(pnl, held, PARAMS)


@query(
    "var_portfolio_level",
    f"""WITH {_PORTFOLIO_VAR} SELECT portfolio_id, {day('as_of_date')} AS as_of_date, confidence_level,
    1 AS holding_period_days, position_yyyymm AS result_yyyymm, n AS simulations_count,
    {rounded('value', 2)} AS portfolio_market_value, {rounded('-ordered[k]', 5)} AS var_amount,
    {rounded('-ordered[k] / value', 10)} AS var_pct_market_value FROM measured""",
)
def var_portfolio_level(spark: SparkSession, folder: str) -> DataFrame:
    results = _portfolio_var(spark, folder).drop("expected_shortfall", "tail_days")
    return present(results, 5, portfolio_market_value=2, var_pct_market_value=10)


@query(
    "expected_shortfall",
    f"""WITH {_PORTFOLIO_VAR} SELECT portfolio_id, {day('as_of_date')} AS as_of_date, confidence_level,
    n AS simulations_count, CAST(k AS INTEGER) AS tail_days,
    {rounded('-list_sum(ordered[1:k])', 6)} AS tail_loss_total FROM measured""",
)
def expected_shortfall(spark: SparkSession, folder: str) -> DataFrame:
    """Shown times the number of tail days: a sum of amounts, unlike their mean, has no rounding ties."""
    total = (F.col("expected_shortfall") * F.col("tail_days")).alias("tail_loss_total")
    columns = ("portfolio_id", "as_of_date", "confidence_level", "simulations_count", "tail_days")
    return present(_portfolio_var(spark, folder).select(*columns, total), 6)


def _stressed(spark: SparkSession, folder: str) -> DataFrame:
    held, quotes = _facts(spark, folder)
    return risk.stressed_var(held, quotes, PARAMS)


_SVAR = f"""{_pnl('stressed_pnl', _STRESS)}, {_quantiles('svar_results', 'stressed_pnl', 'svar')}"""


@query(
    "svar",
    f"""WITH {POSITIONS}, {PRICES}, {_SVAR} SELECT portfolio_id, {day('as_of_date')} AS as_of_date,
    '{PARAMS.stress_start}' AS stress_window_start_dt, '{PARAMS.stress_end}' AS stress_window_end_dt,
    confidence_level, result_yyyymm, simulations_count, {rounded('svar_amount')} AS svar_amount,
    {rounded('svar_pct_market_value', 10)} AS svar_pct_market_value FROM svar_results""",
)
def svar(spark: SparkSession, folder: str) -> DataFrame:
    return present(_stressed(spark, folder), svar_pct_market_value=10)


@query(
    "vw_portfolio_risk_summary",
    f"""WITH {_VAR}, {_SVAR} SELECT portfolio_id, {day('v.as_of_date')} AS as_of_date, confidence_level,
    result_yyyymm, {rounded('var_amount')} AS var_amount, {rounded('svar_amount')} AS svar_amount
    FROM var_results v LEFT JOIN svar_results s USING (portfolio_id, as_of_date, confidence_level, result_yyyymm)""",
)
def vw_portfolio_risk_summary(spark: SparkSession, folder: str) -> DataFrame:
    held, quotes = _facts(spark, folder)
    return present(risk.risk_summary(risk.position_measures(held, quotes, PARAMS), PARAMS))


@query(
    "vw_portfolio_risk_asof",
    f"""WITH {_VAR} SELECT {_VAR_COLUMNS}, {moment('as_of_date + 1')} AS system_from_ts FROM var_results
    WHERE as_of_date <= TIMESTAMP '1998-06-15' AND as_of_date + 1 <= TIMESTAMP '1998-07-01'""",
)
def vw_portfolio_risk_asof(spark: SparkSession, folder: str) -> DataFrame:
    """Results are recorded on the day after the day they describe."""
    published = stamp(
        _position_var(spark, folder), "as_of_date", F.date_add("as_of_date", 1).cast("timestamp")
    )
    seen = reports.results_as_of(published, "1998-07-01 00:00:00", "1998-06-15 00:00:00")
    return present(
        seen.select(
            "portfolio_id", "as_of_date", "confidence_level", "holding_period_days", "result_yyyymm",
            "simulations_count", "var_amount", "var_pct_market_value", "system_from_ts",
        ),
        var_pct_market_value=10,
    )


@query(
    "risk_by_class",
    f"""WITH {NATION_POSITIONS}, {PRICES}, {_pnl('pnl')}, by_class AS (
      SELECT portfolio_id, as_of_date, historical_dt, p_type AS asset_class_code,
        sum(simulated_pnl) AS class_pnl
      FROM pnl JOIN part ON instrument_id = CAST(p_partkey AS VARCHAR) GROUP BY ALL),
    days AS (SELECT portfolio_id, as_of_date, historical_dt, sum(class_pnl) AS day_pnl FROM by_class GROUP BY ALL),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY portfolio_id, as_of_date
        ORDER BY floor(day_pnl * 1e4 + 0.5), historical_dt) AS rn,
      count(*) OVER (PARTITION BY portfolio_id, as_of_date) AS n FROM days),
    tail AS (SELECT portfolio_id, as_of_date, historical_dt, (n * 50 + 999) // 1000 AS k FROM ranked
      WHERE rn <= (n * 50 + 999) // 1000),
    totals AS (SELECT portfolio_id, as_of_date, asset_class_code, k, sum(class_pnl) AS total
      FROM tail JOIN by_class USING (portfolio_id, as_of_date, historical_dt) GROUP BY ALL)
    SELECT portfolio_id, {day('as_of_date')} AS as_of_date, asset_class_code,
    0.95::DOUBLE AS confidence_level, CAST(k AS INTEGER) AS tail_days,
    {rounded('total', 5)} AS class_total,
    {rounded('total / nullif(sum(total) OVER (PARTITION BY portfolio_id, totals.as_of_date), 0)')} AS tail_share
    FROM totals""",
)
def risk_by_class(spark: SparkSession, folder: str) -> DataFrame:
    classes = model.instruments(spark, folder).select("instrument_id", "asset_class_code")
    held, quotes = _facts(spark, folder, "nation", classes)
    pnl = risk.simulated_pnl(held, quotes, PARAMS, carry=["asset_class_code"])
    return present(risk.tail_contribution(pnl, PARAMS).drop("tail_loss"), class_total=5)


_RETURNS = f"""{LINES}, {PRICES}, returns AS (
  SELECT instrument_id, price_dt, close_price, lag(close_price) OVER w AS previous_close,
    close_price / lag(close_price) OVER w - 1 AS derived_return
  FROM prices WINDOW w AS (PARTITION BY instrument_id ORDER BY price_dt))"""


@query(
    "derive_returns",
    f"""WITH {_RETURNS} SELECT instrument_id, {day('price_dt')} AS price_dt,
    {rounded('close_price')} AS close_price, {rounded('previous_close')} AS previous_close,
    {rounded('derived_return')} AS derived_return FROM returns""",
)
def derive_returns(spark: SparkSession, folder: str) -> DataFrame:
    return present(risk.derived_returns(model.prices(spark, folder)))


@query(
    "volatility",
    f"""WITH {_RETURNS} SELECT instrument_id, count(derived_return) AS return_count,
    {rounded('avg(derived_return)')} AS mean_return, {rounded('stddev_samp(derived_return)')} AS volatility
    FROM returns GROUP BY instrument_id""",
)
def volatility(spark: SparkSession, folder: str) -> DataFrame:
    return present(risk.volatility(risk.derived_returns(model.prices(spark, folder))))


@query(
    "beta",
    f"""WITH {LINES}, {PRICES}, benchmark AS (
      SELECT price_dt, avg(return_pct) AS benchmark_return FROM prices GROUP BY 1)
    SELECT instrument_id, count(*) AS return_count,
    {rounded('covar_samp(return_pct, benchmark_return) / var_samp(benchmark_return)')} AS beta
    FROM prices JOIN benchmark USING (price_dt) GROUP BY instrument_id""",
)
def beta(spark: SparkSession, folder: str) -> DataFrame:
    return present(risk.beta(_facts(spark, folder)[1]))


