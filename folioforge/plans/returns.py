"""CAGR, IRR, XIRR and the series behind them, since inception per customer and monthly per nation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions.temporal import stamp
from folioforge.operators import reports, returns
from folioforge.plans.model_sql import CASHFLOWS, NATION_CASHFLOWS, POSITIONS
from folioforge.plans.registry import day, moment, present, query, rounded
from folioforge.session import materialize
from folioforge.sources import model

INCEPTION = list(returns.SINCE_INCEPTION)
MONTHLY = list(returns.MONTHLY)

_BY = {"customer": "portfolio_id", "nation": "portfolio_id, result_yyyymm"}


def _bounds_sql(owner: str) -> str:
    by = _BY[owner]
    source = CASHFLOWS if owner == "customer" else NATION_CASHFLOWS
    return f"""{source}, day_values AS (
  SELECT portfolio_id, position_dt, position_yyyymm AS result_yyyymm, sum(market_value) AS v
  FROM account_days GROUP BY ALL),
bounds AS (
  SELECT {by}, min(position_dt) AS beginning_dt, max(position_dt) AS valuation_dt,
    arg_min(v, position_dt) AS beginning_value, arg_max(v, position_dt) AS ending_value
  FROM day_values GROUP BY ALL),
growth AS (
  SELECT *, date_diff('day', beginning_dt, valuation_dt) / 365.25::DOUBLE AS years_held,
    CASE WHEN years_held > 0 THEN pow(ending_value / beginning_value, 1 / years_held) - 1 END AS cagr
  FROM bounds),
flows AS (
  SELECT {by}, cashflow_dt, cashflow_amount
  FROM (SELECT *, cashflow_yyyymm AS result_yyyymm FROM cashflows)
  UNION ALL SELECT {by}, valuation_dt, ending_value FROM bounds)"""


def _solver_sql(owner: str) -> str:
    """Damped Newton as recursion over one list of flows per group."""
    by = _BY[owner]
    return f"""{_bounds_sql(owner)},
series AS (
  SELECT {by}, count(*) AS flow_count, list(cashflow_amount ORDER BY cashflow_dt, cashflow_amount) AS a,
    list((cashflow_dt - (SELECT min(f.cashflow_dt) FROM flows f)) ORDER BY cashflow_dt, cashflow_amount) AS d,
    count(*) >= 2 AND max(cashflow_amount) > 0 AND min(cashflow_amount) < 0 AS solvable
  FROM flows GROUP BY ALL),
dated AS (SELECT *, [(x - d[1]) / 365.25::DOUBLE for x in d] AS t FROM series),
irr_steps({by}, a, rate, status, i) AS (
  SELECT {by}, a, 0.1::DOUBLE, 0, 0 FROM dated WHERE solvable
  UNION ALL
  SELECT {by}, a,
    CASE WHEN next_status = 0 THEN rate - greatest(-0.5::DOUBLE, least(0.5::DOUBLE, npv / slope)) ELSE rate END,
    next_status, i + 1
  FROM (SELECT *, CASE WHEN rate < -0.99 OR rate > 100 OR npv IS NULL OR isnan(npv) THEN 2
      WHEN abs(npv) < 1e-7 THEN 1 WHEN slope IS NULL OR isnan(slope) OR abs(slope) < 1e-10 THEN 2
      ELSE 0 END AS next_status
    FROM (SELECT *,
        list_sum([a[k] / pow(1 + rate, k - 1) for k in range(1, len(a) + 1)]) AS npv,
        list_sum([-(k - 1) * a[k] / pow(1 + rate, k) for k in range(1, len(a) + 1)]) AS slope
      FROM irr_steps WHERE status = 0 AND i < 100))),
xirr_steps({by}, a, t, rate, status, i) AS (
  SELECT {by}, a, t, 0.1::DOUBLE, 0, 0 FROM dated WHERE solvable
  UNION ALL
  SELECT {by}, a, t,
    CASE WHEN next_status = 0 THEN rate - greatest(-0.5::DOUBLE, least(0.5::DOUBLE, npv / slope)) ELSE rate END,
    next_status, i + 1
  FROM (SELECT *, CASE WHEN rate < -0.99 OR rate > 100 OR list_max(t) * abs(rate) > 50
      OR npv IS NULL OR isnan(npv) OR abs(npv) >= 1e15 THEN 2
      WHEN abs(npv) < 1e-7 THEN 1
      WHEN list_max(t) * abs(rate + 1e-7) > 50 OR slope IS NULL OR isnan(slope) OR abs(slope) < 1e-10
        OR abs(slope) >= 1e15 THEN 2 ELSE 0 END AS next_status
    FROM (SELECT *, (moved - npv) / 1e-7::DOUBLE AS slope FROM (SELECT *,
        list_sum([a[k] / pow(1 + rate, t[k]) for k in range(1, len(a) + 1)]) AS npv,
        list_sum([a[k] / pow(1 + (rate + 1e-7::DOUBLE), t[k]) for k in range(1, len(a) + 1)]) AS moved
      FROM xirr_steps WHERE status = 0 AND i < 100)))),
irr_found AS (SELECT {by}, rate AS irr FROM irr_steps WHERE status = 1),
xirr_found AS (SELECT {by}, rate AS xirr FROM xirr_steps WHERE status = 1)"""


def _bounds(spark: SparkSession, folder: str, owner: str, by: list[str]) -> DataFrame:
    values = returns.daily_values(model.account_days(spark, folder, owner), by)
    return returns.valuation_bounds(values, by)


def _flows(spark: SparkSession, folder: str, owner: str, by: list[str]) -> DataFrame:
    bounds = _bounds(spark, folder, owner, by)
    return returns.flows_with_terminal(model.cashflows(spark, folder, owner), bounds, by)


@query(
    "valuation_bounds",
    f"""WITH {_bounds_sql('nation')} SELECT portfolio_id, result_yyyymm, {day('beginning_dt')} AS beginning_dt,
    {day('valuation_dt')} AS valuation_dt FROM bounds""",
)
def valuation_bounds(spark: SparkSession, folder: str) -> DataFrame:
    bounds = _bounds(spark, folder, "nation", MONTHLY)
    return present(bounds.select(*MONTHLY, "beginning_dt", "valuation_dt"))


@query(
    "beginning_value",
    f"""WITH {_bounds_sql('nation')} SELECT portfolio_id, result_yyyymm, {day('beginning_dt')} AS beginning_dt,
    {rounded('beginning_value')} AS beginning_value FROM bounds""",
)
def beginning_value(spark: SparkSession, folder: str) -> DataFrame:
    bounds = _bounds(spark, folder, "nation", MONTHLY)
    return present(bounds.select(*MONTHLY, "beginning_dt", "beginning_value"))


@query(
    "terminal_value",
    f"""WITH {_bounds_sql('nation')} SELECT portfolio_id, result_yyyymm, {day('valuation_dt')} AS valuation_dt,
    {rounded('ending_value')} AS ending_value FROM bounds""",
)
def terminal_value(spark: SparkSession, folder: str) -> DataFrame:
    bounds = _bounds(spark, folder, "nation", MONTHLY)
    return present(bounds.select(*MONTHLY, "valuation_dt", "ending_value"))


@query(
    "cagr",
    f"""WITH {_bounds_sql('customer')} SELECT portfolio_id, {day('beginning_dt')} AS beginning_dt,
    {day('valuation_dt')} AS valuation_dt, {rounded('beginning_value')} AS beginning_value,
    {rounded('ending_value')} AS ending_value, {rounded('years_held', 6)} AS years_held,
    {rounded('cagr', 6)} AS cagr FROM growth""",
)
def cagr(spark: SparkSession, folder: str) -> DataFrame:
    bounds = _bounds(spark, folder, "customer", INCEPTION)
    return present(returns.cagr(bounds, INCEPTION), years_held=6, cagr=6)


@query(
    "cashflow_union",
    f"""WITH {_bounds_sql('customer')} SELECT portfolio_id, {day('cashflow_dt')} AS cashflow_dt,
    {rounded('cashflow_amount')} AS cashflow_amount FROM flows""",
)
def cashflow_union(spark: SparkSession, folder: str) -> DataFrame:
    return present(_flows(spark, folder, "customer", INCEPTION))


@query(
    "cashflow_series",
    f"""WITH {_bounds_sql('customer')} SELECT portfolio_id,
    row_number() OVER (PARTITION BY portfolio_id ORDER BY flows.cashflow_dt, cashflow_amount) AS period,
    {day('cashflow_dt')} AS cashflow_dt, {rounded('cashflow_amount')} AS cashflow_amount FROM flows""",
)
def cashflow_series(spark: SparkSession, folder: str) -> DataFrame:
    return present(returns.flow_series(_flows(spark, folder, "customer", INCEPTION), INCEPTION))


@query(
    "irr",
    f"""WITH RECURSIVE {_solver_sql('customer')} SELECT portfolio_id, flow_count, {rounded('irr', 6)} AS irr
    FROM series LEFT JOIN irr_found USING (portfolio_id)""",
)
def irr(spark: SparkSession, folder: str) -> DataFrame:
    return present(returns.irr_results(_flows(spark, folder, "customer", INCEPTION), INCEPTION), 6)


@query(
    "xirr",
    f"""WITH RECURSIVE {_solver_sql('customer')} SELECT portfolio_id, flow_count, {rounded('xirr', 6)} AS xirr
    FROM series LEFT JOIN xirr_found USING (portfolio_id)""",
)
def xirr(spark: SparkSession, folder: str) -> DataFrame:
    return present(returns.xirr_results(_flows(spark, folder, "customer", INCEPTION), INCEPTION), 6)


def _performance(spark: SparkSession, folder: str) -> DataFrame:
    bounds = materialize(_bounds(spark, folder, "nation", MONTHLY), "bounds")
    flows = materialize(
        returns.flows_with_terminal(model.cashflows(spark, folder, "nation"), bounds, MONTHLY), "flows"
    )
    return reports.performance_summary(
        returns.cagr(bounds, MONTHLY),
        returns.irr_results(flows, MONTHLY),
        returns.xirr_results(flows, MONTHLY),
        MONTHLY,
    )


#: The size of a rate on a logarithmic scale with its sign: every digit of a large one still counts.
_LOG_CAGR = "CASE WHEN isinf(cagr) THEN 1000 ELSE sign(cagr) * ln(1 + abs(cagr)) END"
_SUMMARY = f"""SELECT portfolio_id, result_yyyymm, {day('beginning_dt')} AS beginning_dt,
    {day('valuation_dt')} AS valuation_dt, {rounded(_LOG_CAGR, 6)} AS log_cagr,
    {rounded('irr', 6)} AS irr, {rounded('xirr', 6)} AS xirr
    FROM growth LEFT JOIN irr_found USING (portfolio_id, result_yyyymm)
    LEFT JOIN xirr_found USING (portfolio_id, result_yyyymm)"""


def _log_cagr() -> Column:
    """A month annualised to the power of 12 or more is compared by its logarithm; 1000, above every double's, if infinite."""
    infinite = F.col("cagr") == float("inf")
    return F.when(infinite, 1000.0).otherwise(F.signum("cagr") * F.log1p(F.abs("cagr"))).alias("log_cagr")


@query("vw_portfolio_performance_summary", f"WITH RECURSIVE {_solver_sql('nation')} {_SUMMARY}")
def vw_portfolio_performance_summary(spark: SparkSession, folder: str) -> DataFrame:
    found = _performance(spark, folder).select(*MONTHLY, "beginning_dt", "valuation_dt", _log_cagr(), "irr", "xirr")
    return present(found, 6)


@query(
    "vw_portfolio_performance_asof",
    f"""WITH {_bounds_sql('nation')} SELECT portfolio_id, result_yyyymm, {day('valuation_dt')} AS valuation_dt,
    {rounded('ending_value')} AS ending_value, {rounded(_LOG_CAGR, 6)} AS log_cagr,
    {moment('valuation_dt + 1')} AS system_from_ts FROM growth
    WHERE valuation_dt <= TIMESTAMP '1998-06-15' AND valuation_dt + 1 <= TIMESTAMP '1998-07-01'""",
)
def vw_portfolio_performance_asof(spark: SparkSession, folder: str) -> DataFrame:
    """Results are recorded on the day after their valuation."""
    results = returns.cagr(_bounds(spark, folder, "nation", MONTHLY), MONTHLY)
    published = stamp(results, "valuation_dt", F.date_add("valuation_dt", 1).cast("timestamp"))
    seen = reports.results_as_of(published, "1998-07-01 00:00:00", "1998-06-15 00:00:00")
    return present(seen.select(*MONTHLY, "valuation_dt", "ending_value", _log_cagr(), "system_from_ts"), log_cagr=6)


@query(
    "qtd_return",
    f"""WITH {POSITIONS}, day_values AS (
      SELECT portfolio_id, position_dt, sum(market_value) AS v FROM positions GROUP BY ALL)
    SELECT portfolio_id, {day('position_dt')} AS position_dt,
    {day("date_trunc('quarter', position_dt)")} AS period_start_dt,
    {rounded('first_value(v) OVER w')} AS opening_value,
    {rounded('v')} AS portfolio_value, {rounded('v / first_value(v) OVER w - 1')} AS period_to_date_return
    FROM day_values WINDOW w AS (
      PARTITION BY portfolio_id, date_trunc('quarter', day_values.position_dt) ORDER BY day_values.position_dt)""",
)
def qtd_return(spark: SparkSession, folder: str) -> DataFrame:
    values = returns.daily_values(model.positions(spark, folder), INCEPTION)
    return present(returns.period_returns(values, "quarter"))
