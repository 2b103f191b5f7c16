"""Return measures per portfolio: valuation bounds, CAGR, IRR, XIRR.

``by`` names the grouping: ``["portfolio_id", "result_yyyymm"]`` gives every month its own result,
``["portfolio_id"]`` one result since inception.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions.rates import FOUND, SEARCHING, discounted, irr, irr_step, power, xirr, year_fraction
from folioforge.operators.keys import number_within
from folioforge.params import SolverParams
from folioforge.session import materialize

MONTHLY = ("portfolio_id", "result_yyyymm")
SINCE_INCEPTION = ("portfolio_id",)
# Most flows of a series that lie in one array, of 1 MB with their dates.
CHUNK = 65_536


def daily_values(positions: DataFrame, by: Sequence[str]) -> DataFrame:
    """Value of a portfolio per day; ``result_yyyymm`` is the month of the position."""
    return (
        positions.withColumnRenamed("position_yyyymm", "result_yyyymm")
        .groupBy(*by, "position_dt")
        .agg(F.sum("market_value").alias("portfolio_value"))
    )


def valuation_bounds(values: DataFrame, by: Sequence[str]) -> DataFrame:
    """First and last position day and the values on them, in one aggregation instead of self-joins."""
    return values.groupBy(*by).agg(
        F.min("position_dt").alias("beginning_dt"),
        F.max("position_dt").alias("valuation_dt"),
        F.min_by("portfolio_value", "position_dt").alias("beginning_value"),
        F.max_by("portfolio_value", "position_dt").alias("ending_value"),
    )


def cagr(bounds: DataFrame, by: Sequence[str]) -> DataFrame:
    """Annual growth between the bounds; null when they are the same day or the start is worth nothing."""
    years = year_fraction(F.col("valuation_dt"), F.col("beginning_dt"))
    growth = F.try_divide("ending_value", "beginning_value")
    return bounds.withColumn("years_held", years).select(
        *by,
        "beginning_dt",
        "valuation_dt",
        "beginning_value",
        "ending_value",
        "years_held",
        (power(growth, F.try_divide(F.lit(1.0), F.col("years_held"))) - 1).alias("cagr"),
    )


def flows_with_terminal(cashflows: DataFrame, bounds: DataFrame, by: Sequence[str]) -> DataFrame:
    """Cashflows plus the ending value as a last flow. Flows without date or amount are left to the rejects."""
    dated = cashflows.withColumnRenamed("cashflow_yyyymm", "result_yyyymm").select(
        *by, "cashflow_dt", "cashflow_amount"
    )
    terminal = bounds.select(
        *by,
        F.col("valuation_dt").alias("cashflow_dt"),
        F.col("ending_value").alias("cashflow_amount"),
    )
    return dated.unionByName(terminal).where(
        F.col("cashflow_dt").isNotNull() & F.col("cashflow_amount").isNotNull()
    )


def _spread(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Hash-partitioned by the group into the configured number of partitions, which stay as many."""
    count = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(count, *by)


def flow_series(flows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Flows numbered within their portfolio by date and amount, one row each, for series of any length."""
    return number_within(flows.select(*by, "cashflow_dt", "cashflow_amount"), by, ["cashflow_dt", "cashflow_amount"], "period")


def _long_irr(flows: DataFrame, by: Sequence[str], solver: SolverParams) -> DataFrame:
    """IRR of series of any length: all portfolios take a step of the search together.

    Flows are packed once into chunks of ``CHUNK``. Each step joins the rates of portfolios whose search goes on with
    their chunks and adds up two numbers per chunk, in order, so it shuffles one small row per chunk.
    """
    chunk = F.floor((F.col("period") - 1) / CHUNK).alias("_chunk")
    chunks = flow_series(flows, by).groupBy(*by, chunk).agg(
        F.sort_array(F.collect_list(F.struct("period", "cashflow_amount"))).alias("_flows")
    )
    amounts = F.transform("_flows", lambda f: f["cashflow_amount"]).alias("_amounts")
    chunks = materialize(chunks.select(*by, "_chunk", amounts), "flow-chunks")
    counted = chunks.groupBy(*by).agg(
        F.sum(F.size("_amounts")).alias("flow_count"),
        F.max(F.array_max("_amounts")).alias("_high"),
        F.min(F.array_min("_amounts")).alias("_low"),
    )
    counted = materialize(counted, "flow-counts")
    going = counted.where((F.col("_high") > 0) & (F.col("_low") < 0)).select(*by, F.lit(solver.guess).alias("rate"))
    found = []
    for _ in range(solver.max_iterations):
        first = F.col("_chunk") * CHUNK
        parts = chunks.join(going, list(by)).select(
            *by, "rate", F.struct("_chunk", discounted(F.col("_amounts"), F.col("rate") + 1, first).alias("s")).alias("_part")
        )
        ordered = parts.groupBy(*by, "rate").agg(F.sort_array(F.collect_list("_part")).alias("_parts"))
        sums = [
            F.aggregate("_parts", F.lit(0.0), lambda total, part: total + part["s"][name]).alias(name)
            for name in ("value", "slope")
        ]
        stepped = ordered.select(*by, "rate", *sums).select(*by, irr_step(F.col("rate"), F.col("value"), F.col("slope"), solver).alias("_s"))
        # One row per portfolio whose search goes on.
        stepped = materialize(stepped.select(*by, "_s.rate", "_s.status"), "rates")
        found.append(stepped.where(F.col("status") == FOUND).select(*by, F.col("rate").alias("irr")))
        going = stepped.where(F.col("status") == SEARCHING).select(*by, "rate")
        if going.isEmpty():
            break
    return counted.select(*by, "flow_count").join(reduce(DataFrame.unionByName, found), list(by), "left")


def _by_length(flows: DataFrame, by: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
    """Flows of series of at most ``CHUNK`` flows, and those of longer ones if there are any."""
    long = flows.groupBy(*by).agg(F.count(F.lit(1)).alias("flow_count")).where(F.col("flow_count") > CHUNK)
    long = materialize(long.select(*by), "long-series")
    if long.isEmpty():
        return flows, None
    return flows.join(long, list(by), "left_anti"), flows.join(long, list(by), "left_semi")


def irr_results(
    flows: DataFrame, by: Sequence[str], solver: SolverParams = SolverParams()
) -> DataFrame:
    """IRR with one period per flow, for series of any length.

    A series of at most ``CHUNK`` flows is one array and is solved where it is; longer ones are solved step by step
    over their chunks.
    """
    short, long = _by_length(flows, by)
    # The search is heavy for its input size: without a fixed number, few partitions would be left of it.
    series = _spread(short, by).groupBy(*by).agg(
        F.count("*").alias("flow_count"),
        F.sort_array(F.collect_list(F.struct("cashflow_dt", "cashflow_amount"))).alias("_flows"),
    )
    amounts = F.transform("_flows", lambda flow: flow["cashflow_amount"]).alias("_amounts")
    solved = series.select(*by, "flow_count", amounts).select(*by, "flow_count", irr(F.col("_amounts"), solver).alias("irr"))
    return solved if long is None else solved.unionByName(_long_irr(long, by, solver))


def _dated_xirr(per_date: DataFrame, by: Sequence[str], solver: SolverParams) -> DataFrame:
    """XIRR of rows (cashflow_dt, _amount), each for ``_n`` flows between ``_low`` and ``_high``."""
    grouped = _spread(per_date, by).groupBy(*by).agg(
        F.sort_array(F.collect_list(F.struct("cashflow_dt", "_amount"))).alias("_series"),
        F.min("cashflow_dt").alias("_first"),
        F.sum("_n").alias("flow_count"),
        F.max("_high").alias("_high"),
        F.min("_low").alias("_low"),
    )
    dated = F.transform(
        "_series",
        lambda f: F.struct(
            year_fraction(f["cashflow_dt"], F.col("_first")).alias("years"), f["_amount"].alias("amount")
        ),
    )
    solvable = (F.col("flow_count") >= 2) & (F.col("_high") > 0) & (F.col("_low") < 0)
    ready = grouped.select(*by, "flow_count", solvable.alias("_solvable"), dated.alias("_dated"))
    return ready.select(*by, "flow_count", xirr(F.col("_dated"), F.col("_solvable"), solver).alias("xirr"))


def xirr_results(
    flows: DataFrame, by: Sequence[str], solver: SolverParams = SolverParams()
) -> DataFrame:
    """XIRR over the single flows in date order, as many as lie in one array.

    Longer series are added up per date before they are brought together, so they are bounded by the number of days;
    the value is linear in the amounts. Sign changes are judged on the single flows.
    """
    short, long = _by_length(flows, by)
    amount = F.col("cashflow_amount")
    single = short.select(*by, "cashflow_dt", amount.alias("_amount"), F.lit(1).alias("_n"), amount.alias("_high"), amount.alias("_low"))
    solved = _dated_xirr(single, by, solver)
    if long is None:
        return solved
    per_day = long.groupBy(*by, "cashflow_dt").agg(
        F.sum(amount).alias("_amount"), F.count("*").alias("_n"), F.max(amount).alias("_high"), F.min(amount).alias("_low")
    )
    return solved.unionByName(_dated_xirr(per_day, by, solver))


def period_returns(values: DataFrame, period: str) -> DataFrame:
    """Return from the first to each day within the calendar period (``"quarter"`` for quarter to date)."""
    since = F.to_date(F.date_trunc(period, "position_dt"))
    # At most one row per day in each window.
    window = Window.partitionBy("portfolio_id", "period_start_dt").orderBy("position_dt")
    return (
        values.withColumn("period_start_dt", since)
        .withColumn("opening_value", F.first("portfolio_value").over(window))
        .withColumn(
            "period_to_date_return", F.try_divide("portfolio_value", "opening_value") - 1
        )
    )
